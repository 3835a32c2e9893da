"""Operator 9 against a brute-force version."""
import random

import numpy as np
import pytest

from tabulark.llm import components as C
from tabulark.llm import jaccard_join as J


def shingles(text, k=5):
    w = [bytes(x) for x in (text or "").encode().lower().split()]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def linked(a, b, percent=80):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(sets)):
        for k in range(i):
            if linked(sets[i][1], sets[k][1]) or (sets[i][0] is not None and sets[i][0] == sets[k][0] and sets[i][1] == sets[k][1]):
                parent[root(i)] = root(k)
    best = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return sorted(((d, len(s), best.get(root(i))) for i, (d, s) in enumerate(sets)), key=str)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(60)]
    rows, hot = [], " ".join(rnd.choices(words, k=50))
    base = " ".join(rnd.choices(words, k=90))
    for i in range(n):
        t = " ".join(rnd.choices(words, k=rnd.choice([0, 1, 3, 5, 6, 8, 9, 12, 20, 40, 80, 150, 300])))
        if i % 3 == 0 and rows:
            w = (rows[rnd.randrange(len(rows))][1] or "").split()
            for _ in range(rnd.randint(0, 3)):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(words)
            t = "  ".join(w).upper()
        elif i % 5 == 0:
            w = base.split()
            w[rnd.randrange(90)] = "q%d" % i
            t = " ".join(w)
        elif i % 7 == 0:
            t = t + "\n" + hot
        rows.append((i * 7 % 127, t))
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "a b c"), (504, "A  B c"), (None, base), (None, "only here x y z q"), (None, "only here x y z q"),
             rows[4], rows[4], (505, "a " * 300), (506, "a " * 500)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 0, "c") for d, t in rows], "doc_id long, text string, node int, a1 string")
    got = sorted((tuple(r) for r in J.jaccard_components(df).collect()), key=str)
    assert got == brute(rows)


def family(seed, n):
    """Near copies of a text that link with it but mostly not with each other, a chain of edits that drifts
    away from it, and texts that share most of a passage without a link."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    rows = [(5000, " ".join(base))]
    for i in range(n):
        w = list(base)
        for at in rnd.sample(range(8, 112, 8), 2):
            w[at] = f"x{i}_{at}"
        rows.append((i, " ".join(w)))
    w = list(base)
    for i in range(24):
        w[i * 5] = f"y{i}"
        rows.append((6000 - i, " ".join(w)))
    for i in range(40):
        rows.append((7000 + i, " ".join(base[:100] + [f"z{i}_{k}" for k in range(40)])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [2048, 50])
def test_family_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK_MEMBERS", block)
    rows = family(4, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((tuple(r) for r in J.jaccard_components(df).collect()), key=str)
    assert got == brute(rows)


def test_members_grow_with_the_family(spark):
    """Listings of members a set stay the same (about 6 here) when the family grows fourfold."""
    rate = {}
    for n in (500, 2000):
        rows = family(6, n)
        _, members = J._Join(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 5, 80).meet()
        count = members.count()
        assert count == members.distinct().count()
        rate[n] = count / len(rows)
    assert rate[2000] <= 1.25 * rate[500]


def test_sets_of_a_family_are_listed_once(spark, monkeypatch):
    rows = family(6, 500)
    _, members = J._Join(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 5, 80).meet()
    assert members.count() <= 1.1 * members.select("node").distinct().count()
    # no pair of a group gets lost; groups that share few sets are not compared as one
    monkeypatch.setattr(J, "BLOCK_MEMBERS", 8)
    groups = {1: range(10), 2: range(1, 11), 3: range(1, 9), **{i: range(9 * i, 9 * i + 10) for i in range(4, 30)}}
    listed = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "gid long, node long")
    join = J._Join(spark.createDataFrame(rows[:20], "doc_id long, text string"), "doc_id", "text", 5, 80)
    got = {}
    for r in join.families(listed).collect():
        got.setdefault(r.gid, set()).add(r.node)
    assert got[1] == set(range(11)) and 2 not in got and 3 not in got and max(map(len, got.values())) < 20
    assert all(any(set(xs) <= own for own in got.values()) for xs in groups.values())


@pytest.mark.parametrize("limit", [200_000, 0])
def test_components_with_and_without_broadcast(spark, monkeypatch, limit):
    monkeypatch.setattr(C, "BROADCAST_LABELS", limit)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(200, 200), (301, 300), (100, 101)]
    got = dict(tuple(r) for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(31)}, 300: 300, 301: 300}


def test_links(spark):
    rows = [(d, t) for d, t in corpus(3) if d is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.a, r.b): (r.common, r.total) for r in J.jaccard_links(df).collect()}
    reps = {}
    for d, t in rows:
        s = frozenset(shingles(t))
        if s:
            reps[s] = min(reps.get(s, d), d)
    want = {}
    items = list(reps.items())
    for i, (s, a) in enumerate(items):
        for u, b in items[:i]:
            if linked(s, u):
                want[min(a, b), max(a, b)] = (len(s & u), len(s | u))
    assert got == want


def test_signatures_are_complete():
    """Every similar pair of random sets of any size shares a signature."""
    rnd = np.random.default_rng(1)
    for _ in range(1500):
        n = int(rnd.integers(1, 120))
        x = rnd.integers(0, 2 ** 63, n).astype(np.uint64)
        drop, add = int(rnd.integers(0, n // 5 + 1)), int(rnd.integers(0, n // 4 + 1))
        y = np.concatenate([x[drop:], rnd.integers(0, 2 ** 63, add).astype(np.uint64)])
        if not len(y) or 100 * (n - drop) < 80 * (n + add):
            continue
        h = np.concatenate([np.sort(x), np.sort(y)])
        row, sig, _ = J.signatures(h, np.array([0, n, n + len(y)]), 80)
        assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist()), (n, drop, add)


def test_empty_table(spark):
    assert J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_id_with_different_texts(spark):
    """Every text of an id is compared, whichever partition it comes from."""
    rnd = random.Random(5)
    a, b, c = ([f"{x}{rnd.randrange(10 ** 6)}" for _ in range(60)] for x in "abc")
    near = lambda w: " ".join([*w[:-1], "changed"])
    rows = [(7, " ".join(a)), (7, " ".join(b)), (7, " ".join(c)), (9, near(a)), (10, near(b)), (11, near(c)), (3, " ".join(b)),
            (12, "alone in this corpus of few texts"), (7, ""), (None, near(c) + " and more")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got = {(r.doc_id, r.n_shingles): r.component_id for r in J.jaccard_components(df).collect()}
        assert got == {(7, 56): 3, (9, 56): 3, (10, 56): 3, (11, 56): 3, (3, 56): 3, (12, 3): 12, (7, 0): 7, (None, 58): 3}
        links = {(r.a, r.b, r.common) for r in J.jaccard_links(df.filter("doc_id is not null")).collect()}
        assert links == {(7, 9, 55), (3, 10, 55), (7, 11, 55)}
