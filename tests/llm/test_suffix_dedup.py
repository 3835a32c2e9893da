"""Operator 1 against a brute-force version."""
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tabulark.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, ord string, s int"


def brute(rows, length=50):
    seen, out = {}, {}
    data = [((S.NULL_ID if d is None else d), d, (t or "").encode()) for d, t in rows]
    for key, _, t in data:
        for i in range(len(t) - length + 1):
            x = t[i:i + length]
            seen[x] = min(seen.get(x, key), key)
    res = []
    for key, d, t in data:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] < key:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        res.append((d, len(t), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(res, key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    out = S.suffix_dedup(df, **kw).select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted((tuple(r) for r in out), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    words = ["the", "and", "of", "thà", "erß", "in", "ning", "é"] + ["".join(rnd.choices("abcde", k=rnd.randint(1, 9))) for _ in range(40)]
    passage = " ".join(rnd.choices(words, k=30))
    rows = []
    for i in range(60):
        t = " ".join(rnd.choices(words, k=rnd.randint(0, 120)))
        if i % 4 == 0:
            at = rnd.randint(0, len(t))
            t = t[:at] + passage[rnd.randint(0, 9):] + t[at:]
        if rows and i % 5 == 0:
            t = rows[rnd.randrange(len(rows))][1] or ""
        if rows and i % 7 == 0:
            t = (rows[rnd.randrange(len(rows))][1] or "x").replace("and", "end", 2)
        rows.append((i * 3 % 61, t))
    rows += [(100, None), (101, ""), (102, "a" * 400), (103, "b" + "a" * 120), (104, "ab" * 200), (105, "ab" * 30),
             (None, passage), (None, passage), rows[3], rows[3], (rows[5][0], passage), (106, "x" * 49), (107, "x" * 49)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    assert got(spark, rows) == brute(rows)


def test_other_length_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "WINDOWS_AT_ONCE", 64)
    rows = corpus(4)
    df = [(d, t) for d, t in rows]
    assert got(spark, df, length=30) == brute(rows, 30)


def test_blocks_of_one_hot_minimizer():
    rnd = random.Random(5)
    hot = "zzzz common words "
    texts = [("".join(rnd.choices("ab", k=60)) + hot + "".join(rnd.choices("ab", k=60))).encode() for _ in range(200)]
    texts += texts[:50]
    flat = np.frombuffer(b"".join(texts) + bytes(S.PAD), np.uint8).copy()
    off = np.cumsum([0, *map(len, texts)])
    pos = np.concatenate([np.arange(a, b - 49) for a, b in zip(off, off[1:])])
    doc = np.searchsorted(off, pos, "right") - 1
    idx, cls = S.suffix_classes(flat, pos, np.zeros(len(pos), np.int64), doc, 50)
    members = {}
    for i, c in zip(idx, cls):
        members.setdefault(c, set()).add(bytes(flat[pos[i]:pos[i] + 50]))
    assert all(len(v) == 1 for v in members.values())
    assert len({next(iter(v)) for v in members.values()}) == len(members)
    counts = {}
    for p, d in zip(pos, doc):
        counts.setdefault(bytes(flat[p:p + 50]), set()).add(d)
    spread = {k for k, v in counts.items() if len(v) > 1}
    assert spread <= {next(iter(v)) for v in members.values()}


def test_empty_table(spark):
    assert got(spark, []) == []


def test_kept_text_is_valid(spark):
    t = "Ünïcödé wörds änd möre " * 8
    rows = [(1, t), (2, "é" + t[3:] + "tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.rest.doc_id: r for r in S.suffix_dedup(df).collect()}
    assert out[1].kept_text == t and out[2].kept_text.endswith("tail")


@pytest.mark.parametrize("seed", [1, 6])
def test_heavy_minimizers_match_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(S, "HEAVY", 4)
    rows = corpus(seed)
    df = S.keyed(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(S.heavy_minimizers(df, 10 ** 5, 50)) > 5
    assert got(spark, rows) == brute(rows)


def test_heavy_minimizer_is_spread(spark, monkeypatch):
    """The edges of a passage in all documents are one minimizer's contexts, but not one block's."""
    monkeypatch.setattr(S, "HEAVY", 1000, raising=False)
    rnd = random.Random(2)
    passage = "".join(rnd.choices("klmnopqrst", k=120))
    edge = lambda: "".join(rnd.choices("abcdefghij", k=60))
    rows = [(i, edge() + passage + edge()) for i in range(2000)]
    packed, plain = [], S._map_contexts

    def watched(*args):
        task = plain(*args)
        texts = pa.RecordBatch.from_arrays([pa.array(list(range(2000))), pa.array([0] * 2000), pa.array([t.encode() for _, t in rows])],
                                           names=["ord", "th", "text"])
        for out in task(iter([texts])):
            packed.extend(zip(out.column("bucket").to_pylist(), out.column("blob").to_pylist()))
        return task
    monkeypatch.setattr(S, "_map_contexts", watched)
    assert got(spark, rows) == brute(rows)
    size = {}
    for b, blob in packed:
        size[b] = size.get(b, 0) + len(S.unpack(blob)[4])
    assert len(size) == 32 and max(size.values()) < 3 * sum(size.values()) / 32


def test_tasks_hold_little_at_once():
    """A block's suffixes are sorted in small parts and packed contexts leave a map task in small batches."""
    import tracemalloc

    import pandas as pd
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(300)]
    phrases = [" ".join(rnd.choices(words, k=9)) for _ in range(2000)]
    texts = [" ".join(rnd.choice(phrases) for _ in range(20)).encode() for _ in range(1500)]
    table = pa.RecordBatch.from_arrays([pa.array(list(range(1500))), pa.array([0] * 1500), pa.array(texts)], names=["ord", "th", "text"])
    out = list(S._map_contexts(50, 32)(iter([table])))
    assert len(out) > 1 and max(b.nbytes for b in out) < 3 * S.BATCH_BYTES
    blobs = [x for b in S._map_contexts(50, 1)(iter([table])) for x in b.column("blob").to_pylist()]
    tracemalloc.start()
    S._sort_bucket(50)(pd.DataFrame({"blob": blobs}))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * sum(map(len, texts)), peak / sum(map(len, texts))
