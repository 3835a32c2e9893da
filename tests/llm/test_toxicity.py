"""Operator 3: exact marginals against enumeration, held-out accuracy, spans, edge cases."""
import itertools
import random

import numpy as np

from tabulark.llm.toxicity import Field, fit_toxicity, marginals, standing_out, toxic_spans


def test_marginals_are_exact():
    rnd = random.Random(1)
    f = Field({})
    f.move = np.array([[0.0, -1.3], [0.4, 0.9]])
    seqs = [np.array([rnd.gauss(0, 2) for _ in range(n)]) for n in (1, 4, 0, 7, 2, 4)]
    for s, got in zip(seqs, marginals(seqs, f)):
        weight, total = np.zeros(len(s)), 0.0
        for tags in itertools.product((0, 1), repeat=len(s)):
            w = np.exp(sum(e for e, t in zip(s, tags) if t) + sum(f.move[a, b] for a, b in zip(tags, tags[1:])))
            total += w
            weight += w * np.array(tags)
        assert np.allclose(got, weight / total) if len(s) else len(got) == 0


def test_standing_out():
    assert standing_out(50, 1, 100, 100) > 30 > 0 > standing_out(1, 50, 100, 100)
    assert standing_out(0, 0, 10, 10) == 0.0 and standing_out(10, 10, 10, 10) == 0.0


def corpus(n=500):
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 6))) for _ in range(400)]
    rows = []
    for i in range(n):
        w = rnd.choices(words, k=rnd.randint(20, 150))
        toxic = int(i % 5 == 0)
        for _ in range(rnd.randint(2, 4) if toxic else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(["zorgu", "zorguti", "vexnak", "vexnako", "vexnakus"]))
        rows.append((i, " ".join(w).capitalize() + ".", toxic))
    return rows


def test_held_out_accuracy_and_spans(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    field = fit_toxicity(df.filter("doc_id % 4 <> 3"))
    out = {r.doc_id: r for r in toxic_spans(df, field).collect()}
    held = [(out[i].score >= 0.3) == bool(y) for i, _, y in rows if i % 4 == 3]
    assert sum(held) / len(held) > 0.97
    for i, t, y in rows:
        for s in out[i].spans:
            assert "zorgu" in t[s.start:s.end].lower() or "vexnak" in t[s.start:s.end].lower()
    assert sum(bool(out[i].spans) for i, _, y in rows if y) > 0.9 * sum(y for *_, y in rows)
    edges = spark.createDataFrame([(None, "zorgu vexnak zorguti", 1), (1, None, 2), (2, "", 3), (3, "123 !!", 4), (4, "ab " * 60000, 5), (4, "ab " * 60000, 5)],
                                  "doc_id long, text string, score int")
    e = sorted(((r.doc_id, r.score) for r in toxic_spans(edges, field).collect()), key=str)
    got = dict(e)
    assert len(e) == 6 and got[None] > 0.3 and got[1] == got[2] == got[3] < 0.3 and all(0 <= s <= 1 for _, s in e)
    assert toxic_spans(edges.limit(0), field).collect() == []


def test_without_both_labels(spark):
    one = spark.createDataFrame([(1, "a b", 0)], "doc_id long, text string, toxic int")
    assert fit_toxicity(one) is None and fit_toxicity(one.limit(0)) is None
    assert [r.score for r in toxic_spans(one, None).collect()] == [0.0]


def test_offsets_are_those_of_the_text():
    from tabulark.llm.toxicity import WORD, _spans
    text = "İİ abc vexnak İzorgu x"
    words = WORD.findall(text.lower())
    p = np.array([0.9 if "vexnak" in w or "zorgu" in w else 0.0 for w in words])
    assert [text[s["start"]:s["end"]] for s in _spans(text, p, 0.5)][0].startswith("vexnak")
    assert all(0 <= s["start"] < s["end"] <= len(text) for s in _spans(text, p, 0.5))
