"""Operator 4: the risk and prior, held-out accuracy, edge cases."""
import random

import numpy as np

from tabulark.llm.blocks import PAD
from tabulark.llm.pu_quality import N_FEATURES, class_prior, features, fit_pu, nn_pu, score_rows, text_features


def test_class_prior():
    rng = np.random.default_rng(1)
    for prior in (0.3, 0.6, 0.9):
        pos = rng.beta(5, 2, 40000)
        unl = np.where(rng.random(40000) < prior, rng.beta(5, 2, 40000), rng.beta(2, 8, 40000))
        p, u = (np.histogram(x, 200, (0, 1))[0] for x in (pos, unl))
        assert abs(class_prior(p, u) - prior) < 0.06


def test_risk_finds_the_boundary():
    rng = np.random.default_rng(2)
    pos = rng.normal(1, 0.4, (2000, 2))
    unl = np.concatenate([rng.normal(1, 0.4, (1400, 2)), rng.normal(-1, 0.4, (600, 2))])
    edges = np.stack([np.linspace(-2, 2, 9)] * 2)
    model = nn_pu(edges, pos, unl, 0.7)
    good, bad = (model.margin(model.bins(rng.normal(c, 0.4, (500, 2)))) for c in (1, -1))
    assert (good > 0).mean() > 0.95 and (bad < 0).mean() > 0.95


def test_features_of_edges():
    texts = [b"", b" \n", b"a", "ü!!".encode(), b"x" * 5000]
    data = np.frombuffer(b"".join(texts) + bytes(PAD), np.uint8)
    x = features(data, np.cumsum([0, *map(len, texts)]))
    assert x.shape == (5, N_FEATURES) and np.isfinite(x).all() and x[0, -1] == 1 and x[2, -1] == 0


def test_held_out_accuracy(spark):
    rnd = random.Random(3)

    def word():
        return "".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8)))
    rows = []
    for i in range(600):
        w = [word() for _ in range(rnd.randint(30, 120))]
        bad = i % 4 == 0
        if bad:
            kind = rnd.randrange(3)
            w = [x + "***" for x in w] if kind == 0 else [x.upper() + "!!" for x in w] if kind == 1 else [x for x in w[:6] for _ in range(15)]
        rows.append((i, " ".join(w) + ".", not bad))
    df = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    x = text_features(df).join(df.select("doc_id", "good"), "doc_id").selectExpr("doc_id", "x", "good and doc_id % 3 <> 1 as positive")
    model, prior = fit_pu(x)
    assert abs(prior - 0.75) < 0.12
    got = {r.doc_id: r.score for r in score_rows(x, model).collect()}
    held = [(got[i] >= 0.5) == g for i, _, g in rows if i % 3 == 1]
    assert sum(held) / len(held) > 0.95
    edges = spark.createDataFrame([(None, "a", 1), (1, None, 2), (2, "", 3), (3, "word " * 50000, 4), (3, "word " * 50000, 4)], "doc_id long, text string, x int")
    s = [r.score for r in score_rows(text_features(edges), model).collect()]
    assert len(s) == 5 and all(0 <= v <= 1 for v in s)
    assert score_rows(text_features(edges.limit(0)), model).collect() == []
    none, _ = fit_pu(x.selectExpr("doc_id", "x", "false as positive"))
    assert none is None and score_rows(x, None).first().score == 0.5
