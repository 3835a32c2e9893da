"""Operator 10 against brute force."""
import math

import numpy as np

from tabulark.llm.topk_search import exact_topk

SCHEMA = "vec_id long, embedding array<float>, score int, rank int"


def brute(rows, k, ask):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, u in {(i, tuple(v)) for i, v in ok if ask(i)}:
        best = sorted((-sum(a * b for a, b in zip(u, v)), i) for i, v in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k=5, ask=lambda c: c % 50 == 0):
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA).repartition(4)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk(df, df.filter(ask(df.vec_id)), k).collect())


def test_brute_force(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 24))
    v = centers[rng.integers(0, 6, 700)] + rng.normal(size=(700, 24)) * 0.4
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(700, rows[0][1]), (701, rows[0][1]), (702, rows[100][1]), (703, None), (704, [float("nan")] * 24), (705, [float("inf")] + [0.0] * 23),
             (706, [None] + [0.0] * 23), (707, [1.0, -1.0]), (708, []), (None, rows[0][1]), (750, [0.0] * 24)]
    rows += [(800 + i, rows[50][1]) for i in range(150)]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 50 == 0)


def test_large_components_and_few_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(rng.normal(size=(60, 5)) * 40000)]
    assert run(spark, rows, 3) == brute(rows, 3, lambda i: i % 50 == 0)
    assert run(spark, rows[:3]) == brute(rows[:3], 5, lambda i: i % 50 == 0)
    assert run(spark, rows[1:3]) == []
    assert run(spark, []) == []
