"""Search over whole chains; metrics of many classes."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulark.functions.hashing import hash_sql
from tabulark.ml import models as M
from tabulark.operators import evaluate as EV


def test_search_over_a_chain(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (300, 3)) * [1, 100, 0.01]
    y = (x[:, 0] > 0.5).astype(float)                                     # a small class to oversample
    df = spark.createDataFrame([(i, [float(v) for v in r], float(c)) for i, (r, c) in enumerate(zip(x, y))], "id long, v array<double>, label double")
    df = df.select("id", array_to_vector("v").alias("features"), "label")
    made = []
    old = M.oversampled
    monkeypatch.setattr(M, "oversampled", lambda *a, **k: made.append(1) or old(*a, **k))
    res = M.search_chain("RandomForest", df, ["id"], 3, 2, {"num_trees": [4], "max_depth": [0, 4]}, folds=2)
    assert len(made) == 3                                                 # once a fold and once for the refit
    sizes = {r["f"]: r["n"] for r in df.groupBy((F.expr(hash_sql(["id"], 42)) % 2).cast("int").alias("f")).agg(F.count("*").alias("n")).collect()}
    assert {s["fold"]: s["rows"] for s in res["scores"]} == sizes and sum(sizes.values()) == 300
    assert len(res["scores"]) == 4 and res["best_params"]["max_depth"] == 4 and max(res["mean"]) > 0.95
    out = M.predict(res["model"], df).collect()
    assert np.mean([r.prediction == r.label for r in out]) > 0.95


def test_boosting_can_be_searched(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    df = spark.createDataFrame([(i, [float(v) for v in r], float(r[0] + r[1] > 0)) for i, r in enumerate(x)], "id long, v array<double>, label double")
    df = df.select("id", array_to_vector("v").alias("features"), "label")
    boosted = M.search_chain("GradientBoosting", df, ["id"], 2, 2, {"max_iter": [1, 12], "max_depth": [1]}, folds=2, oversample=False)
    assert boosted["mean"][1] >= boosted["mean"][0] and boosted["mean"][1] > 0.6
    assert M.search_chain("LogisticRegression", df, ["id"], 2, 2, {"max_iter": [20]}, folds=2, oversample=False)["mean"][0] > 0.9


def test_more_than_a_thousand_classes(spark):
    df = spark.range(3300).select((F.col("id") % 1100).cast("double").alias("y"), F.when(F.col("id") % 3 == 0, F.col("id") % 1100)
                                  .otherwise((F.col("id") + 1) % 1100).cast("double").alias("p"))
    cm = EV.fit_confusion(df, "y", "p")
    assert cm.k == 1100 and cm.total == 3300 and sum(cm.hits) == 1100
    got = EV.metrics_dict(df, "y", "p")
    assert abs(got["accuracy"] - 1 / 3) < 1e-12 and got["TP"] == 1100 and got["FP"] == got["FN"] == 2200


def test_sums_equal_the_matrix(spark):
    rng = np.random.default_rng(2)
    rows = [(["a", "b", None][i], ["a", "b", "c"][j]) for i, j in rng.integers(0, 3, (200, 2))]
    df = spark.createDataFrame(rows, "y string, p string")
    cm = EV.fit_confusion(df, "y", "p")
    assert cm.classes == ["a", "b", "c", None]
    for i, c in enumerate(cm.classes):
        assert cm.support(i) == sum(y == c for y, _ in rows) and cm.predicted(i) == sum(p == c for _, p in rows)
        assert cm.tp(i) == sum(y == p == c for y, p in rows)


def test_settings_run_side_by_side_and_small_boosting_in_a_task(spark, monkeypatch):
    import threading

    from tabulark.ml import trees as TR
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 2))
    df = spark.createDataFrame([(i, [float(v) for v in r], float(r[0] > 0)) for i, r in enumerate(x)], "id long, v array<double>, label double")
    df = df.select("id", array_to_vector("v").alias("features"), "label")
    threads, driver = set(), []
    fit, sums = M.fit_params, TR._block_sums
    monkeypatch.setattr(M, "fit_params", lambda *a, **k: threads.add(threading.get_ident()) or fit(*a, **k))
    monkeypatch.setattr(TR, "_block_sums", lambda *a: driver.append(1) or sums(*a))
    res = M.search_chain("GradientBoosting", df, ["id"], 2, 2, {"max_iter": [1, 2, 8], "max_depth": [1, 2]}, folds=2, oversample=False)
    assert [(s["fold"], s["setting"]) for s in res["scores"]] == [(f, i) for f in (0, 1) for i in range(6)]
    assert len(threads) > 2 and not driver                                # the refit's thread and those of the settings
    assert max(res["mean"]) > 0.9
    with pytest.raises(ValueError):                                       # a failed setting ends the search
        M.search_chain("GaussianNB", df, ["id"], 2, 2, {"smoothing": [1, 2]}, folds=2, oversample=False)
