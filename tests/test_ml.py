import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulark.ml import models as M
from tabulark.ml import neighbors as NB
from tabulark.ml.knn import exact_knn_join
from tabulark.ml import prep as PR

SF = "/root/testdata/sf0.001"


def _emb(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    return e.select("vec_id", F.col("label").cast("double").alias("label"),
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                    F.col("embedding").cast("array<double>").alias("x"))


def test_stratified_split_exact_sizes(spark):
    df = _emb(spark)
    tr, te = PR.stratified_split(df, "label", ["vec_id"], 0.2, 42)
    n = df.count()
    assert te.count() == int(np.ceil(0.2 * n)) and tr.count() + te.count() == n
    assert tr.join(te, "vec_id").count() == 0


def test_random_split_exact_and_partition_independent(spark):
    df = _emb(spark).select("vec_id", "label")
    n = df.count()
    tr, te = PR.random_split(df, ["vec_id"], 0.2, 42)
    assert te.count() == int(np.ceil(0.2 * n)) and tr.count() + te.count() == n
    assert tr.join(te, "vec_id").count() == 0
    _, te2 = PR.random_split(df.repartition(5), ["vec_id"], 0.2, 42)
    assert sorted(r.vec_id for r in te.collect()) == sorted(r.vec_id for r in te2.collect())


def test_knn_recall_against_brute_force(spark):
    df = _emb(spark)
    pdf = df.select("vec_id", "x").toPandas()
    X = np.stack(pdf.x.values)
    ids = pdf.vec_id.values
    nn = exact_knn_join(df.select("vec_id", "x"), df.select("vec_id", "x"), 5, "vec_id", "x")
    got = {}
    for r in nn.collect():
        got.setdefault(r.vec_id, set()).add(r.nn_id)
    d = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    hits = total = 0
    for i, vid in enumerate(ids):
        true = set(ids[np.argsort(d[i])[:5]])
        hits += len(true & got.get(vid, set()))
        total += 5
    assert all(len(v) == 5 for v in got.values()) and len(got) == len(ids)
    assert hits / total >= 0.9


def test_smote_balances_classes(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    imb = e.where((F.col("label") >= 5) | (F.col("vec_id") % 3 == 0))
    out = NB.smote_oversample(imb, "label", "embedding", "vec_id", k=5)
    counts = [r["count"] for r in out.groupBy("label").count().collect()]
    assert len(set(counts)) == 1


def test_models_fit_and_predict(spark):
    tr, te = PR.stratified_split(_emb(spark), "label", ["vec_id"], 0.2, 42)
    for name in ("LogisticRegression", "GaussianNB", "LinearDiscriminantAnalysis"):
        f = M.fit_named(name, tr.drop("x"), 64, 10)
        out = M.predict(f, te.drop("x")).collect()
        assert len(out) == te.count()
        assert all(abs(sum(r.probability) - 1) < 1e-6 for r in out)


def test_standard_scale_uses_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "a double")
    out = PR.apply_standard_scale(df, PR.fit_standard_scale(df, ["a"]))
    vals = np.array([r.a for r in out.collect()])
    assert np.isclose(vals.std(ddof=0), 1.0) and np.isclose(vals.mean(), 0.0)
