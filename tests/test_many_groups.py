"""Grouped reports beyond ten thousand groups."""
from pyspark.sql import functions as F

from tabulark import session
from tabulark.operators import explore as X


def test_histograms_of_many_groups(spark, monkeypatch):
    df = spark.range(30_003).select((F.col("id") % 10_001).alias("g"), F.col("id").cast("double").alias("v"))
    out = X.grouped_histogram(df, "g", "v", 2)
    assert out.count() == 20_002 and out.agg(F.sum("count")).first()[0] == 30_003
    few = df.where("g < 5")
    want = sorted(map(tuple, X.grouped_histogram(few, "g", "v", 3).collect()))
    lookup = session.bounded_lookup
    monkeypatch.setattr(X, "bounded_lookup", lambda d: lookup(d, 2))           # the shuffled side of the switch
    assert sorted(map(tuple, X.grouped_histogram(few, "g", "v", 3).collect())) == want and len(want) == 15


def test_anova_of_many_classes(spark):
    df = spark.range(30_003).select((F.col("id") % 10_001).alias("c"), ((F.col("id") % 10_001) % 7 + F.col("id") % 2).cast("double").alias("v"))
    r = X.anova_f_scores(df, "c", ["v"], with_p=False).first()
    assert r["f_score"] > 1 and r["selected"]


def test_anova_equals_a_plain_one(spark):
    rows = [(i % 3, float(i * i % 17), None if i % 5 else 1.0 * i) for i in range(90)]
    df = spark.createDataFrame(rows, "c int, a double, b double")
    got = {r["feature"]: r["f_score"] for r in X.anova_f_scores(df, "c", ["a", "b"], with_p=False).collect()}
    groups = [[v for c, v, _ in rows if c == k] for k in range(3)]
    mean = sum(map(sum, groups)) / 90
    between = sum(len(g) * (sum(g) / len(g) - mean) ** 2 for g in groups) / 2
    within = sum((v - sum(g) / len(g)) ** 2 for g in groups for v in g) / 87
    assert abs(got["a"] - between / within) < 1e-9
