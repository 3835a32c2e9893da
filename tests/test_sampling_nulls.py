"""Sampling and splits with null and repeated keys."""
import pytest
from pyspark.sql import functions as F

from tabulark.functions.hashing import hash_sql
from tabulark.ml import prep as PR
from tabulark.operators import sampling as S


def rows(spark, data, schema="k long, j long, v string"):
    return spark.createDataFrame(data, schema)


def test_rows_without_a_key_are_drawn_like_others(spark):
    df = rows(spark, [(i if i % 5 else None, i, f"v{i}") for i in range(25)])
    assert S.random_sample(df, 25, ["k"]).count() == 25
    assert S.random_sample(df, 20, ["k"]).count() == 20
    gone = rows(spark, [(i, None, "x") for i in range(20)])
    assert S.random_sample(gone, 20, ["k", "j"]).count() == 20 and S.random_sample(gone, 7, ["k", "j"]).count() == 7
    train, test = PR.random_split(df, ["k"], 0.2)
    assert test.count() == 5 and train.count() == 20
    train, test = PR.stratified_split(df.withColumn("c", F.col("j") % 2), "c", ["k"], 0.2)
    assert test.count() == 5 and train.count() == 20


@pytest.mark.parametrize("n", [1, 7, 100, 250, 399])
def test_the_last_keys_rows_do_not_depend_on_partitions(spark, n):
    df = rows(spark, [(None if i % 3 else 7, i % 4, f"v{i % 50}") for i in range(400)])
    got = [sorted(map(str, S.random_sample(d, n, ["k"]).collect())) for d in (df, df.repartition(7, "v"), df.coalesce(1))]
    assert got[0] == got[1] == got[2] and len(got[0]) == n


def test_equal_rows_are_counted_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 16)
    df = rows(spark, [(None, None, None)] * 900 + [(i, i, "x") for i in range(100)])
    for n in (50, 500, 999):
        out = S.random_sample(df, n, ["k", "j"])
        assert out.count() == n
        flagged = S.first_n(df, [S.row_hash(["k", "j"])], n, ["k", "j"])
        assert sorted(map(str, flagged.drop("_first").collect())) == sorted(map(str, df.collect())) and flagged.filter("_first").count() == n
    by = S.first_n(df.withColumn("g", F.coalesce("k", F.lit(-1)) % 2), [S.row_hash(["k"])], {(0,): 30, (-1,): 77}, ["k"], ["g"])
    assert by.filter("_first and g = 0").count() == 30 and by.filter("_first and g = -1").count() == 77 and by.count() == 1000


def test_the_hash_of_null_keys_is_a_number(spark):
    df = rows(spark, [(None, 1, "a"), (1, None, "b"), (None, None, "c")])
    got = [r[0] for r in df.select(F.expr(hash_sql(["k", "j"]))).collect()]
    assert None not in got and len(set(got)) == 3


def test_recent_and_balanced_with_null_keys(spark):
    df = rows(spark, [(None, i // 10, "ab"[i % 2]) for i in range(100)])
    assert S.recent_sample(df, "j", 25, ["k"]).groupBy("j").count().count() == 3 and S.recent_sample(df, "j", 25, ["k"]).count() == 25
    assert S.balanced_sample(df, "v", 20, ["k"]).groupBy("v").count().collect()[0]["count"] == 10
