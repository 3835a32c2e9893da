import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabulark.operators import features as FE

from fixtures import CLICK_CODES, CLICKS, CODE_SEMESTERS, CODE_YEARS, CODES


def test_participation_levels_match_pandas_cut(spark):
    df = spark.createDataFrame([(float(x),) for x in CLICKS], "sum_click double")
    p = FE.fit_levels(df, "sum_click")
    got = [r.c for r in df.select(FE.participation_level("sum_click", p).alias("c")).collect()]
    assert got == CLICK_CODES
    cut = pd.cut(pd.Series(CLICKS), bins=3, labels=["Low", "Medium", "High"], include_lowest=True)
    codes = {"High": 0, "Low": 1, "Medium": 2}
    assert [codes[str(c)] for c in cut] == CLICK_CODES


def test_presentation_codes(spark):
    df = spark.createDataFrame([(c,) for c in CODES], "code string")
    rows = df.select(FE.presentation_year("code").alias("y"),
                     FE.presentation_semester(F.coalesce("code", F.lit("None"))).alias("s")).collect()
    assert [r.y for r in rows] == CODE_YEARS
    assert [r.s for r in rows] == CODE_SEMESTERS


def test_label_encoding_sorted_with_null_text(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "x string")
    out, enc = FE.label_encode(df, ["x"])
    assert enc.classes["x"] == ["a", "b", "c", "nan"]
    assert [r.x for r in out.collect()] == [1, 0, 3, 2]


def test_group_mean_is_broadcast_join_without_window(spark):
    df = spark.range(2000).select((F.col("id") % 4).alias("m"), (F.col("id") % 10).cast("double").alias("c"))
    out = FE.group_mean_feature(df, "m", "c", "avg_c")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan
    pdf = out.toPandas()
    assert np.allclose(pdf.avg_c, pdf.groupby("m").c.transform("mean"))


def test_one_hot_drops_first_level(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "k string")
    out = FE.one_hot(df, ["k"])
    assert out.columns == ["k_y", "k_z"]
    assert [tuple(r) for r in out.collect()] == [(0, 0), (1, 0), (0, 1), (0, 0)]


def test_ordinal_map_dictionary_and_fallback(spark):
    df = spark.createDataFrame([("0-35",), ("55<=",), ("35-55",)], "age string")
    assert [r.age_ord for r in FE.ordinal_map(df, "age").collect()] == [1.0, 3.0, 2.0]
    df2 = spark.createDataFrame([("b",), (None,), ("a",)], "age string")
    # fallback codes are alphabetical with nulls as 'Unknown', which sorts before 'a'
    assert [r.age_ord for r in FE.ordinal_map(df2, "age").collect()] == [2.0, 0.0, 1.0]


def test_feature_operators_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("2013J", "Pass", 3.0, 1.0)], "code_presentation string, final_result string, "
                               "sum_click double, num_of_prev_attempts double")
    res = FE.create_features(df.union(df), rows=2000)
    plan = res.df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_group_mean_falls_back_to_shuffle_join_beyond_the_bound(spark, monkeypatch):
    import tabulark.session as SS
    from tabulark.session import bounded_lookup
    df = spark.range(500).select((F.col("id") % 50).alias("m"), F.col("id").cast("double").alias("c"))
    means = df.groupBy("m").agg(F.avg("c").alias("a"))
    small, is_b = bounded_lookup(means, max_rows=100)
    big, is_b2 = bounded_lookup(means, max_rows=10)
    assert is_b and not is_b2
    assert sorted(small.collect()) == sorted(big.collect())


def test_label_encoding_beyond_the_literal_bound(spark):
    df = spark.createDataFrame([(f"v{i:03d}",) for i in range(40)] + [(None,)], "x string")
    small = FE.fit_label_encoders(df, ["x"])
    large = FE.fit_label_encoders(df, ["x"], max_codes=5)
    assert "x" in small.classes and "x" in large.tables
    a = sorted(FE.apply_label_encoders(df, small).collect())
    b = sorted(FE.apply_label_encoders(df, large).collect())
    assert a == b
