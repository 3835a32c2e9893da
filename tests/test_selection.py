import numpy as np
import pytest

from tabulark.functions import selection as S


def _frame(spark, values, groups=None):
    if groups is None:
        return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")
    return spark.createDataFrame([(g, float(v)) for g, v in zip(groups, values)], "g string, x double")


@pytest.mark.parametrize("final_rows", [200_000, 7])
def test_quantiles_match_numpy_with_ties_and_hot_value(spark, monkeypatch, final_rows):
    monkeypatch.setattr(S, "FINAL_ROWS", final_rows)
    rng = np.random.RandomState(0)
    vals = list(rng.exponential(10, 400)) + [3.0] * 200 + list(rng.randint(0, 5, 100))   # a hot value
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = S.global_quantiles(_frame(spark, vals).repartition(5), ["x"], probs)["x"]
    want = np.quantile(np.array(vals), probs)
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_grouped_quantiles(spark, monkeypatch):
    monkeypatch.setattr(S, "FINAL_ROWS", 5)
    rng = np.random.RandomState(1)
    groups = ["a"] * 50 + ["b"] * 30 + ["c"] * 1
    vals = list(rng.normal(0, 1, 81))
    res = S.quantiles(_frame(spark, vals, groups), ["x"], [0.25, 0.5, 0.75], by=["g"])
    for g in "abc":
        sub = np.array([v for gg, v in zip(groups, vals) if gg == g])
        assert np.allclose(res[(g,)]["x"], np.quantile(sub, [0.25, 0.5, 0.75]), atol=1e-12)


def test_quantiles_nulls_empty_and_one_row(spark):
    assert S.global_quantiles(_frame(spark, [None, None]), ["x"], [0.5])["x"] == [None]
    assert S.global_quantiles(_frame(spark, [4.0]), ["x"], [0.25, 0.75])["x"] == [4.0, 4.0]
    empty = spark.createDataFrame([], "x double")
    assert S.global_quantiles(empty, ["x"], [0.5])["x"] == [None]


def test_order_statistics_below_counts(spark, monkeypatch):
    monkeypatch.setattr(S, "FINAL_ROWS", 3)
    vals = [5, 1, 1, 2, 2, 2, 9, 9, 3]
    df = _frame(spark, vals)
    res = S.order_statistics(df, ["x"], {((), 0): [0, 3, 8]}, with_below=True)
    srt = sorted(vals)
    for r in (0, 3, 8):
        v, below = res[((), 0, r)]
        assert v == srt[r]
        assert below == sum(1 for x in vals if x < v)


def test_rows_outside_the_brackets_are_not_fanned_out(spark, monkeypatch):
    import numpy as np

    from tabulark.functions import selection as SEL
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=4000), rng.integers(0, 5, 4000).astype(float)
    df = spark.createDataFrame([(float(u) if i % 7 else None, float(v)) for i, (u, v) in enumerate(zip(a, b))], "a double, b double")
    fanned, old = [], SEL._attach_probes

    def counted(*args, **kw):
        out = old(*args, **kw)
        fanned.append(out.count())
        return out
    monkeypatch.setattr(SEL, "_attach_probes", counted)
    for final_rows in (200_000, 3):
        monkeypatch.setattr(SEL, "FINAL_ROWS", final_rows)
        fanned.clear()
        got = SEL.global_quantiles(df, ["a", "b"], [0.1, 0.5, 0.9], accuracy=1000)
        kept = np.array([u for i, u in enumerate(a) if i % 7])
        assert np.allclose(got["a"], np.quantile(kept, [0.1, 0.5, 0.9])) and np.allclose(got["b"], np.quantile(b, [0.1, 0.5, 0.9]))
        if final_rows == 3:
            assert sum(fanned) < 4000                                     # before: every row for every target in each pass
    wrong = SEL.order_statistics(df, ["b"], {((), 0): [0, 3999]}, brackets={((), 0): (1.0, 2.0)})
    assert wrong == {((), 0, 0): 0.0, ((), 0, 3999): 4.0}


def test_copies_come_from_one_join(spark):
    from tabulark.plans import frames as FR
    df = FR.dirty(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1
    a = FR.activity(spark, "/root/testdata/sf0.001")
    assert df.count() == a.count() + a.where("l_linenumber = 1").count()


def test_the_input_of_cleaning_is_computed_once(spark):
    from pyspark.sql import functions as F

    from tabulark.operators import clean as C
    reads = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(i):
        reads.add(1)
        return i % 5
    df = spark.range(40).repartition(2).select("id", seen("id").alias("v"), F.when(F.col("id") > 3, F.col("id")).alias("w"))
    assert C.clean_dataset(df, critical=("id",), outlier_names=("w",), outlier_prefixes=()).report["final_records"] == 40
    assert reads.value == 40
