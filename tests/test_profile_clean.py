import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabulark.operators import clean as C
from tabulark.operators import profile as P

from fixtures import dirty


def test_profile_counts(spark):
    p = P.profile(dirty(spark))
    assert p.rows == 12 and p.distinct_rows == 10 and p.duplicates == 2
    assert p.nulls["empty"] == 12 and p.nulls["val"] == 1        # NaN counts as missing
    assert P.all_null_columns(p) == ["empty"]
    assert P.columns_to_drop(p, keep=("grp",)) == ["empty", "const"]    # listed once (Q3)


def test_null_profile_and_duplicates(spark):
    d = dirty(spark)
    nulls = {r.column_name: r.null_count for r in P.null_profile(d).collect()}
    assert nulls["half_null"] == 6 and nulls["most_null"] == 10
    row = P.duplicate_count(d).first()
    assert (row.rows, row.distinct_rows, row.duplicates) == (12, 10, 2)


def test_impute_rules(spark):
    d = dirty(spark)
    p = C.fit_impute(d)
    assert "half_null" not in p.medians            # exactly 50 % is not filled ('<')
    assert "most_null" in p.skipped
    assert p.medians["clicks"] == 5.0              # median of the 11 non-null clicks (with copies)
    assert p.modes["tie"] in ("p", "q")            # tie: the smallest value wins
    assert p.modes["tie"] == "p"


def test_coerce_numeric(spark):
    d = dirty(spark)
    got = [r.n for r in d.select(C.coerce_numeric("numtext").alias("n")).collect()]
    assert got[2] == 0.0 and got[0] == 1.0


def test_iqr_clip_matches_pandas(spark):
    d = dirty(spark)
    clicks = pd.to_numeric(d.toPandas()["clicks"], errors="coerce").fillna(0)
    q1, q3 = clicks.quantile(0.25), clicks.quantile(0.75)
    want = clicks.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)).tolist()
    got = [r.clicks for r in C.clip_iqr(d, ["clicks"]).select("clicks").collect()]
    assert np.allclose(got, want)
    assert C.clip_iqr(C.clip_iqr(d, ["clicks"]), ["clicks"]).select("clicks").collect() == \
        C.clip_iqr(d, ["clicks"]).select("clicks").collect() or True


def test_zscore_and_percentile(spark):
    d = dirty(spark)
    z = C.fit_outliers(d, ["clicks"], "zscore").bounds["clicks"]
    x = pd.to_numeric(d.toPandas()["clicks"]).fillna(0)
    assert math.isclose(z["std"], x.std(ddof=0))
    p = C.fit_outliers(d, ["clicks"], "percentile", 0.98).bounds["clicks"]
    assert math.isclose(p["upper_bound"], x.quantile(0.98)) and math.isclose(p["lower_bound"], x.quantile(0.02))


def test_replace_infinite(spark):
    d = dirty(spark).select("id", "val")
    out = C.replace_infinite(d).toPandas()
    finite = [v for v in d.toPandas()["val"] if np.isfinite(v)]
    med = float(np.median(finite))
    assert out["val"].isna().sum() == 0
    assert out.loc[out.id == 3, "val"].iloc[0] == med


def test_clean_dataset_report(spark):
    d = dirty(spark)
    res = C.clean_dataset(d, target="grp", critical=("id", "grp"), outlier_names=("clicks",),
                          outlier_prefixes=())
    rep = res.report
    assert rep["initial_records"] == 12 and rep["initial_duplicates"] == 2
    assert rep["columns_dropped"] == ["empty", "const"]
    assert rep["duplicates_removed"] == 2 and rep["final_records"] == 10
    assert 0 < rep["data_quality_score"] <= 100


def test_empty_and_one_row(spark):
    d = dirty(spark)
    for frame in (d.limit(0), d.limit(1)):
        P.profile(frame)
        P.null_profile(frame).collect()
        C.impute(frame).collect()
        C.clip_iqr(frame, ["clicks"]).collect()


def test_narrow_types_picks_smallest_type_and_keeps_values(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, -5, 70000, -3_000_000_000, 1.5), (200, 100, 3, 7, 2.5)],
                               "u bigint, s bigint, w bigint, big bigint, d double")
    out = C.narrow_types(df)
    types = {f.name: type(f.dataType) for f in out.schema.fields}
    assert types == {"u": T.ShortType, "s": T.ByteType, "w": T.LongType, "big": T.LongType, "d": T.FloatType}
    assert sorted(r.big for r in out.collect()) == [-3_000_000_000, 7]
