"""KS statistics of all columns against plain ones; p-values; plan."""
import math

import numpy as np
from pyspark.sql import functions as F

from tabulark.functions import stats as ST
from tabulark.operators import explore as X


def test_normal_distribution_function(spark):
    z = [-40.0, -9.0, -7.08, -7.07, -3.0, -0.5, 0.0, 0.1, 2.5, 7.0, 8.0, 39.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in z], "z double").select(F.expr(ST.normal_cdf_sql("z"))).collect()]
    assert np.allclose(got, [0.5 * math.erfc(-v / math.sqrt(2)) for v in z], atol=1e-14)


def plain(x):
    x = np.sort(x)
    p = np.array([0.5 * math.erfc(-(v - x.mean()) / x.std(ddof=1) / math.sqrt(2)) for v in x])
    n = len(x)
    return max((np.arange(1, n + 1) / n - p).max(), (p - np.arange(n) / n).max())


def test_statistic_equals_a_plain_one(spark):
    rng = np.random.default_rng(0)
    a, b, c = rng.normal(size=800), rng.exponential(size=800), rng.integers(0, 5, 800).astype(float)
    rows = [(float(x), float(y), float(z), None if i % 3 else 1.0, 2.0, math.nan) for i, (x, y, z) in enumerate(zip(a, b, c))]
    df = spark.createDataFrame(rows, "a double, b double, c double, half double, same double, nan double").repartition(5)
    got = {r.variable: r for r in X.ks_normality(df).collect()}
    assert set(got) == {"a", "b", "c"}
    for name, v in (("a", a), ("b", b), ("c", c)):
        assert abs(got[name].ks_statistic - plain(v)) < 1e-12
    assert got["a"].normal_ks and not got["b"].normal_ks and not got["c"].normal_ks
    assert X.ks_normality(df.limit(3)).collect() == [] and X.ks_normality(df.limit(0)).collect() == []


def test_p_values():
    # exact values by simulation of uniforms
    rng = np.random.default_rng(1)
    for n, d in ((10, 0.3), (40, 0.18), (120, 0.1), (400, 0.055), (3000, 0.02)):
        u = np.sort(rng.random((20_000 if n < 1000 else 4000, n)), 1)
        i = np.arange(1, n + 1)
        seen = np.maximum((i / n - u).max(1), (u - (i - 1) / n).max(1))
        assert abs((seen >= d).mean() - ST.kolmogorov_p_value(d, n)) < 0.02
    assert ST.kolmogorov_p_value(0, 5) == 1 and ST.kolmogorov_p_value(1, 5) == 0 and abs(ST.kolmogorov_p_value(0.56328, 5) - 0.05) < 1e-4


def test_one_running_total_for_all_columns(spark, monkeypatch):
    calls = []
    old = X.running_totals
    monkeypatch.setattr(X, "running_totals", lambda *a, **k: calls.append(1) or old(*a, **k))
    df = spark.range(200).select(*[(F.col("id") * k % 37).cast("double").alias(f"x{k}") for k in range(1, 7)])
    assert X.ks_normality(df).count() == 6 and len(calls) == 1
