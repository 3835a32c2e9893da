"""Exploratory statistics (E1-E22) and report helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Report frames are bounded (one row per column, group or class); a global
# window over them is fine. Data-sized frames never get one.


def rank_rows(report: DataFrame, metric: str, tie_keys: list[str], name: str = "rank") -> DataFrame:
    """1-based rank by ``metric`` descending (report-sized frames only)."""
    w = Window.orderBy(F.desc(metric), *tie_keys)
    return report.withColumn(name, F.row_number().over(w).cast("int"))


def top_k_groups(df: DataFrame, key: str, k: int = 8) -> DataFrame:
    """The ``k`` groups with the most rows (ties by key); partial aggregation,
    then a top-k over the aggregated groups."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(k)


def keep_top_groups(df: DataFrame, key: str, k: int = 8) -> DataFrame:
    """Rows of the ``k`` largest groups: the k keys (tiny, proven bounded by k) are
    broadcast into a left-semi join."""
    top = top_k_groups(df, key, k).select(key)
    return df.join(F.broadcast(top), key, "left_semi")


# ----------------------------------------------------------------------------
# E1-E22
# ----------------------------------------------------------------------------
import math  # noqa: E402

from pyspark.sql import types as T  # noqa: E402

from ..functions import stats as ST  # noqa: E402
from ..functions.cumulative import running_totals  # noqa: E402
from ..functions.selection import global_quantiles, quantiles  # noqa: E402
from ..session import bounded_lookup, materialize  # noqa: E402
from .clean import coerce_numeric, fit_mode  # noqa: E402
from .profile import numeric_columns, string_columns  # noqa: E402

MAX_GROUPS = 10_000

DESCRIBE_SCHEMA = T.StructType([
    T.StructField("variable", T.StringType()), T.StructField("count", T.LongType()),
    T.StructField("unique", T.LongType()), T.StructField("top", T.StringType()),
    T.StructField("freq", T.LongType()), T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()), T.StructField("min", T.DoubleType()),
    T.StructField("q25", T.DoubleType()), T.StructField("q50", T.DoubleType()),
    T.StructField("q75", T.DoubleType()), T.StructField("max", T.DoubleType()),
])


def fit_top(df: DataFrame, cols: list[str], with_unique: bool = False) -> dict:
    """Most frequent value and its count per column (smallest value on ties), one job.

    With ``with_unique`` each entry also carries the exact number of distinct
    values, read off the same (column, value) counts: no separate distinct
    aggregate (which Spark expands into one copy of the input per column)."""
    if not cols:
        return {}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ci"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)
    ])).alias("p")).select("p.ci", "p.v").where(F.col("v").isNotNull())
    counts = pairs.groupBy("ci", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("ci").agg(F.min(F.struct((-F.col("n")).alias("negn"), F.col("v"))).alias("b"),
                                    F.count(F.lit(1)).alias("u"))
    if with_unique:
        return {cols[r["ci"]]: (r["b"]["v"], -r["b"]["negn"], r["u"]) for r in best.collect()}
    return {cols[r["ci"]]: (r["b"]["v"], -r["b"]["negn"]) for r in best.collect()}


def fit_quartiles(df: DataFrame, cols: list[str]) -> dict:
    """Exact 25/50/75 % quantiles per column, one fit that describe_all, box_stats
    and outlier_report can share through their ``quartiles`` argument."""
    return global_quantiles(df, cols, [0.25, 0.5, 0.75]) if cols else {}


def _quartiles(df: DataFrame, cols: list[str], quartiles: dict | None) -> dict:
    if quartiles is not None and all(c in quartiles for c in cols):
        return quartiles
    return fit_quartiles(df, cols)


def describe_all(df: DataFrame, cols: list[str] | None = None, quartiles: dict | None = None) -> DataFrame:
    """Pandas ``describe(include='all')`` as one row per column.

    Numeric: count, mean, sample std, min, exact quartiles, max.
    Text: count, distinct count, most frequent value and its count.
    Jobs: one aggregate, one quantile fit, one top-value pass."""
    cols = cols or df.columns
    num = [c for c in numeric_columns(df) if c in cols]
    txt = [c for c in string_columns(df) if c in cols]
    aggs = []
    for i, c in enumerate(num):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")]
    for i, c in enumerate(txt):
        aggs.append(F.count(c).alias(f"tn{i}"))
    row = df.agg(*aggs).first() if aggs else None
    q = _quartiles(df, num, quartiles) if num else {}
    tops = fit_top(df, txt, with_unique=True)
    out = []
    for c in cols:
        if c in num:
            i = num.index(c)
            qs = q[c]
            out.append((c, row[f"n{i}"], None, None, None, row[f"m{i}"], row[f"s{i}"], row[f"a{i}"],
                        qs[0], qs[1], qs[2], row[f"b{i}"]))
        elif c in txt:
            i = txt.index(c)
            top, freq, unique = tops.get(c, (None, None, 0))
            out.append((c, row[f"tn{i}"], unique, top, freq) + (None,) * 7)
    return df.sparkSession.createDataFrame(out, DESCRIBE_SCHEMA)


def _hist_bin(x: F.Column, mn: float, mx: float, bins: int) -> F.Column:
    """numpy ``histogram`` bin of x for equal-width bins over [mn, mx] (last bin closed)."""
    if mn == mx:
        mn, mx = mn - 0.5, mx + 0.5
    step = (mx - mn) / bins
    norm = bins / (mx - mn)
    i0 = F.floor((x - F.lit(mn)) * F.lit(norm)).cast("int")
    i0 = F.least(F.greatest(i0, F.lit(0)), F.lit(bins - 1))

    def edge(i):
        return F.when(i == bins, F.lit(float(mx))).otherwise(i.cast("double") * F.lit(step) + F.lit(mn))

    lower = F.when(x < edge(i0), i0 - 1)
    upper = F.when((x >= edge(i0 + 1)) & (i0 != bins - 1), i0 + 1)
    return F.coalesce(lower, upper, i0)


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = 30) -> DataFrame:
    """``bins`` equal-width bins per numeric column over its [min, max]
    (numpy ``histogram``): (variable, bin, bin_start, bin_end, count), empty bins kept."""
    cols = cols or numeric_columns(df)
    spark = df.sparkSession
    schema = "variable string, bin int, bin_start double, bin_end double, count bigint"
    row = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.min(F.col(c).cast("double")).alias(f"a{i}"), F.max(F.col(c).cast("double")).alias(f"b{i}"))]).first()
    ranges = {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(cols) if row[f"a{i}"] is not None}
    if not ranges:
        return spark.createDataFrame([], schema)
    # bins are computed in a projection first: inside the generator the bin
    # expression runs several times slower than in a code-generated projection
    names = list(ranges)
    binned = df.select(*[_hist_bin(F.col(c).cast("double"), *ranges[c], bins).alias(f"_b{i}")
                         for i, c in enumerate(names)])
    pairs = binned.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"_b{i}").alias("bin"))
        for i, c in enumerate(names)])).alias("p")).select("p.*").where(F.col("bin").isNotNull())
    counts = pairs.groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("count"))
    scaffold = []
    for c, (mn, mx) in ranges.items():
        lo, hi = (mn - 0.5, mx + 0.5) if mn == mx else (mn, mx)
        step = (hi - lo) / bins
        for b in range(bins):
            scaffold.append((c, b, b * step + lo, hi if b == bins - 1 else (b + 1) * step + lo))
    sc = spark.createDataFrame(scaffold, "variable string, bin int, bin_start double, bin_end double")
    return (F.broadcast(sc).join(counts, ["variable", "bin"], "left")
            .select("variable", "bin", "bin_start", "bin_end",
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def moments(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(variable, n, mean, std, skewness, kurtosis), bias-corrected like pandas."""
    cols = cols or numeric_columns(df)
    one = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.count(F.col(c)).alias(f"n{i}"), F.avg(F.col(c).cast("double")).alias(f"m{i}"),
        F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}"),
        F.skewness(F.col(c).cast("double")).alias(f"g{i}"), F.kurtosis(F.col(c).cast("double")).alias(f"k{i}"))])
    rows = F.array(*[F.struct(
        F.lit(c).alias("variable"), F.col(f"n{i}").cast("bigint").alias("n"), F.col(f"m{i}").alias("mean"),
        F.col(f"s{i}").alias("std"),
        ST.sample_skewness(F.col(f"g{i}"), F.col(f"n{i}").cast("double")).alias("skewness"),
        ST.sample_kurtosis(F.col(f"k{i}"), F.col(f"n{i}").cast("double")).alias("kurtosis"))
        for i, c in enumerate(cols)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """E5: Pearson r for every pair i < j (pairwise deletion of nulls), long form
    (var1, var2, correlation, n); a constant column gives null.

    Columns without nulls go through Spark ML's ``Correlation`` (one pass building
    the d x d Gram matrix); with nulls, one aggregation of pairwise statistics."""
    cols = cols or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    spark = df.sparkSession
    schema = "var1 string, var2 string, correlation double, n bigint"
    if not pairs:
        return spark.createDataFrame([], schema)
    stats = df.agg(F.count(F.lit(1)).alias("_rows"),
                   *[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in cols]).first()
    if not any(stats[c] for c in cols) and stats["_rows"] > 1:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.stat import Correlation
        vec = VectorAssembler(inputCols=cols, outputCol="_v").transform(
            df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
        m = Correlation.corr(vec, "_v").first()[0].toArray()
        n = stats["_rows"]
        rows = []
        for i, a in enumerate(cols):
            for j in range(i + 1, len(cols)):
                r = float(m[i][j])
                rows.append((a, cols[j], None if r != r else r, n))
        return spark.createDataFrame(rows, schema)
    one = df.agg(*[a for k, (x, y) in enumerate(pairs) for a in (
        ST.pearson(F.col(x), F.col(y)).alias(f"r{k}"),
        F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull()).alias(f"n{k}"))])
    rows = F.array(*[F.struct(F.lit(x).alias("var1"), F.lit(y).alias("var2"),
                              F.col(f"r{k}").alias("correlation"), F.col(f"n{k}").cast("bigint").alias("n"))
                     for k, (x, y) in enumerate(pairs)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def _with_order(corr: DataFrame, cols: list[str]) -> DataFrame:
    idx = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    return corr.withColumn("_i", F.element_at(idx, F.col("var1"))).withColumn("_j", F.element_at(idx, F.col("var2")))


def top_correlated_pair(corr: DataFrame, cols: list[str]) -> DataFrame:
    """The pair with the largest |r| strictly below 1 (ties: column order)."""
    c = _with_order(corr, cols).where(F.abs("correlation") < 1 - 1e-9)
    return (c.orderBy(F.desc(F.abs("correlation")), "_i", "_j").limit(1)
            .select("var1", "var2", "correlation"))


def strong_correlations(corr: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Pairs i < j with |r| > threshold."""
    return corr.where(F.abs("correlation") > threshold).select("var1", "var2", "correlation")


def correlated_pairs_trend(df: DataFrame, cols: list[str], threshold: float = 0.3, top: int = 6) -> DataFrame:
    """Pairs with |r| > threshold, the ``top`` strongest, with the least-squares
    line of var2 on var1 (``np.polyfit`` degree 1): (var1, var2, correlation, slope, intercept)."""
    corr = correlation_matrix(df, cols)
    chosen = (_with_order(corr, cols).where(F.abs("correlation") > threshold)
              .orderBy(F.desc(F.abs("correlation")), "_i", "_j").limit(top).collect())
    spark = df.sparkSession
    schema = "var1 string, var2 string, correlation double, slope double, intercept double"
    if not chosen:
        return spark.createDataFrame([], schema)
    row = df.agg(*[a for k, r in enumerate(chosen) for a in (
        ST.ls_slope(F.col(r.var2), F.col(r.var1)).alias(f"s{k}"),
        ST.ls_intercept(F.col(r.var2), F.col(r.var1)).alias(f"i{k}"))]).first()
    return spark.createDataFrame(
        [(r.var1, r.var2, r.correlation, row[f"s{k}"], row[f"i{k}"]) for k, r in enumerate(chosen)], schema)


BOX_SCHEMA = ("q1 double, median double, q3 double, iqr double, lower_fence double, upper_fence double, "
              "whisker_low double, whisker_high double, n_fliers bigint")


def box_stats(df: DataFrame, cols: list[str] | None = None, quartiles: dict | None = None) -> DataFrame:
    """Quartiles, 1.5 IQR fences, whiskers (extreme data inside the fences),
    flier count per column. One quantile fit and one aggregate."""
    cols = cols or numeric_columns(df)
    q = _quartiles(df, cols, quartiles)
    fences = {}
    for c in cols:
        q1, q2, q3 = q[c]
        if q1 is None:
            continue
        iqr = q3 - q1
        fences[c] = (q1, q2, q3, iqr, q1 - 1.5 * iqr, q3 + 1.5 * iqr)
    spark = df.sparkSession
    if not fences:
        return spark.createDataFrame([], "variable string, " + BOX_SCHEMA)
    aggs = []
    for i, (c, (_, _, _, _, lo, hi)) in enumerate(fences.items()):
        x = F.col(c).cast("double")
        inside = (x >= lo) & (x <= hi)
        aggs += [F.min(F.when(inside, x)).alias(f"wl{i}"), F.max(F.when(inside, x)).alias(f"wh{i}"),
                 F.count_if((x < lo) | (x > hi)).alias(f"f{i}")]
    row = df.agg(*aggs).first()
    out = [(c,) + v + (row[f"wl{i}"], row[f"wh{i}"], row[f"f{i}"]) for i, (c, v) in enumerate(fences.items())]
    return spark.createDataFrame(out, "variable string, " + BOX_SCHEMA)


def grouped_box_stats(df: DataFrame, by: str, col: str) -> DataFrame:
    """E9 of ``col`` per group of ``by`` (groups bounded by MAX_GROUPS)."""
    spark = df.sparkSession
    q = quantiles(df, [col], [0.25, 0.5, 0.75], by=[by])
    if len(q) > MAX_GROUPS:
        raise ValueError("too many groups for grouped box statistics")
    rows = []
    for (g,), per in q.items():
        q1, q2, q3 = per[col]
        if q1 is None:
            continue
        iqr = q3 - q1
        rows.append((g, q1, q2, q3, iqr, q1 - 1.5 * iqr, q3 + 1.5 * iqr))
    fences = spark.createDataFrame(rows, T.StructType([
        T.StructField(by, df.schema[by].dataType), *[T.StructField(n, T.DoubleType()) for n in
                                                     ("q1", "median", "q3", "iqr", "lower_fence", "upper_fence")]]))
    x = F.col(col).cast("double")
    inside = (x >= F.col("lower_fence")) & (x <= F.col("upper_fence"))
    tail = (df.select(by, col).join(F.broadcast(fences), by)
            .groupBy(by).agg(F.min(F.when(inside, x)).alias("whisker_low"),
                             F.max(F.when(inside, x)).alias("whisker_high"),
                             F.count_if((x < F.col("lower_fence")) | (x > F.col("upper_fence")))
                             .cast("bigint").alias("n_fliers")))
    return fences.join(tail, by, "left")


def grouped_histogram(df: DataFrame, by: str, col: str, bins: int = 30) -> DataFrame:
    """``bins`` equal-width bins of ``col`` per group, each over the group's own range:
    (group, bin, bin_start, bin_end, count)."""
    ranges = (df.where(F.col(col).isNotNull()).groupBy(by)
              .agg(F.min(F.col(col).cast("double")).alias("mn"), F.max(F.col(col).cast("double")).alias("mx")))
    flat = F.col("mn") == F.col("mx")
    ranges = ranges.select(by, F.when(flat, F.col("mn") - 0.5).otherwise(F.col("mn")).alias("_mn"),
                           F.when(flat, F.col("mx") + 0.5).otherwise(F.col("mx")).alias("_mx"))
    ranges = ranges.withColumn("_norm", bins / (F.col("_mx") - F.col("_mn"))).withColumn("_step", (F.col("_mx") - F.col("_mn")) / bins)
    params, _ = bounded_lookup(ranges)               # broadcast if few, else a table joined by shuffle
    n = F.col("bin").cast("double")
    sc = params.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(
        by, "bin", (n * F.col("_step") + F.col("_mn")).alias("bin_start"),
        F.when(F.col("bin") == bins - 1, F.col("_mx")).otherwise((n + 1) * F.col("_step") + F.col("_mn")).alias("bin_end"))
    x = F.col(col).cast("double")
    i0 = F.least(F.greatest(F.floor((x - F.col("_mn")) * F.col("_norm")).cast("int"), F.lit(0)), F.lit(bins - 1))

    def edge(i):
        return F.when(i == bins, F.col("_mx")).otherwise(i.cast("double") * F.col("_step") + F.col("_mn"))

    b = F.coalesce(F.when(x < edge(i0), i0 - 1),
                   F.when((x >= edge(i0 + 1)) & (i0 != bins - 1), i0 + 1), i0)
    counts = (df.select(by, col).where(F.col(col).isNotNull()).join(params, by)
              .groupBy(by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    return (sc.join(counts, [by, "bin"], "left")
            .select(by, "bin", "bin_start", "bin_end", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def crosstab_share(df: DataFrame, a: str, b: str, scale: float = 1.0) -> DataFrame:
    """Share of each ``b`` within each ``a`` (``pd.crosstab(normalize='index')``),
    rows with a null in either dropped: (a, b, n, share)."""
    counts = (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
              .groupBy(a, b).agg(F.count(F.lit(1)).cast("bigint").alias("n")))
    w = Window.partitionBy(a)   # over the aggregated pairs only
    return counts.withColumn("share", F.col("n") / F.sum("n").over(w) * F.lit(scale))


def crosstab_top_groups(df: DataFrame, a: str, b: str, k: int = 8) -> DataFrame:
    """(a, b, n) counts for the ``k`` values of ``a`` with the most rows."""
    kept = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    top = top_k_groups(kept, a, k).select(a)
    return (kept.join(F.broadcast(top), a, "left_semi")
            .groupBy(a, b).agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def target_share(df: DataFrame, label: str) -> DataFrame:
    """(label, n, percentage) per outcome, nulls dropped (``value_counts``)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return counts.withColumn("percentage", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100)


def anova_f_scores(df: DataFrame, label: str, features: list[str], k: int = 15,
                   with_p: bool = True) -> DataFrame:
    """One-way ANOVA F of each feature across the classes of ``label``
    (sklearn ``f_classif``), from per-class count / mean / population variance
    (numerically stable), nulls filled with the feature median first; ranked,
    the best ``min(k, d)`` flagged as selected."""
    spark = df.sparkSession
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features]).first()
    need = [c for c in features if nulls[c]]
    med = global_quantiles(df, need, [0.5]) if need else {}
    x = {c: (F.coalesce(F.col(c).cast("double"), F.lit(med[c][0])) if c in med else F.col(c).cast("double"))
         for c in features}
    per = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        *[a for i, c in enumerate(features) for a in (F.avg(x[c]).alias(f"m{i}"), F.var_pop(x[c]).alias(f"v{i}"))])
    per = materialize(per)                           # one row a class, read twice
    size = per.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), *[
        (F.sum(F.when(F.col(f"m{i}").isNotNull(), F.col("n") * F.col(f"m{i}"))) / F.sum(F.when(F.col(f"m{i}").isNotNull(), F.col("n")))).alias(f"g{i}")
        for i in range(len(features))]).first()
    n_, k_ = int(size["n"] or 0), size["k"]
    sums = per.agg(*[a for i in range(len(features)) for a in (
        F.sum(F.col("n") * (F.col(f"m{i}") - F.lit(size[f"g{i}"]).cast("double")) ** 2).alias(f"b{i}"),
        F.sum(F.col("n") * F.col(f"v{i}")).alias(f"w{i}"))]).first()
    rows = []
    for i, c in enumerate(features):
        f, ssb, ssw = None, sums[f"b{i}"], sums[f"w{i}"]
        if ssb is not None and k_ >= 2 and n_ - k_ > 0:
            if ssw == 0:
                f = float("inf") if ssb > 0 else None
            else:
                f = (ssb / (k_ - 1)) / (ssw / (n_ - k_))
        p = ST.f_sf(f, k_ - 1, n_ - k_) if (with_p and f is not None and not math.isinf(f)) else None
        rows.append((c, f, p))
    ordered = sorted(rows, key=lambda r: (-(r[1] if r[1] is not None else -1.0), features.index(r[0])))
    top = min(k, len(features))
    out = [(c, f, p, rank + 1, rank < top) for rank, (c, f, p) in enumerate(ordered)]
    return spark.createDataFrame(out, "feature string, f_score double, p_value double, rank int, selected boolean")


def pearson_test(df: DataFrame, x: str, y: str) -> dict:
    """R, n, t, two-sided p, significant (< 0.05), effect size |r|, strength."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    row = df.agg(ST.pearson(F.col(x), F.col(y)).alias("r"), F.count_if(both).alias("n")).first()
    r, n = row["r"], row["n"]
    t = r * math.sqrt((n - 2) / (1 - r * r)) if r is not None and n > 2 and abs(r) < 1 else None
    p = ST.pearson_p_value(r, n)
    return {"correlation": r, "n": n, "t_statistic": t, "p_value": p,
            "significant": p is not None and p < 0.05, "effect_size": abs(r) if r is not None else None,
            "interpretation": ST.interpret_strength(abs(r) if r is not None else None)}


def pearson_frame(df: DataFrame, x: str, y: str) -> DataFrame:
    """E16 as a lazy one-row frame (correlation, n, t_statistic, effect_size, interpretation)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    one = df.agg(ST.pearson(F.col(x), F.col(y)).alias("correlation"),
                 F.count_if(both).cast("bigint").alias("n"))
    r = F.col("correlation")
    return one.select("correlation", "n",
                      (r * F.sqrt((F.col("n") - 2) / (1 - r * r))).alias("t_statistic"),
                      F.abs(r).alias("effect_size"),
                      ST.correlation_strength(F.abs(r)).alias("interpretation"))


def test_hypotheses(df: DataFrame, label: str = "final_result", clicks: str = "sum_click",
                    age: str = "age_band", age_ord: str | None = None) -> DataFrame:
    """H1 clicks <-> outcome code, H2 age code <-> outcome code.

    Outcome codes are alphabetical (as the reference's encoder); the age code
    comes from D21 unless ``age_ord`` names an existing numeric column. The input
    is not modified."""
    from .features import fit_label_encoders, apply_label_encoders, ordinal_map
    spark = df.sparkSession
    work = df
    if isinstance(df.schema[label].dataType, T.StringType):
        enc = fit_label_encoders(df, [label])
        work = apply_label_encoders(df.withColumn("_y", F.col(label)), enc.renamed(label, "_y"))
    else:
        work = df.withColumn("_y", F.col(label))
    rows = []
    if clicks in df.columns:
        h1 = pearson_test(work, clicks, "_y")
        rows.append(("H1_VLE_Performance", h1["correlation"], h1["p_value"], h1["significant"], h1["interpretation"]))
    else:
        rows.append(("H1_VLE_Performance", None, None, False, "N/A"))
    age_col = age_ord if age_ord and age_ord in df.columns else None
    if age_col is None and age in df.columns:
        work = ordinal_map(work, age, "_age")
        age_col = "_age"
    if age_col is not None:
        h2 = pearson_test(work, age_col, "_y")
        rows.append(("H2_Age_Performance", h2["correlation"], h2["p_value"], h2["significant"], h2["interpretation"]))
    else:
        rows.append(("H2_Age_Performance", None, None, False, "N/A"))
    return spark.createDataFrame(rows, "hypothesis string, correlation double, p_value double, "
                                       "significant boolean, interpretation string")


def ks_normality(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Kolmogorov-Smirnov against N(mean, sample std) per column with > 3 values:
    (variable, ks_statistic, ks_p_value, normal_ks).

    Every (column, value) is counted once, one range-partitioned running total over all
    columns gives the empirical distributions, and the largest gap to the normal one is
    an aggregate. Nulls and NaN are left out."""
    cols = cols or numeric_columns(df)
    spark = df.sparkSession
    number = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    row = df.agg(*[a for i, x in enumerate(number) for a in (
        F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"))]).first()
    fit = {i: (row[f"n{i}"], row[f"m{i}"], row[f"s{i}"]) for i in range(len(cols)) if row[f"n{i}"] > 3 and row[f"s{i}"]}
    schema = "variable string, ks_statistic double, ks_p_value double, normal_ks boolean"
    if not fit:
        return spark.createDataFrame([], schema)
    each = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), number[i].alias("v")) for i in fit])).alias("e"))
    seen = each.where("e.v is not null").groupBy(F.col("e.i").alias("i"), F.col("e.v").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    total = running_totals(seen, "v", ["c"], by=["i"])
    n, m, s = (F.coalesce(*[F.when(F.col("i") == i, F.lit(float(f[j]))) for i, f in fit.items()]) for j in range(3))
    placed = total.select("i", (F.col("cum_c") / n).alias("upto"), ((F.col("cum_c") - F.col("c")) / n).alias("below"),
                          ((F.col("v") - m) / s).alias("z")).withColumn("p", F.expr(ST.normal_cdf_sql("z")))
    gap = placed.groupBy("i").agg(F.max(F.greatest(F.abs(F.col("upto") - F.col("p")), F.abs(F.col("p") - F.col("below")))).alias("d"))
    out = []
    for r in sorted(gap.collect(), key=lambda r: r["i"]):              # one row a column
        p = ST.kolmogorov_p_value(r["d"], fit[r["i"]][0])
        out.append((cols[r["i"]], float(r["d"]), p, p > 0.05))
    return spark.createDataFrame(out, schema)


def normality_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """E19 joined with bias-corrected skewness and kurtosis."""
    cols = cols or numeric_columns(df)
    ks = ks_normality(df, cols)
    mo = moments(df, cols).select("variable", "skewness", "kurtosis")
    return ks.join(mo, "variable", "left")


def outlier_report(df: DataFrame, cols: list[str] | None = None, quartiles: dict | None = None) -> DataFrame:
    """Per column: total_values, IQR and |z| > 3 (population std) outlier counts
    and percentages, IQR bounds. One quantile fit and one aggregate."""
    cols = cols or numeric_columns(df)
    spark = df.sparkSession
    q = {c: (v[0], v[-1]) for c, v in _quartiles(df, cols, quartiles).items()}
    mom = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]).first()
    aggs, meta = [], []
    for i, c in enumerate(cols):
        q1, q3 = q[c]
        if q1 is None:
            continue
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        x = F.col(c).cast("double")
        m, s = mom[f"m{i}"], mom[f"s{i}"]
        z = F.count_if(F.abs((x - F.lit(m)) / F.lit(s)) > 3) if s else F.lit(0)
        aggs += [F.count(x).alias(f"n{i}"), F.count_if((x < lo) | (x > hi)).alias(f"o{i}"), z.alias(f"z{i}")]
        meta.append((i, c, lo, hi))
    if not meta:
        return spark.createDataFrame([], "variable string, total_values bigint, iqr_outliers bigint, "
                                         "iqr_percentage double, z_outliers bigint, z_percentage double, "
                                         "lower_bound double, upper_bound double")
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(
        F.lit(c).alias("variable"), F.col(f"n{i}").cast("bigint").alias("total_values"),
        F.col(f"o{i}").cast("bigint").alias("iqr_outliers"),
        (F.col(f"o{i}") / F.col(f"n{i}") * 100).alias("iqr_percentage"),
        F.col(f"z{i}").cast("bigint").alias("z_outliers"),
        (F.col(f"z{i}") / F.col(f"n{i}") * 100).alias("z_percentage"),
        F.lit(lo).cast("double").alias("lower_bound"), F.lit(hi).cast("double").alias("upper_bound"))
        for i, c, lo, hi in meta])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def eda_suite(df: DataFrame, quick: bool = True, keys: list[str] | None = None, label: str | None = None,
              sample_size: int = 10_000) -> dict:
    """Quick mode profiles an exact-size seeded sample, full mode the whole
    frame; returns a dict of report frames computed over one persisted input."""
    from .sampling import sample_rows
    src = sample_rows(df, keys, sample_size) if (quick and keys) else df
    src = src.persist()
    num = numeric_columns(src)
    quart = fit_quartiles(src, num)
    out = {"describe": describe_all(src, quartiles=quart), "correlation": correlation_matrix(src, num)}
    if not quick:
        out["box"] = box_stats(src, num, quart)
        out["outliers"] = outlier_report(src, num, quart)
        if label and label in src.columns:
            out["target_share"] = target_share(src, label)
            out["anova"] = anova_f_scores(src, label, num)
    return out
