"""Cleaning: drop, impute, deduplicate, clip outliers, narrow types.

Each fitted step is ``fit_*`` (a few fused aggregate jobs returning plain
parameters) and ``apply_*`` (native column expressions, so a fitted step can
be reused on a test split or a stream).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.selection import global_quantiles
from . import profile as P

# Fixed values taken from the reference's behaviour.
CRITICAL_COLUMNS = ("imd_band", "final_result", "id_student", "code_module")
OUTLIER_NAMES = ("num_of_prev_attempts", "studied_credits")
OUTLIER_PREFIXES = ("n_day", "avg_sum", "sum_click")
IMPUTE_MAX_NULL_FRACTION = 0.5
DEFAULT_FILL_TEXT = "Unknown"


# --------------------------------------------------------------------------- C5
def drop_missing_critical(df: DataFrame, critical=CRITICAL_COLUMNS) -> DataFrame:
    """Drop rows null in any critical column that exists."""
    present = [c for c in critical if c in df.columns]
    return df.na.drop(subset=present) if present else df


# ---------------------------------------------------------------------- C6, C7
@dataclass
class ImputeParams:
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    skipped: dict = field(default_factory=dict)   # column -> null fraction >= 0.5
    rows: int = 0                                  # rows the fractions were taken over


def fit_mode(df: DataFrame, cols: list[str]) -> dict:
    """Most frequent non-null value per column, the smallest one on ties.

    One job for all columns: (column, value) pairs are counted with a partial
    aggregation, then reduced per column with ``min(struct(-count, value))``;
    no per-column value map is ever held by one task."""
    if not cols:
        return {}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ci"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)
    ])).alias("p")).select("p.ci", "p.v").where(F.col("v").isNotNull())
    counts = pairs.groupBy("ci", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("ci").agg(F.min(F.struct((-F.col("n")).alias("negn"), F.col("v"))).alias("b"))
    found = {r["ci"]: r["b"]["v"] for r in best.collect()}
    return {c: found.get(i) for i, c in enumerate(cols)}


def fit_impute(df: DataFrame, max_fraction: float = IMPUTE_MAX_NULL_FRACTION) -> ImputeParams:
    """C6/C7 fit: medians for numeric and modes for string columns whose null
    fraction is in (0, max_fraction). Fractions are over ``df`` as given (after C5)."""
    df = P._nan_to_null(df)
    num = P.numeric_columns(df)
    txt = P.string_columns(df)
    cols = num + txt
    params = ImputeParams()
    if not cols:
        params.rows = df.count()
        return params
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    rows = row["__rows"]
    params.rows = rows
    fill_num, fill_txt = [], []
    for i, c in enumerate(cols):
        nulls = row[f"n{i}"]
        if not nulls:
            continue
        frac = nulls / rows
        if frac < max_fraction:
            (fill_num if c in num else fill_txt).append(c)
        else:
            params.skipped[c] = frac
    if fill_num:
        q = global_quantiles(df, fill_num, [0.5])
        params.medians = {c: q[c][0] for c in fill_num}
    if fill_txt:
        modes = fit_mode(df, fill_txt)
        params.modes = {c: (m if m is not None else DEFAULT_FILL_TEXT) for c, m in modes.items()}
    return params


def apply_impute(df: DataFrame, params: ImputeParams) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in params.medians and params.medians[f.name] is not None:
            base = F.nanvl(c, F.lit(None).cast(f.dataType)) if isinstance(
                f.dataType, (T.DoubleType, T.FloatType)) else c
            out.append(F.coalesce(base.cast("double"), F.lit(float(params.medians[f.name])))
                       .alias(f.name))
        elif f.name in params.modes:
            out.append(F.coalesce(c, F.lit(params.modes[f.name])).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def impute(df: DataFrame, max_fraction: float = IMPUTE_MAX_NULL_FRACTION) -> DataFrame:
    """C6 + C7."""
    return apply_impute(df, fit_impute(df, max_fraction))


# ---------------------------------------------------------------------- C8, C9
def drop_duplicates(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def coerce_numeric(c: Column | str, fill: float | None = 0.0) -> Column:
    """Unparseable -> null -> ``fill`` (pandas ``to_numeric(errors='coerce').fillna``)."""
    c = F.col(c) if isinstance(c, str) else c
    x = c.try_cast("double")
    x = F.nanvl(x, F.lit(None).cast("double"))
    return F.coalesce(x, F.lit(fill)) if fill is not None else x


# ------------------------------------------------------------------------- C10
def outlier_columns(columns: list[str], requirement: int = 1, names=OUTLIER_NAMES,
                    prefixes=OUTLIER_PREFIXES) -> list[str]:
    """Named columns plus columns starting with a prefix, sorted.

    ``score`` is listed for requirement 3 (as in the reference) but never treated."""
    chosen = sorted({c for c in columns if c in names or any(c.startswith(p) for p in prefixes)}
                    | {c for c in names})
    if requirement == 3 and "score" in columns:
        chosen.append("score")
    return chosen


# -------------------------------------------------------------------- C11-C14
@dataclass
class OutlierParams:
    method: str
    bounds: dict = field(default_factory=dict)     # column -> dict of fitted values
    null_as_zero: bool = True


def _numeric_view(df: DataFrame, cols: list[str], null_as_zero: bool) -> DataFrame:
    return df.select(*[coerce_numeric(c, 0.0 if null_as_zero else None).alias(c) for c in cols])


def fit_outliers(df: DataFrame, cols: list[str], method: str = "iqr", percentile: float = 0.98,
                 null_as_zero: bool = True) -> OutlierParams:
    """C11-C13 fit for all columns at once (one quantile fit + one moments pass)."""
    cols = [c for c in cols if c in df.columns and c != "score"]
    params = OutlierParams(method, null_as_zero=null_as_zero)
    if not cols:
        return params
    view = _numeric_view(df, cols, null_as_zero)
    if method == "iqr":
        q = global_quantiles(view, cols, [0.25, 0.75])
        for c in cols:
            q1, q3 = q[c]
            if q1 is None:
                continue
            iqr = q3 - q1
            params.bounds[c] = {"q1": q1, "q3": q3, "lower_bound": q1 - 1.5 * iqr,
                                "upper_bound": q3 + 1.5 * iqr}
    elif method == "percentile":
        q = global_quantiles(view, cols, [1 - percentile, percentile])
        for c in cols:
            lo, hi = q[c]
            if lo is None:
                continue
            params.bounds[c] = {"lower_bound": lo, "upper_bound": hi}
    elif method == "zscore":
        row = view.agg(*[a for i, c in enumerate(cols) for a in (
            F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]).first()
        q = global_quantiles(view, cols, [0.05, 0.5, 0.95])
        for i, c in enumerate(cols):
            q05, q50, q95 = q[c]
            if q05 is None:
                continue
            params.bounds[c] = {"mean": row[f"m{i}"], "std": row[f"s{i}"], "q05": q05,
                                "median": q50, "q95": q95, "threshold": 3.0}
    else:
        raise ValueError(f"unknown outlier method {method!r}; use 'percentile', 'iqr' or 'zscore'")
    return params


def outlier_expr(c: str, b: dict, method: str, null_as_zero: bool = True) -> Column:
    x = coerce_numeric(c, 0.0 if null_as_zero else None)
    if method in ("iqr", "percentile"):
        return F.least(F.greatest(x, F.lit(b["lower_bound"])), F.lit(b["upper_bound"]))
    std = b["std"]
    if not std or std == 0 or std != std:
        return x    # zero variance: z is undefined, nothing is an outlier
    z = F.abs((x - F.lit(b["mean"])) / F.lit(std))
    return (F.when(z > b["threshold"],
                   F.when(x > F.lit(b["median"]), F.lit(b["q95"])).otherwise(F.lit(b["q05"])))
            .otherwise(x))


def is_outlier_expr(c: str, b: dict, method: str, null_as_zero: bool = True) -> Column:
    x = coerce_numeric(c, 0.0 if null_as_zero else None)
    if method in ("iqr", "percentile"):
        return (x < F.lit(b["lower_bound"])) | (x > F.lit(b["upper_bound"]))
    std = b["std"]
    if not std or std == 0 or std != std:
        return F.lit(False)
    return F.abs((x - F.lit(b["mean"])) / F.lit(std)) > b["threshold"]


def apply_outliers(df: DataFrame, params: OutlierParams) -> DataFrame:
    out = []
    for c in df.columns:
        if c in params.bounds:
            out.append(outlier_expr(c, params.bounds[c], params.method, params.null_as_zero).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def clip_iqr(df: DataFrame, cols: list[str]) -> DataFrame:
    """C11."""
    return apply_outliers(df, fit_outliers(df, cols, "iqr"))


def clip_percentile(df: DataFrame, cols: list[str], percentile: float = 0.98) -> DataFrame:
    """C12."""
    return apply_outliers(df, fit_outliers(df, cols, "percentile", percentile))


def replace_zscore(df: DataFrame, cols: list[str]) -> DataFrame:
    """C13."""
    return apply_outliers(df, fit_outliers(df, cols, "zscore"))


def outlier_bounds(df: DataFrame, params: OutlierParams) -> DataFrame:
    """C14: (variable, method, lower_bound, upper_bound, outliers_count) per treated column."""
    cols = list(params.bounds)
    spark = df.sparkSession
    schema = "variable string, method string, lower_bound double, upper_bound double, outliers_count bigint"
    if not cols:
        return spark.createDataFrame([], schema)
    counts = df.agg(*[F.count_if(is_outlier_expr(c, params.bounds[c], params.method,
                                                 params.null_as_zero)).alias(f"c{i}")
                      for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.lit(params.method).alias("method"),
                              F.lit(params.bounds[c].get("lower_bound")).cast("double").alias("lower_bound"),
                              F.lit(params.bounds[c].get("upper_bound")).cast("double").alias("upper_bound"),
                              F.col(f"c{i}").cast("bigint").alias("outliers_count"))
                     for i, c in enumerate(cols)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


# ------------------------------------------------------------------------- C16
def fit_replace_infinite(df: DataFrame) -> dict:
    """C16 fit: if any numeric cell is +-inf, the median (after inf -> null) of
    every numeric column that then has nulls; ``{}`` when there is no infinity."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    allnum = P.numeric_columns(df)
    if not cols:
        return {}
    inf = float("inf")
    row = df.agg(*[F.count_if(F.abs(F.col(c)) == inf).alias(f"i{i}") for i, c in enumerate(cols)]).first()
    if not any(row[f"i{i}"] for i in range(len(cols))):
        return {}
    view = _infinite_to_null(df)
    nulls = view.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(allnum)]).first()
    need = [c for i, c in enumerate(allnum) if nulls[f"n{i}"]]
    q = global_quantiles(view, need, [0.5]) if need else {}
    return {c: q[c][0] for c in need}


def _infinite_to_null(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.abs(c) == float("inf"), F.lit(None).cast(f.dataType)).otherwise(
                F.nanvl(c, F.lit(None).cast(f.dataType)))
        out.append(c.alias(f.name))
    return df.select(*out)


def apply_replace_infinite(df: DataFrame, medians: dict) -> DataFrame:
    if not medians:
        return df
    view = _infinite_to_null(df)
    return view.select(*[
        (F.coalesce(F.col(c), F.lit(medians[c]).cast(view.schema[c].dataType)).alias(c)
         if c in medians and medians[c] is not None else F.col(c)) for c in view.columns])


def replace_infinite(df: DataFrame) -> DataFrame:
    """+-inf -> null -> column median (only when an infinity exists)."""
    return apply_replace_infinite(df, fit_replace_infinite(df))


# ------------------------------------------------------------------------- C20
def narrow_types(df: DataFrame, floats: bool = True) -> DataFrame:
    """C20: smallest signed integer type holding each integral column's range,
    doubles to float (``floats=False`` keeps doubles). One min/max job."""
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    casts = {}
    if ints:
        row = df.agg(*[a for i, c in enumerate(ints)
                       for a in (F.min(c).alias(f"a{i}"), F.max(c).alias(f"b{i}"))]).first()
        for i, c in enumerate(ints):
            lo, hi = row[f"a{i}"], row[f"b{i}"]
            if lo is None:
                continue
            if lo >= 0:
                # unsigned in the reference: one signed step wider here
                t = "short" if hi < 255 else "int" if hi < 65535 else "bigint"
            else:
                # the reference wraps a range beyond int32 into int32; values are kept here
                t = ("tinyint" if lo > -128 and hi < 127 else
                     "short" if lo > -32768 and hi < 32767 else
                     "int" if lo >= -2**31 and hi < 2**31 else "bigint")
            casts[c] = t
    out = []
    for f in df.schema.fields:
        if f.name in casts:
            out.append(F.col(f.name).cast(casts[f.name]).alias(f.name))
        elif floats and isinstance(f.dataType, T.DoubleType):
            out.append(F.col(f.name).cast("float").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# --------------------------------------------------------------------- C18/C19
@dataclass
class CleanResult:
    df: DataFrame
    report: dict
    numerical_variables: list
    impute: ImputeParams
    outliers: OutlierParams
    infinite_medians: dict


REPORT_SCHEMA = T.StructType([
    T.StructField("initial_records", T.LongType()),
    T.StructField("initial_features", T.LongType()),
    T.StructField("initial_nulls", T.LongType()),
    T.StructField("initial_duplicates", T.LongType()),
    T.StructField("columns_dropped", T.ArrayType(T.StringType())),
    T.StructField("records_after_null_cleaning", T.LongType()),
    T.StructField("duplicates_removed", T.LongType()),
    T.StructField("outliers_treated", T.LongType()),
    T.StructField("numerical_variables", T.ArrayType(T.StringType())),
    T.StructField("final_records", T.LongType()),
    T.StructField("final_features", T.LongType()),
    T.StructField("final_nulls", T.LongType()),
    T.StructField("records_removed", T.LongType()),
    T.StructField("features_removed", T.LongType()),
    T.StructField("data_quality_score", T.DoubleType()),
])


def clean_dataset(df: DataFrame, requirement: int = 1, outlier_method: str = "iqr",
                  advanced: bool = True, target: str = "final_result",
                  critical=CRITICAL_COLUMNS, outlier_names=OUTLIER_NAMES,
                  outlier_prefixes=OUTLIER_PREFIXES, persist: bool = True) -> CleanResult:
    """The reference's cleaning order.

    profile -> drop all-null/constant columns -> drop rows missing critical
    values -> impute (fractions after the row drop) -> deduplicate -> treat
    outliers (quantiles on deduplicated rows) -> infinities -> final profile.
    Jobs: 1 profile, 1 null count + quantile/mode fits, 1 outlier fit (2-3 jobs),
    1 change count, 1 infinity check, 1 final profile.
    """
    report = {}
    source = df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df      # until its distinct rows are held
    first = P.profile(df)
    report.update(initial_records=first.rows, initial_features=len(df.columns),
                  initial_nulls=first.total_nulls, initial_duplicates=first.duplicates)
    dropped = P.columns_to_drop(first, advanced, keep=(target,))
    cur = df.drop(*dropped)
    report["columns_dropped"] = dropped
    cur = drop_missing_critical(cur, critical)
    imp = fit_impute(cur)
    cur = apply_impute(cur, imp)
    cur = drop_duplicates(cur)
    if persist:
        cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
    numerical = outlier_columns(cur.columns, requirement, outlier_names, outlier_prefixes)
    treat = [c for c in numerical if c in cur.columns and c != "score"]
    out_params = fit_outliers(cur, treat, outlier_method)
    counts_row = cur.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(~F.col(c).cast("double").eqNullSafe(
            outlier_expr(c, out_params.bounds[c], outlier_method))).alias(f"c{i}")
          for i, c in enumerate(treat) if c in out_params.bounds]).first()
    if persist:
        source.unpersist()
    dedup_rows = counts_row["__rows"]
    changes = sum(counts_row[f"c{i}"] for i, c in enumerate(treat) if c in out_params.bounds)
    cur = apply_outliers(cur, out_params)
    inf_medians = fit_replace_infinite(cur)
    cur = apply_replace_infinite(cur, inf_medians)
    last = P.profile(cur)
    report.update(
        records_after_null_cleaning=imp.rows,
        duplicates_removed=imp.rows - dedup_rows,
        outliers_treated=int(changes),
        numerical_variables=numerical,
        final_records=last.rows,
        final_features=len(cur.columns),
        final_nulls=last.total_nulls,
        records_removed=first.rows - last.rows,
        features_removed=len(df.columns) - len(cur.columns),
        data_quality_score=last.quality_score(),
    )
    return CleanResult(cur, report, numerical, imp, out_params, inf_medians)


def cleaning_report(spark, report: dict) -> DataFrame:
    """The report as a one-row frame."""
    row = tuple(report.get(f.name) for f in REPORT_SCHEMA.fields)
    return spark.createDataFrame([row], REPORT_SCHEMA)
