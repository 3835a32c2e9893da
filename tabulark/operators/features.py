"""Feature engineering (D1-D22): time codes, outcome flags, label codes,
interaction terms, equal-width levels, group-relative features.

Fitted values (year quantile, min year, level edges, code tables, group means)
come from fused aggregate jobs; everything else is a native column expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.selection import global_quantiles
from ..session import bounded_lookup
from .clean import coerce_numeric
from .profile import numeric_columns

# Fixed values of the reference's feature step.
DEFAULT_YEAR = 2014
SEMESTER_CODES = {"B": 1, "J": 2}
OUTCOME_FLAGS = {"is_pass": "Pass", "is_distinction": "Distinction",
                 "is_withdrawn": "Withdrawn", "is_fail": "Fail"}
SUCCESS_VALUES = ("Pass", "Distinction")
ENCODE_COLUMNS = ["final_result", "age_band", "imd_band", "disability", "gender", "region",
                  "highest_education", "code_module", "semester"]
ENCODE_COLUMNS_REQ2 = ["final_result", "age_band", "imd_band", "disability", "gender", "region",
                       "highest_education", "code_module", "assessment_type", "semester"]
LEVEL_LABELS = ["Low", "Medium", "High"]
NULL_TEXT = "nan"
MAX_LITERAL_CODES = 100
MAX_CODES = 100_000
AGE_MAPPINGS = [
    {"0-35": 1, "35-55": 2, "55<=": 3},
    {"Under 35": 1, "35-55": 2, "Over 55": 3},
    {"<35": 1, "35-55": 2, ">55": 3},
    {"Young": 1, "Middle": 2, "Old": 3},
    {"Low": 1, "Medium": 2, "High": 3},
]


def _strip(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")


# ------------------------------------------------------------------ D1, D2, D4
def presentation_year(c: str | Column, default: int = DEFAULT_YEAR) -> Column:
    """First four characters of the trimmed code as an integer, else ``default``."""
    c = F.col(c) if isinstance(c, str) else c
    head = F.substring(_strip(c), 1, 4)
    num = F.nanvl(head.try_cast("double"), F.lit(None).cast("double"))
    return F.coalesce(num.cast("int"), F.lit(default))


def presentation_semester(c: str | Column) -> Column:
    """Last character of the trimmed code (null when empty)."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.coalesce(_strip(c), F.lit("None"))
    return F.when(F.length(t) > 0, F.substring(t, -1, 1))


def semester_numeric(c: str | Column) -> Column:
    """B -> 1, J -> 2, anything else -> 0."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.lit(0)
    for k, v in reversed(list(SEMESTER_CODES.items())):
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out.cast("int")


@dataclass
class TimeParams:
    year_q75: float | None
    min_year: int | None


def fit_time(df: DataFrame, year_col: str = "year") -> TimeParams:
    """D3/D5 fit: 75th percentile and minimum of the year (exact)."""
    q = global_quantiles(df, [year_col], [0.75])[year_col][0]
    mn = df.agg(F.min(year_col)).first()[0]
    return TimeParams(q, mn)


def add_time_features(df: DataFrame, code_col: str = "code_presentation", advanced: bool = True,
                      params: TimeParams | None = None) -> tuple[DataFrame, TimeParams | None]:
    """Year, semester, is_recent_year, semester_numeric, years_since_start."""
    if code_col not in df.columns:
        return df, params
    code = F.coalesce(F.col(code_col).cast("string"), F.lit("None"))
    out = df.withColumn(code_col, code) \
            .withColumn("year", presentation_year(code)) \
            .withColumn("semester", presentation_semester(code))
    if not advanced:
        return out, params
    params = params or fit_time(out, "year")
    out = (out.withColumn("is_recent_year", (F.col("year") >= F.lit(params.year_q75)).cast("int"))
              .withColumn("semester_numeric", semester_numeric("semester"))
              .withColumn("years_since_start", (F.col("year") - F.lit(params.min_year)).cast("int")))
    return out, params


# ------------------------------------------------------------------- D6-D8
def outcome_flags(df: DataFrame, label: str = "final_result", flags: dict = OUTCOME_FLAGS,
                  success=SUCCESS_VALUES, keep_original: bool = True) -> DataFrame:
    """Original label text, one 0/1 flag per outcome, academic success."""
    c = F.col(label)
    cols = []
    if keep_original:
        cols.append(F.coalesce(c.cast("string"), F.lit("None")).alias(f"{label}_original"))
    for name, value in flags.items():
        cols.append(F.coalesce((c == value).cast("int"), F.lit(0)).alias(name))
    cols.append(F.coalesce(c.isin(*success).cast("int"), F.lit(0)).alias("academic_success"))
    return df.select("*", *cols)


# ------------------------------------------------------------------- D9, D22
@dataclass
class Encoders:
    classes: dict = field(default_factory=dict)     # column -> sorted labels
    null_text: str = NULL_TEXT
    tables: dict = field(default_factory=dict)      # column -> (value, code) frame, large columns

    def renamed(self, old: str, new: str) -> Encoders:
        """One column's codes under another name."""
        pick = lambda d: {new: d[old]} if old in d else {}
        return Encoders(pick(self.classes), self.null_text, pick(self.tables))


def _as_text(c: str, null_text: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(null_text))


def fit_label_encoders(df: DataFrame, cols: list[str], null_text: str = NULL_TEXT,
                       max_codes: int = MAX_CODES) -> Encoders:
    """D9 fit: sorted distinct text values per column, one job for all columns.

    The distinct (column, value) pairs are found with a partial aggregation. A
    column with at most ``max_codes`` values is collected to the driver; a larger
    one keeps its code table distributed (ranked by a range-partitioned running
    count, checkpointed) and is joined back by shuffle."""
    cols = [c for c in cols if c in df.columns]
    enc = Encoders(null_text=null_text)
    if not cols:
        return enc
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ci"), _as_text(c, null_text).alias("v")) for i, c in enumerate(cols)
    ])).alias("p")).select("p.ci", "p.v").distinct().persist()
    sizes = {r["ci"]: r["n"] for r in pairs.groupBy("ci").agg(F.count(F.lit(1)).alias("n")).collect()}
    small = [i for i in range(len(cols)) if sizes.get(i, 0) <= max_codes]
    large = [i for i in range(len(cols)) if sizes.get(i, 0) > max_codes]
    per = {i: [] for i in small}
    if small:
        for r in pairs.where(F.col("ci").isin(*small)).collect():
            per[r["ci"]].append(r["v"])
    for i in small:
        # Spark compares strings by UTF-8 bytes, which is code point order, like Python
        enc.classes[cols[i]] = sorted(per[i])
    for i in large:
        # beyond the bound the code table stays distributed: ranks come from a
        # range-partitioned running count, and the table is checkpointed
        from ..functions.cumulative import running_totals
        from ..session import materialize
        vals = pairs.where(F.col("ci") == i).select("v", F.lit(1).cast("bigint").alias("one"))
        codes = running_totals(vals, "v", ["one"]).select(
            F.col("v").alias("__val"), (F.col("cum_one") - 1).cast("int").alias("__code"))
        enc.tables[cols[i]] = materialize(codes)
    pairs.unpersist()
    return enc


def apply_label_encoders(df: DataFrame, enc: Encoders) -> DataFrame:
    """D9 apply: replace each encoded column with its 0-based code.

    Small code tables become a literal map lookup, medium ones a broadcast join of
    the (value, code) table (size bounded at fit time), distributed ones a shuffle join."""
    out = df
    for c, table in enc.tables.items():
        if c in out.columns:
            t = table.withColumnRenamed("__val", f"__val_{c}").withColumnRenamed("__code", f"__code_{c}")
            out = (out.withColumn(f"__txt_{c}", _as_text(c, enc.null_text))
                   .join(t, F.col(f"__txt_{c}") == F.col(f"__val_{c}"), "left")
                   .withColumn(c, F.col(f"__code_{c}"))
                   .drop(f"__txt_{c}", f"__val_{c}", f"__code_{c}"))
    for c, labels in enc.classes.items():
        if c not in out.columns:
            continue
        text = _as_text(c, enc.null_text)
        if len(labels) <= MAX_LITERAL_CODES:
            m = F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(v), F.lit(i))])
            out = out.withColumn(c, F.element_at(m, text).cast("int"))
        else:
            spark = df.sparkSession
            table = spark.createDataFrame(list(enumerate(labels)), f"`__code_{c}` int, `__val_{c}` string")
            out = (out.withColumn(f"__txt_{c}", text)
                   .join(F.broadcast(table), F.col(f"__txt_{c}") == F.col(f"__val_{c}"), "left")
                   .withColumn(c, F.col(f"__code_{c}"))
                   .drop(f"__txt_{c}", f"__val_{c}", f"__code_{c}"))
    return out


def label_encode(df: DataFrame, cols: list[str], null_text: str = NULL_TEXT) -> tuple[DataFrame, Encoders]:
    enc = fit_label_encoders(df, cols, null_text)
    return apply_label_encoders(df, enc), enc


def encoders_frame(spark, enc: Encoders) -> DataFrame:
    """(column_name, label, code) for every fitted encoder."""
    rows = [(c, v, i) for c, labels in enc.classes.items() for i, v in enumerate(labels)]
    out = spark.createDataFrame(rows, "column_name string, label string, code int")
    for c, table in enc.tables.items():
        out = out.unionByName(table.select(F.lit(c).alias("column_name"), F.col("__val").alias("label"),
                                           F.col("__code").alias("code")))
    return out


# ---------------------------------------------------------------- D10-D14
def interaction_score(a: str, b: str) -> Column:
    """Product of two coerced numerics (null/unparseable -> 0)."""
    return coerce_numeric(a) * coerce_numeric(b)


@dataclass
class LevelParams:
    edges: tuple | None      # (e1, e2) upper edges of Low and Medium, or None if max == min


def fit_levels(df: DataFrame, col: str) -> LevelParams:
    """D11 fit: three equal-width bins over [min, max] (pandas ``cut(bins=3)``)."""
    row = df.agg(F.min(coerce_numeric(col)).alias("mn"), F.max(coerce_numeric(col)).alias("mx")).first()
    mn, mx = row["mn"], row["mx"]
    if mn is None or not mx > mn:
        return LevelParams(None)
    step = (mx - mn) / 3
    return LevelParams((mn + step * 1.0, mn + step * 2.0))


def participation_level(col: str, params: LevelParams) -> Column:
    """D11 apply: right-closed bins, codes in alphabetical label order:
    High = 0, Low = 1, Medium = 2."""
    x = coerce_numeric(col)
    e1, e2 = params.edges
    return F.when(x <= F.lit(e1), F.lit(1)).when(x <= F.lit(e2), F.lit(2)).otherwise(F.lit(0)).cast("int")


def log1p_clicks(col: str) -> Column:
    """ln(x + 1) for x >= 0, else (and for null) 0."""
    x = F.col(col).cast("double")
    return F.when(x >= 0, F.log(x + F.lit(1.0))).otherwise(F.lit(0.0))


def socioeconomic_score(imd: str, edu: str) -> Column:
    """0.6 * code(imd) + 0.4 * code(education), codes after D9."""
    return coerce_numeric(imd) * 0.6 + coerce_numeric(edu) * 0.4


def attempt_flags(col: str) -> list[Column]:
    """is_first_attempt (= 0), is_experienced_student (>= 2); null -> 0 attempts."""
    a = coerce_numeric(col)
    return [(a == 0).cast("int").alias("is_first_attempt"),
            (a >= 2).cast("int").alias("is_experienced_student")]


# ------------------------------------------------------------------ D15, D16
def group_mean_feature(df: DataFrame, key: str, value: str, name: str = "module_avg_clicks",
                       coerce: bool = True) -> DataFrame:
    """Mean of ``value`` per ``key`` joined back (left join).

    The means are a partial (map-side) aggregation; the per-key table is
    broadcast when its row count is proven small, else joined by shuffle. A
    window would instead shuffle and sort every row."""
    v = coerce_numeric(value) if coerce else F.col(value)
    means = df.groupBy(key).agg(F.avg(v).alias(name))
    lookup, _ = bounded_lookup(means)
    renamed = lookup.withColumnRenamed(key, f"__gk_{key}")
    return (df.join(renamed, df[key].eqNullSafe(renamed[f"__gk_{key}"]), "left")
            .drop(f"__gk_{key}"))


def diff_from_group_mean(value: str, mean_col: str) -> Column:
    """D16."""
    return coerce_numeric(value) - F.col(mean_col)


# -------------------------------------------------------------------- D17, D18
def feature_stats(df: DataFrame, exclude: tuple = ("final_result", "id_student")) -> DataFrame:
    """(feature, min, max, mean) for every numeric column but the excluded ones."""
    cols = numeric_columns(df, exclude)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "feature string, min double, max double, mean double")
    one = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.min(F.col(c).cast("double")).alias(f"a{i}"), F.max(F.col(c).cast("double")).alias(f"b{i}"),
        F.avg(F.col(c).cast("double")).alias(f"m{i}"))])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("min"), F.col(f"b{i}").alias("max"),
                 F.col(f"m{i}").alias("mean")) for i, c in enumerate(cols)])).alias("s")).select("s.*")


def preprocessing_report(spark, cleaning: dict, numeric_features: list[str]) -> DataFrame:
    """(metric, value) rows."""
    rows = [("initial_records", float(cleaning.get("initial_records", 0) or 0)),
            ("final_records", float(cleaning.get("final_records", 0) or 0)),
            ("data_quality_score", float(cleaning.get("data_quality_score", 0) or 0)),
            ("features_added", float(len(numeric_features)))]
    return spark.createDataFrame(rows, "metric string, value double")


# ------------------------------------------------------------------ D20, D21
def fit_one_hot(df: DataFrame, cols: list[str]) -> dict:
    enc = fit_label_encoders(df, cols, null_text="__null__")
    if enc.tables:
        raise ValueError(f"one-hot would add over {MAX_CODES} columns each for {sorted(enc.tables)}; encode them as codes")
    return {c: [v for v in labels if v != "__null__"] for c, labels in enc.classes.items()}


def one_hot(df: DataFrame, cols: list[str], levels: dict | None = None) -> DataFrame:
    """Dummies for every level but the first (sorted), named ``<col>_<level>``;
    a null row is 0 in every dummy; the source columns are replaced."""
    levels = levels or fit_one_hot(df, cols)
    out = []
    for f in df.schema.fields:
        if f.name in levels:
            for v in levels[f.name][1:]:
                out.append(F.coalesce((F.col(f.name).cast("string") == v).cast("int"), F.lit(0))
                           .alias(f"{f.name}_{v}"))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def fit_ordinal_map(df: DataFrame, col: str, mappings: list[dict] = AGE_MAPPINGS) -> dict | None:
    """D21 fit: the first dictionary with any hit (one job counts all of them)."""
    c = F.col(col).cast("string")
    row = df.agg(*[F.count_if(c.isin(*m.keys())).alias(f"h{i}") for i, m in enumerate(mappings)]).first()
    for i, m in enumerate(mappings):
        if row[f"h{i}"]:
            return m
    return None


def ordinal_map(df: DataFrame, col: str, out_col: str | None = None,
                mappings: list[dict] = AGE_MAPPINGS, max_codes: int = MAX_CODES) -> DataFrame:
    """Ordinal codes from the first matching dictionary, else alphabetical
    codes with nulls as ``Unknown``."""
    out_col = out_col or f"{col}_ord"
    m = fit_ordinal_map(df, col, mappings)
    if m is not None:
        lookup = F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(float(v)))])
        return df.withColumn(out_col, F.element_at(lookup, F.col(col).cast("string")))
    enc = fit_label_encoders(df, [col], null_text="Unknown", max_codes=max_codes)
    coded = apply_label_encoders(df.withColumn(out_col, F.col(col)), enc.renamed(col, out_col))
    return coded.withColumn(out_col, F.col(out_col).cast("double"))


# ------------------------------------------------------------------------ D19
@dataclass
class FeatureResult:
    df: DataFrame
    encoders: Encoders
    time: TimeParams | None
    levels: LevelParams | None
    numeric_features: list
    stats: DataFrame | None


def create_features(df: DataFrame, requirement: int = 1, advanced: bool = True,
                    label: str = "final_result", clicks: str = "sum_click",
                    module: str = "code_module", code_col: str = "code_presentation",
                    encode_columns: list[str] | None = None, rows: int | None = None,
                    drop_leaky: bool = False, group_min_rows: int | None = None) -> FeatureResult:
    """The reference's feature order. Group features are always built, unless
    ``group_min_rows`` (1000 in the reference) is given and ``rows`` (counted if not
    known from cleaning) doesn't exceed it. ``drop_leaky=True`` removes the outcome flags
    that restate the label (quirk Q2); the default reproduces the reference."""
    out, tparams = add_time_features(df, code_col, advanced)
    if label in out.columns:
        out = outcome_flags(out, label) if advanced else out.withColumn(
            f"{label}_original", F.coalesce(F.col(label).cast("string"), F.lit("None")))
    enc_cols = encode_columns or (ENCODE_COLUMNS_REQ2 if requirement == 2 else ENCODE_COLUMNS)
    enc_cols = [c for c in enc_cols if c in out.columns]
    enc = fit_label_encoders(out, enc_cols)
    out = apply_label_encoders(out, enc)
    if "total_n_days" in out.columns and "avg_total_sum_clicks" in out.columns:
        out = out.withColumn("overall_interaction_score",
                             interaction_score("total_n_days", "avg_total_sum_clicks"))
    lparams = None
    if advanced:
        if clicks in out.columns:
            out = out.withColumn(clicks, coerce_numeric(clicks))
            lparams = fit_levels(out, clicks)
            if lparams.edges is not None:
                out = out.withColumn("participation_level", participation_level(clicks, lparams))
            out = out.withColumn(f"log_{clicks}", log1p_clicks(clicks))
        if "imd_band" in out.columns and "highest_education" in out.columns:
            out = out.withColumn("socioeconomic_education_score",
                                 socioeconomic_score("imd_band", "highest_education"))
        if "num_of_prev_attempts" in out.columns:
            out = out.select("*", *attempt_flags("num_of_prev_attempts"))
        many = group_min_rows is None or (rows if rows is not None else out.count()) > group_min_rows
        if many and module in out.columns and clicks in out.columns:
            out = group_mean_feature(out, module, clicks, "module_avg_clicks")
            out = out.withColumn("clicks_vs_module_avg", diff_from_group_mean(clicks, "module_avg_clicks"))
    if drop_leaky:
        out = out.drop(*OUTCOME_FLAGS.keys(), "academic_success")
    numeric = numeric_columns(out, (label, "id_student"))
    return FeatureResult(out, enc, tparams, lparams, numeric, None)
