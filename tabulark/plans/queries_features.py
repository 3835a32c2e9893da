"""Registered queries: feature engineering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import features as FE
from ..operators import profile as P
from . import frames as FR
from .registry import r6, register, rounded

A = FR.ACTIVITY_SQL
PA = f"SELECT *, {FR.PRESENTATION_SQL_EXPR} AS code_presentation FROM ({A}) a"
K = "l_orderkey, l_linenumber"
T = "trim(COALESCE(code_presentation, 'None'))"
YEAR_SQL = f"COALESCE(CAST(trunc(TRY_CAST(substring({T}, 1, 4) AS DOUBLE)) AS INTEGER), 2014)"
SEM_SQL = f"CASE WHEN length({T}) > 0 THEN right({T}, 1) END"


def _pa(spark, sf):
    return FR.with_presentation(FR.activity(spark, sf))


@register("presentation_year", f"SELECT {K}, code_presentation, {YEAR_SQL} AS year FROM ({PA}) p")
def q_year(spark, sf):
    return _pa(spark, sf).select("l_orderkey", "l_linenumber", "code_presentation",
                                 FE.presentation_year("code_presentation").alias("year"))


@register("presentation_semester", f"SELECT {K}, code_presentation, {SEM_SQL} AS semester FROM ({PA}) p")
def q_semester(spark, sf):
    return _pa(spark, sf).select("l_orderkey", "l_linenumber", "code_presentation",
                                 FE.presentation_semester("code_presentation").alias("semester"))


TIME_SQL = f"""WITH p AS (SELECT {K}, {YEAR_SQL} AS year, {SEM_SQL} AS semester FROM ({PA}) x),
s AS (SELECT quantile_cont(year, 0.75) AS q, MIN(year) AS mn FROM p)
SELECT {K}, year, semester, CAST(year >= q AS INTEGER) AS is_recent_year,
       CAST(CASE WHEN semester = 'B' THEN 1 WHEN semester = 'J' THEN 2 ELSE 0 END AS INTEGER) AS semester_numeric,
       CAST(year - mn AS INTEGER) AS years_since_start
FROM p, s"""


def _time(spark, sf):
    d = _pa(spark, sf).select("l_orderkey", "l_linenumber", "code_presentation")
    out, _ = FE.add_time_features(d, "code_presentation")
    return out.drop("code_presentation")


@register("is_recent_year", f"SELECT {K}, year, is_recent_year FROM ({TIME_SQL}) t")
def q_recent_year(spark, sf):
    return _time(spark, sf).select("l_orderkey", "l_linenumber", "year", "is_recent_year")


@register("semester_numeric", f"SELECT {K}, semester, semester_numeric FROM ({TIME_SQL}) t")
def q_semester_numeric(spark, sf):
    return _time(spark, sf).select("l_orderkey", "l_linenumber", "semester", "semester_numeric")


@register("years_since_start", f"SELECT {K}, year, years_since_start FROM ({TIME_SQL}) t")
def q_years_since_start(spark, sf):
    return _time(spark, sf).select("l_orderkey", "l_linenumber", "year", "years_since_start")


FLAGS = {"is_f": "F", "is_o": "O", "is_p": "P", "is_x": "X"}
FLAGS_SQL = ", ".join(f"CAST(COALESCE(o_orderstatus = '{v}', false) AS INTEGER) AS {k}" for k, v in FLAGS.items())


@register("keep_original_label", f"""SELECT {K}, o_orderstatus,
       COALESCE(CAST(o_orderstatus AS VARCHAR), 'None') AS o_orderstatus_original FROM ({A}) a""")
def q_original(spark, sf):
    a = FR.activity(spark, sf).select("l_orderkey", "l_linenumber", "o_orderstatus")
    return FE.outcome_flags(a, "o_orderstatus", flags={}, success=()).drop("academic_success")


@register("outcome_flags", f"SELECT {K}, {FLAGS_SQL} FROM ({A}) a")
def q_flags(spark, sf):
    a = FR.activity(spark, sf).select("l_orderkey", "l_linenumber", "o_orderstatus")
    return FE.outcome_flags(a, "o_orderstatus", FLAGS, keep_original=False).drop(
        "o_orderstatus", "academic_success")


@register("academic_success", f"""SELECT {K},
       CAST(COALESCE(o_orderstatus IN ('F', 'O'), false) AS INTEGER) AS academic_success FROM ({A}) a""")
def q_success(spark, sf):
    a = FR.activity(spark, sf).select("l_orderkey", "l_linenumber", "o_orderstatus")
    return FE.outcome_flags(a, "o_orderstatus", {}, success=("F", "O"), keep_original=False).drop(
        "o_orderstatus")


ENC = ["o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus"]


def _codes_cte(src: str, cols: list[str], null_text: str = "nan", code_type: str = "INTEGER") -> str:
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"m{i} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS {code_type}) AS code "
                     f"FROM (SELECT DISTINCT COALESCE(CAST({c} AS VARCHAR), '{null_text}') AS v FROM {src}) x)")
    return ",\n".join(parts)


def _codes_join(src_alias: str, cols: list[str], null_text: str = "nan") -> str:
    return "\n".join(f"JOIN m{i} ON COALESCE(CAST({src_alias}.{c} AS VARCHAR), '{null_text}') = m{i}.v"
                     for i, c in enumerate(cols))


@register("label_encode", f"""WITH a AS ({A}),
{_codes_cte("a", ENC)}
SELECT a.l_orderkey, a.l_linenumber, {", ".join(f"m{i}.code AS {c}" for i, c in enumerate(ENC))}
FROM a {_codes_join("a", ENC)}""")
def q_label_encode(spark, sf):
    a = FR.activity(spark, sf).select("l_orderkey", "l_linenumber", *ENC)
    out, _ = FE.label_encode(a, ENC)
    return out


@register("get_feature_encoders", f"""WITH a AS ({A}),
{_codes_cte("a", ENC)}
{" UNION ALL ".join(f"SELECT '{c}' AS column_name, v AS label, code FROM m{i}" for i, c in enumerate(ENC))}""")
def q_encoders(spark, sf):
    a = FR.activity(spark, sf)
    return FE.encoders_frame(spark, FE.fit_label_encoders(a, ENC))


@register("interaction_score", f"""SELECT {K},
       {r6("COALESCE(TRY_CAST(l_quantity AS DOUBLE), 0) * COALESCE(TRY_CAST(l_discount AS DOUBLE), 0)")}
       AS overall_interaction_score FROM ({A}) a""")
def q_interaction(spark, sf):
    a = FR.activity(spark, sf)
    return rounded(a.select("l_orderkey", "l_linenumber",
                            FE.interaction_score("l_quantity", "l_discount").alias("overall_interaction_score")))


LEVEL_SQL = """WITH e AS (SELECT event_id, COALESCE(value, 0) AS x FROM events),
m AS (SELECT MIN(x) AS mn, MAX(x) AS mx FROM e)
SELECT event_id, CAST(CASE WHEN x <= mn + ((mx - mn) / 3) * 1.0 THEN 1
                           WHEN x <= mn + ((mx - mn) / 3) * 2.0 THEN 2 ELSE 0 END AS INTEGER) AS participation_level
FROM e, m"""


@register("participation_level", LEVEL_SQL)
def q_level(spark, sf):
    from ..sources.tables import read_table
    ev = read_table(spark, "events", sf)
    params = FE.fit_levels(ev, "value")
    return ev.select("event_id", FE.participation_level("value", params).alias("participation_level"))


@register("log1p_clicks", f"""SELECT event_id,
       {r6("CASE WHEN value >= 0 THEN ln(value + 1) ELSE 0 END")} AS log_value FROM events""")
def q_log(spark, sf):
    from ..sources.tables import read_table
    ev = read_table(spark, "events", sf)
    return rounded(ev.select("event_id", FE.log1p_clicks("value").alias("log_value")))


SOC = ["o_orderpriority", "l_returnflag"]


@register("socioeconomic_score", f"""WITH a AS ({A}),
{_codes_cte("a", SOC)}
SELECT a.l_orderkey, a.l_linenumber, {r6("m0.code * 0.6 + m1.code * 0.4")} AS socioeconomic_education_score
FROM a {_codes_join("a", SOC)}""")
def q_socio(spark, sf):
    a = FR.activity(spark, sf).select("l_orderkey", "l_linenumber", *SOC)
    enc, _ = FE.label_encode(a, SOC)
    return rounded(enc.select("l_orderkey", "l_linenumber",
                              FE.socioeconomic_score(*SOC).alias("socioeconomic_education_score")))


@register("attempt_flags", f"""SELECT {K}, CAST(l_linenumber - 1 = 0 AS INTEGER) AS is_first_attempt,
       CAST(l_linenumber - 1 >= 2 AS INTEGER) AS is_experienced_student FROM ({A}) a""")
def q_attempts(spark, sf):
    a = FR.activity(spark, sf).withColumn("prev_attempts", F.col("l_linenumber") - 1)
    return a.select("l_orderkey", "l_linenumber", *FE.attempt_flags("prev_attempts"))


GM_SQL = f"""WITH a AS ({A}),
g AS (SELECT o_orderpriority, AVG(COALESCE(l_quantity, 0)) AS m FROM a GROUP BY o_orderpriority)
SELECT a.l_orderkey, a.l_linenumber, a.o_orderpriority, a.l_quantity, {r6("g.m")} AS module_avg_clicks,
       {r6("COALESCE(a.l_quantity, 0) - g.m")} AS clicks_vs_module_avg
FROM a LEFT JOIN g ON a.o_orderpriority IS NOT DISTINCT FROM g.o_orderpriority"""


def _gm(spark, sf):
    a = FR.activity(spark, sf).select("l_orderkey", "l_linenumber", "o_orderpriority", "l_quantity")
    a = FE.group_mean_feature(a, "o_orderpriority", "l_quantity", "module_avg_clicks")
    return a.withColumn("clicks_vs_module_avg", FE.diff_from_group_mean("l_quantity", "module_avg_clicks"))


@register("group_mean_feature", f"SELECT * EXCLUDE (clicks_vs_module_avg) FROM ({GM_SQL}) x")
def q_group_mean(spark, sf):
    return rounded(_gm(spark, sf).drop("clicks_vs_module_avg"))


@register("diff_from_group_mean", f"SELECT l_orderkey, l_linenumber, clicks_vs_module_avg FROM ({GM_SQL}) x")
def q_group_diff(spark, sf):
    return rounded(_gm(spark, sf).select("l_orderkey", "l_linenumber", "clicks_vs_module_avg"))


FS_COLS = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "o_totalprice"]


@register("feature_stats", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {r6(f'MIN({c})', 4)} AS min, {r6(f'MAX({c})', 4)} AS max, "
    f"{r6(f'AVG({c})', 4)} AS mean FROM ({A}) a" for c in FS_COLS))
def q_feature_stats(spark, sf):
    a = FR.activity(spark, sf)
    return rounded(FE.feature_stats(a, exclude=("l_orderkey", "o_orderstatus")), 4)


ONEHOT = ["o_orderpriority", "l_returnflag"]
ONEHOT_LEVELS = {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
                 "l_returnflag": ["A", "N", "R"]}


@register("one_hot", f"""SELECT {K}, {", ".join(
    f'CAST(COALESCE({c} = {chr(39)}{v}{chr(39)}, false) AS INTEGER) AS "{c}_{v}"'
    for c in ONEHOT for v in ONEHOT_LEVELS[c][1:])} FROM ({A}) a""")
def q_one_hot(spark, sf):
    a = FR.activity(spark, sf).select("l_orderkey", "l_linenumber", *ONEHOT)
    return FE.one_hot(a, ONEHOT)


@register("ordinal_map", f"""WITH a AS ({A}),
{_codes_cte("a", ["o_orderpriority"], "Unknown", "DOUBLE")}
SELECT a.l_orderkey, a.l_linenumber, m0.code AS o_orderpriority_ord
FROM a {_codes_join("a", ["o_orderpriority"], "Unknown")}""")
def q_ordinal(spark, sf):
    a = FR.activity(spark, sf).select("l_orderkey", "l_linenumber", "o_orderpriority")
    return FE.ordinal_map(a, "o_orderpriority").drop("o_orderpriority")


LF = FR.LEARNING_SQL
LF_T = "trim(COALESCE(code_presentation, 'None'))"
CF_ENC = ["final_result", "age_band", "gender", "code_module", "semester"]

CREATE_FEATURES_SQL = f"""WITH l AS ({LF}),
t AS (SELECT * REPLACE (COALESCE(code_presentation, 'None') AS code_presentation),
             COALESCE(CAST(trunc(TRY_CAST(substring({LF_T}, 1, 4) AS DOUBLE)) AS INTEGER), 2014) AS year,
             CASE WHEN length({LF_T}) > 0 THEN right({LF_T}, 1) END AS semester FROM l),
s AS (SELECT quantile_cont(year, 0.75) AS q, MIN(year) AS mn FROM t),
u AS (SELECT t.*, CAST(year >= q AS INTEGER) AS is_recent_year,
             CAST(CASE WHEN semester = 'B' THEN 1 WHEN semester = 'J' THEN 2 ELSE 0 END AS INTEGER) AS semester_numeric,
             CAST(year - mn AS INTEGER) AS years_since_start,
             COALESCE(CAST(final_result AS VARCHAR), 'None') AS final_result_original,
             CAST(COALESCE(final_result = 'Pass', false) AS INTEGER) AS is_pass,
             CAST(COALESCE(final_result = 'Distinction', false) AS INTEGER) AS is_distinction,
             CAST(COALESCE(final_result = 'Withdrawn', false) AS INTEGER) AS is_withdrawn,
             CAST(COALESCE(final_result = 'Fail', false) AS INTEGER) AS is_fail,
             CAST(COALESCE(final_result IN ('Pass', 'Distinction'), false) AS INTEGER) AS academic_success
      FROM t, s),
{_codes_cte("u", CF_ENC)},
e AS (SELECT u.* REPLACE ({", ".join(f"m{i}.code AS {c}" for i, c in enumerate(CF_ENC))},
                           COALESCE(TRY_CAST(u.sum_click AS DOUBLE), 0) AS sum_click)
      FROM u {_codes_join("u", CF_ENC)}),
mm AS (SELECT MIN(sum_click) AS mn, MAX(sum_click) AS mx FROM e),
g AS (SELECT code_module, AVG(sum_click) AS avg_c FROM e GROUP BY code_module)
SELECT e.*,
       CAST(CASE WHEN sum_click <= mn + ((mx - mn) / 3) * 1.0 THEN 1
                 WHEN sum_click <= mn + ((mx - mn) / 3) * 2.0 THEN 2 ELSE 0 END AS INTEGER) AS participation_level,
       {r6("CASE WHEN sum_click >= 0 THEN ln(sum_click + 1) ELSE 0 END")} AS log_sum_click,
       {r6("g.avg_c")} AS module_avg_clicks,
       {r6("e.sum_click - g.avg_c")} AS clicks_vs_module_avg
FROM e CROSS JOIN mm LEFT JOIN g ON e.code_module IS NOT DISTINCT FROM g.code_module"""


@register("create_features", CREATE_FEATURES_SQL)
def q_create_features(spark, sf):
    res = FE.create_features(FR.learning_frame(spark, sf))
    return rounded(res.df, 6, ["log_sum_click", "module_avg_clicks", "clicks_vs_module_avg"])


def _prep_sql():
    from .queries_base import CLEAN_CTES, DIRTY_COLS
    kept = [c for c in DIRTY_COLS if c not in ("empty_col", "const_col")]
    nf = len(kept)
    nulls = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in kept)
    quality = (f"((COUNT(*) * {nf} - ({nulls})) / (COUNT(*) * {nf}) * 0.7 + "
               f"(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM cl) x) / COUNT(*) * 0.3) * 100")
    # numeric columns left after cleaning: keys, quantity, price, discount, tax, mostly_null
    return f"""WITH {CLEAN_CTES}
SELECT 'initial_records' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM d
UNION ALL SELECT 'final_records', CAST(COUNT(*) AS DOUBLE) FROM cl
UNION ALL SELECT 'data_quality_score', {r6(quality)} FROM cl
UNION ALL SELECT 'features_added', CAST(7 AS DOUBLE)"""


@register("preprocessing_report", _prep_sql())
def q_preprocessing_report(spark, sf):
    from .queries_base import CLEAN_KW
    res = C.clean_dataset(FR.dirty(spark, sf), **CLEAN_KW)
    return rounded(FE.preprocessing_report(spark, res.report, P.numeric_columns(res.df)))
