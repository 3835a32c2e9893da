"""Registered queries: exploratory statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats as ST
from ..operators import explore as X
from ..operators import features as FE
from ..sources.tables import read_table
from . import frames as FR
from .registry import r6, register, rounded

A = FR.ACTIVITY_SQL
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]


def _act(spark, sf):
    return FR.activity(spark, sf)


# ------------------------------------------------------------------------ E1
DESC_NUM = ["l_quantity", "l_extendedprice", "l_discount"]
DESC_TXT = ["o_orderstatus", "o_orderpriority"]


def _desc_sql():
    parts = []
    for c in DESC_NUM:
        parts.append(
            f"SELECT '{c}' AS variable, CAST(COUNT({c}) AS BIGINT) AS count, CAST(NULL AS BIGINT) AS \"unique\", "
            f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, {r6(f'AVG({c})', 4)} AS mean, "
            f"{r6(f'STDDEV_SAMP({c})', 4)} AS std, {r6(f'MIN({c})', 4)} AS min, "
            f"{r6(f'quantile_cont({c}, 0.25)', 4)} AS q25, {r6(f'quantile_cont({c}, 0.5)', 4)} AS q50, "
            f"{r6(f'quantile_cont({c}, 0.75)', 4)} AS q75, {r6(f'MAX({c})', 4)} AS max FROM a")
    for c in DESC_TXT:
        top = f"(SELECT {c} FROM a WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"
        freq = f"(SELECT COUNT(*) FROM a WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"
        parts.append(
            f"SELECT '{c}', CAST(COUNT({c}) AS BIGINT), CAST(COUNT(DISTINCT {c}) AS BIGINT), {top}, "
            f"CAST({freq} AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM a")
    return f"WITH a AS ({A})\n" + "\nUNION ALL\n".join(parts)


@register("describe_all", _desc_sql())
def q_describe(spark, sf):
    return rounded(X.describe_all(_act(spark, sf), DESC_NUM + DESC_TXT), 4)


# ------------------------------------------------------------------------ E2
def _hist_sql(src: str, col: str, bins: int = 30, by: str | None = None) -> str:
    g = f"{by}, " if by else ""
    gsel = f"{by}, " if by else f"'{col}' AS variable, "
    join_on = f"USING ({by})" if by else "ON TRUE"
    return f"""WITH src AS (SELECT {g}CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL),
m AS (SELECT {g}MIN(x) AS mn, MAX(x) AS mx FROM src {"GROUP BY " + by if by else ""}),
p AS (SELECT {g}mn, mx, (mx - mn) / {bins} AS step, {bins} / (mx - mn) AS nrm FROM m),
b AS (SELECT {g}x, mn, mx, step, LEAST(GREATEST(CAST(floor((x - mn) * nrm) AS INTEGER), 0), {bins - 1}) AS i0
      FROM src JOIN p {join_on}),
c AS (SELECT {g}CASE WHEN x < (CASE WHEN i0 = {bins} THEN mx ELSE i0 * step + mn END) THEN i0 - 1
                    WHEN x >= (CASE WHEN i0 + 1 = {bins} THEN mx ELSE (i0 + 1) * step + mn END)
                         AND i0 <> {bins - 1} THEN i0 + 1
                    ELSE i0 END AS bin FROM b),
s AS (SELECT {g}CAST(r.range AS INTEGER) AS bin, r.range * step + mn AS bin_start,
             CASE WHEN r.range = {bins - 1} THEN mx ELSE (r.range + 1) * step + mn END AS bin_end
      FROM p, range({bins}) r)
SELECT {("s." + by + ", ") if by else gsel}s.bin, {r6("s.bin_start")} AS bin_start, {r6("s.bin_end")} AS bin_end,
       CAST(COUNT(c.bin) AS BIGINT) AS count
FROM s LEFT JOIN c ON s.bin = c.bin {("AND s." + by + " = c." + by) if by else ""}
GROUP BY {("s." + by + ", ") if by else ""}s.bin, s.bin_start, s.bin_end"""


@register("histogram", _hist_sql("events", "value"))
def q_histogram(spark, sf):
    return rounded(X.histogram(read_table(spark, "events", sf), ["value"], 30))


# --------------------------------------------------------------------- E3, E4
@register("sample_kurtosis", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, CAST(COUNT({c}) AS BIGINT) AS n, {r6(f'kurtosis({c})')} AS kurtosis FROM ({A}) a"
    for c in NUM))
def q_kurtosis(spark, sf):
    return rounded(X.moments(_act(spark, sf), NUM).select("variable", "n", "kurtosis"))


@register("sample_skewness", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, CAST(COUNT({c}) AS BIGINT) AS n, {r6(f'skewness({c})')} AS skewness FROM ({A}) a"
    for c in NUM))
def q_skewness(spark, sf):
    return rounded(X.moments(_act(spark, sf), NUM).select("variable", "n", "skewness"))


# ------------------------------------------------------------------ E5-E8, E18
# two derived measures give strongly correlated pairs
CNUM = NUM + ["l_revenue", "l_charge"]
REV = "l_extendedprice * (1 - l_discount)"
AR = f"SELECT *, {REV} AS l_revenue, {REV} * (1 + l_tax) AS l_charge FROM ({A}) x"
PAIRS = [(a, b) for i, a in enumerate(CNUM) for b in CNUM[i + 1:]]
CORR_SQL = f"WITH a AS ({AR})\n" + "\nUNION ALL\n".join(
    f"SELECT '{x}' AS var1, '{y}' AS var2, {i} AS i, {j} AS j, corr({x}, {y}) AS r, "
    f"CAST(COUNT(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS BIGINT) AS n, "
    f"regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept FROM a"
    for (x, y) in PAIRS for i, j in [(CNUM.index(x), CNUM.index(y))])


def _ract(spark, sf):
    rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return _act(spark, sf).withColumn("l_revenue", rev).withColumn("l_charge", rev * (1 + F.col("l_tax")))


@register("correlation_matrix", f"SELECT var1, var2, {r6('r')} AS correlation, n FROM ({CORR_SQL}) c")
def q_corr(spark, sf):
    return rounded(X.correlation_matrix(_ract(spark, sf), CNUM))


@register("top_correlated_pair", f"""SELECT var1, var2, {r6('r')} AS correlation FROM ({CORR_SQL}) c
WHERE abs(r) < 1 - 1e-9 ORDER BY abs(r) DESC, i, j LIMIT 1""")
def q_top_pair(spark, sf):
    corr = X.correlation_matrix(_ract(spark, sf), CNUM)
    return rounded(X.top_correlated_pair(corr, CNUM))


@register("strong_correlations", f"SELECT var1, var2, {r6('r')} AS correlation FROM ({CORR_SQL}) c WHERE abs(r) > 0.5")
def q_strong(spark, sf):
    return rounded(X.strong_correlations(X.correlation_matrix(_ract(spark, sf), CNUM), 0.5))


@register("correlated_pairs_trend", f"""SELECT var1, var2, {r6('r')} AS correlation, {r6('slope', 4)} AS slope,
       {r6('intercept', 4)} AS intercept FROM ({CORR_SQL}) c
WHERE abs(r) > 0.3 ORDER BY abs(r) DESC, i, j LIMIT 6""")
def q_trend(spark, sf):
    out = X.correlated_pairs_trend(_ract(spark, sf), CNUM, 0.3, 6)
    return rounded(rounded(out, 6, ["correlation"]), 4, ["slope", "intercept"])


@register("correlation_strength", f"""SELECT var1, var2, CASE WHEN abs(r) >= 0.7 THEN 'Fuerte'
  WHEN abs(r) >= 0.5 THEN 'Moderada' WHEN abs(r) >= 0.3 THEN 'Débil' ELSE 'Muy débil' END AS strength
FROM ({CORR_SQL}) c""")
def q_strength(spark, sf):
    corr = X.correlation_matrix(_ract(spark, sf), CNUM)
    return corr.select("var1", "var2", ST.correlation_strength(F.abs("correlation")).alias("strength"))


# --------------------------------------------------------------------- E9, E10
BOX_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _box_sql(src: str, col: str, by: str | None = None, name: str | None = None) -> str:
    g = f"{by}, " if by else ""
    head = f"{by}" if by else f"'{name or col}' AS variable"
    on = f"USING ({by})" if by else "ON TRUE"
    return f"""WITH s AS (SELECT {g}CAST({col} AS DOUBLE) AS x FROM {src}),
q AS (SELECT {g}quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3
      FROM s {"GROUP BY " + by if by else ""}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT {head}, {r6("ANY_VALUE(q1)", 4)} AS q1, {r6("ANY_VALUE(med)", 4)} AS median, {r6("ANY_VALUE(q3)", 4)} AS q3,
       {r6("ANY_VALUE(iqr)", 4)} AS iqr, {r6("ANY_VALUE(lf)", 4)} AS lower_fence, {r6("ANY_VALUE(uf)", 4)} AS upper_fence,
       {r6("MIN(x) FILTER (WHERE x >= lf AND x <= uf)", 4)} AS whisker_low,
       {r6("MAX(x) FILTER (WHERE x >= lf AND x <= uf)", 4)} AS whisker_high,
       CAST(COUNT(*) FILTER (WHERE x < lf OR x > uf) AS BIGINT) AS n_fliers
FROM s JOIN f {on} {"GROUP BY " + by if by else ""}"""


@register("box_stats", f"WITH a AS ({A})\n" + "\nUNION ALL\n".join(
    f"SELECT * FROM ({_box_sql('a', c)}) b{i}" for i, c in enumerate(BOX_COLS)))
def q_box(spark, sf):
    return rounded(X.box_stats(_act(spark, sf), BOX_COLS), 4)


@register("grouped_box_stats", _box_sql("events", "value", by="event_type"))
def q_grouped_box(spark, sf):
    return rounded(X.grouped_box_stats(read_table(spark, "events", sf), "event_type", "value"), 4)


@register("grouped_histogram", _hist_sql("events", "value", 30, by="event_type"))
def q_grouped_hist(spark, sf):
    return rounded(X.grouped_histogram(read_table(spark, "events", sf), "event_type", "value", 30))


# ------------------------------------------------------------------- E12-E14
@register("crosstab_share", f"""SELECT l_linestatus, o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n,
       {r6("COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY l_linestatus)")} AS share
FROM ({A}) a WHERE l_linestatus IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY l_linestatus, o_orderstatus""")
def q_crosstab(spark, sf):
    return rounded(X.crosstab_share(_act(spark, sf), "l_linestatus", "o_orderstatus"))


@register("crosstab_top_groups", f"""WITH o AS (SELECT n.n_name, o.o_orderstatus
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
t AS (SELECT n_name FROM o GROUP BY n_name ORDER BY COUNT(*) DESC, n_name LIMIT 8)
SELECT n_name, o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n FROM o WHERE n_name IN (SELECT n_name FROM t)
GROUP BY n_name, o_orderstatus""")
def q_crosstab_top(spark, sf):
    from .queries_base import _orders_nation
    return X.crosstab_top_groups(_orders_nation(spark, sf), "n_name", "o_orderstatus", 8)


@register("target_share", f"""SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n,
       {r6("COUNT(*) / SUM(COUNT(*)) OVER () * 100")} AS percentage
FROM ({A}) a WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus""")
def q_target_share(spark, sf):
    return rounded(X.target_share(_act(spark, sf), "o_orderstatus"))


# ----------------------------------------------------------------------- E15
def _anova_sql():
    per = ", ".join(f"AVG({c}) AS m{i}, VAR_POP({c}) AS v{i}" for i, c in enumerate(NUM))
    grand = ", ".join(f"SUM(n * m{i}) / SUM(n) AS g{i}" for i in range(len(NUM)))
    feats = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {i} AS idx, (SUM(n * (m{i} - g{i}) * (m{i} - g{i})) / (COUNT(*) - 1)) / "
        f"(SUM(n * v{i}) / (SUM(n) - COUNT(*))) AS f FROM p, g" for i, c in enumerate(NUM))
    return f"""WITH a AS ({A}),
p AS (SELECT o_orderstatus, COUNT(*) AS n, {per} FROM a WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus),
g AS (SELECT {grand} FROM p),
fs AS ({feats})
SELECT feature, {r6("f")} AS f_score, CAST(row_number() OVER (ORDER BY f DESC, idx) AS INTEGER) AS rank,
       row_number() OVER (ORDER BY f DESC, idx) <= {min(15, len(NUM))} AS selected
FROM fs"""


@register("anova_f_scores", _anova_sql())
def q_anova(spark, sf):
    return rounded(X.anova_f_scores(_act(spark, sf), "o_orderstatus", NUM).drop("p_value"))


# ----------------------------------------------------------------- E16, E17
@register("pearson_test", f"""WITH a AS ({A}),
m AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
      FROM (SELECT DISTINCT COALESCE(o_orderstatus, 'nan') AS v FROM a) x),
j AS (SELECT a.l_quantity AS x, m.code AS y FROM a JOIN m ON COALESCE(a.o_orderstatus, 'nan') = m.v),
r AS (SELECT corr(x, y) AS r, COUNT(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS n FROM j)
SELECT {r6("r")} AS correlation, CAST(n AS BIGINT) AS n, {r6("r * sqrt((n - 2) / (1 - r * r))")} AS t_statistic,
       {r6("abs(r)")} AS effect_size,
       CASE WHEN abs(r) >= 0.7 THEN 'Fuerte' WHEN abs(r) >= 0.5 THEN 'Moderada' WHEN abs(r) >= 0.3 THEN 'Débil'
            ELSE 'Muy débil' END AS interpretation FROM r""")
def q_pearson(spark, sf):
    a = _act(spark, sf).select("l_quantity", "o_orderstatus")
    coded, _ = FE.label_encode(a, ["o_orderstatus"])
    return rounded(X.pearson_frame(coded, "l_quantity", "o_orderstatus"))


def _hypothesis_sql(name: str, x: str) -> str:
    return f"""SELECT '{name}' AS hypothesis, {r6("r")} AS correlation, abs(r * sqrt((n - 2) / (1 - r * r))) > 1.96 AS significant,
       CASE WHEN abs(r) >= 0.7 THEN 'Fuerte' WHEN abs(r) >= 0.5 THEN 'Moderada' WHEN abs(r) >= 0.3 THEN 'Débil' ELSE 'Muy débil' END AS interpretation
FROM (SELECT corr({x}, y) AS r, COUNT(*) AS n FROM j) t"""


@register("test_hypotheses", f"""WITH a AS ({FR.LEARNING_SQL}),
y AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT final_result AS v FROM a) t),
g AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT age_band AS v FROM a) t),
j AS (SELECT CAST(sum_click AS DOUBLE) AS clicks, CAST(g.code AS DOUBLE) AS age, CAST(y.code AS DOUBLE) AS y
      FROM a JOIN y ON a.final_result = y.v JOIN g ON a.age_band = g.v)
{_hypothesis_sql("H1_VLE_Performance", "clicks")} UNION ALL {_hypothesis_sql("H2_Age_Performance", "age")}""")
def q_hypotheses(spark, sf):
    """The p-values need the incomplete beta function, which SQL lacks; the decision at 5 % is compared."""
    lf = FR.learning_frame(spark, sf)
    return rounded(X.test_hypotheses(lf, "final_result", "sum_click", "age_band").drop("p_value"))


# ------------------------------------------------------------------ E19-E21
def _ks_sql(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS variable, d AS ks_statistic, CASE WHEN z < 0.2 THEN 1.0 ELSE
         least(1.0, greatest(0.0, 2 * ({" + ".join(f"{(-1) ** (j - 1)} * exp(-2 * {j * j} * z * z)" for j in range(1, 12))}))) END AS ks_p_value
FROM (SELECT d, sqrt(n) * d + 1 / (6 * sqrt(n)) + (sqrt(n) * d - 1) / (4 * n) AS z FROM (
  SELECT n, max(greatest(abs(upto / n - p), abs(p - (upto - c) / n))) AS d FROM (
    SELECT n, c, SUM(c) OVER (ORDER BY x) AS upto, {ST.normal_cdf_sql("((x - m) / s)")} AS p FROM (
      SELECT x, COUNT(*) AS c FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source} WHERE {column} IS NOT NULL) v GROUP BY x) k,
      (SELECT CAST(COUNT({column}) AS DOUBLE) AS n, avg(CAST({column} AS DOUBLE)) AS m, stddev_samp(CAST({column} AS DOUBLE)) AS s FROM {source}) f) g
  GROUP BY n) h) w"""


KS = ["value", "user_id"]
NORMALITY = ["l_quantity", "l_discount", "o_totalprice"]


@register("ks_normality", "\nUNION ALL\n".join(
    f"SELECT variable, {r6('ks_statistic')} AS ks_statistic, {r6('ks_p_value')} AS ks_p_value, ks_p_value > 0.05 AS normal_ks FROM ({_ks_sql('events', c)}) q{i}"
    for i, c in enumerate(KS)))
def q_ks(spark, sf):
    return rounded(X.ks_normality(read_table(spark, "events", sf), KS))


@register("normality_report", f"WITH a AS ({A})\n" + "\nUNION ALL\n".join(
    f"""SELECT variable, {r6('ks_statistic')} AS ks_statistic, {r6('ks_p_value')} AS ks_p_value, ks_p_value > 0.05 AS normal_ks,
       (SELECT {r6(f"skewness({c})")} FROM a) AS skewness, (SELECT {r6(f"kurtosis({c})")} FROM a) AS kurtosis FROM ({_ks_sql('a', c)}) q{i}"""
    for i, c in enumerate(NORMALITY)))
def q_normality(spark, sf):
    return rounded(X.normality_report(_act(spark, sf), NORMALITY))


OUT_COLS = ["value", "user_id"]


@register("outlier_report", "\nUNION ALL\n".join(f"""SELECT * FROM (WITH s AS (SELECT CAST({c} AS DOUBLE) AS x FROM events WHERE {c} IS NOT NULL),
b AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, AVG(x) AS m, STDDEV_POP(x) AS sd FROM s)
SELECT '{c}' AS variable, CAST(COUNT(*) AS BIGINT) AS total_values,
       CAST(COUNT(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS iqr_outliers,
       {r6("COUNT(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) / COUNT(*) * 100")} AS iqr_percentage,
       CAST(COUNT(*) FILTER (WHERE abs((x - m) / sd) > 3) AS BIGINT) AS z_outliers,
       {r6("COUNT(*) FILTER (WHERE abs((x - m) / sd) > 3) / COUNT(*) * 100")} AS z_percentage,
       {r6("ANY_VALUE(q1 - 1.5 * (q3 - q1))")} AS lower_bound, {r6("ANY_VALUE(q3 + 1.5 * (q3 - q1))")} AS upper_bound
FROM s, b) o{i}""" for i, c in enumerate(OUT_COLS)))
def q_outlier_report(spark, sf):
    return rounded(X.outlier_report(read_table(spark, "events", sf), OUT_COLS))


@register("eda_suite")
def q_eda_suite(spark, sf):
    """All reports over all rows, stacked as (report, row)."""
    reports = X.eda_suite(_act(spark, sf), quick=False, keys=["l_orderkey", "l_linenumber"], label="o_orderstatus")
    stacked = None
    for name, df in reports.items():
        one = df.select(F.lit(name).alias("report"), F.to_json(F.struct(*df.columns)).alias("row"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked
