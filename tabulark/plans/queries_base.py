"""Registered queries: sources (A), joins/sampling (B), profiling/cleaning (C)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..functions.hashing import hash_sql
from ..operators import clean as C
from ..operators import joins as J
from ..operators import profile as P
from ..operators import sampling as S
from ..sources import tables as IO
from . import frames as FR
from .registry import r6, register, rounded

KEYS = ["l_orderkey", "l_linenumber"]
H = hash_sql(KEYS, 42)
A = FR.ACTIVITY_SQL
D = FR.DIRTY_SQL


# ------------------------------------------------------------------------ A
@register("read_table", "SELECT * FROM lineitem")
def q_read_table(spark, sf):
    return IO.read_table(spark, "lineitem", sf)


@register("run_query", """SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n
FROM orders WHERE o_totalprice >= 1000.0 GROUP BY o_orderstatus""")
def q_run_query(spark, sf):
    IO.read_table(spark, "orders", sf).createOrReplaceTempView("orders")
    return IO.run_query(spark, """SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n
        FROM orders WHERE o_totalprice >= :min_price GROUP BY o_orderstatus""",
                        {"min_price": 1000.0})


# ------------------------------------------------------------------------ B
@register("activity_outcome_join", A)
def q_join(spark, sf):
    return FR.activity(spark, sf)


@register("outcome_only_join", """SELECT l.*, o.o_orderstatus
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_join_outcome(spark, sf):
    return J.outcome_only_join(IO.read_table(spark, "lineitem", sf), IO.read_table(spark, "orders", sf),
                               ["l_orderkey"], ["o_orderkey"], "o_orderstatus")


@register("class_distribution", """SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n
FROM orders GROUP BY o_orderstatus""")
def q_class_distribution(spark, sf):
    return S.class_counts(IO.read_table(spark, "orders", sf), "o_orderstatus")


@register("filter_class", f"SELECT * FROM ({A}) a WHERE o_orderstatus = 'F'")
def q_filter_class(spark, sf):
    return FR.activity(spark, sf).where(F.col("o_orderstatus") == F.lit("F"))


@register("random_sample", f"SELECT * FROM ({A}) a ORDER BY {H}, l_orderkey, l_linenumber LIMIT 5000")
def q_random_sample(spark, sf):
    return S.random_sample(FR.activity(spark, sf), 5000, KEYS, 42)


@register("balanced_sample", f"""WITH a AS ({A}),
g AS (SELECT COUNT(DISTINCT o_orderstatus) + MAX(CASE WHEN o_orderstatus IS NULL THEN 1 ELSE 0 END) AS k
      FROM orders),
r AS (SELECT a.*, row_number() OVER (PARTITION BY o_orderstatus
                                     ORDER BY {H}, l_orderkey, l_linenumber) AS rn
      FROM a WHERE o_orderstatus IS NOT NULL)
SELECT * EXCLUDE (rn) FROM r WHERE rn <= 6000 // (SELECT k FROM g)""")
def q_balanced_sample(spark, sf):
    return S.balanced_sample(FR.activity(spark, sf), "o_orderstatus", 6000, KEYS, 42,
                             class_source=IO.read_table(spark, "orders", sf))


@register("recent_sample",
          f"SELECT * FROM ({A}) a ORDER BY l_shipdate DESC, {H}, l_orderkey, l_linenumber LIMIT 5000")
def q_recent_sample(spark, sf):
    return S.recent_sample(FR.activity(spark, sf), "l_shipdate", 5000, KEYS, 42)


@register("union_rows", f"""WITH a AS ({A})
SELECT * FROM a WHERE o_orderstatus = 'F' UNION ALL SELECT * FROM a WHERE o_orderstatus = 'O'
UNION ALL SELECT * FROM a WHERE o_orderstatus = 'P'""")
def q_union_rows(spark, sf):
    a = FR.activity(spark, sf)
    parts = [a.where(F.col("o_orderstatus") == v) for v in ("F", "O", "P")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


@register("load_strategy", f"SELECT * FROM ({A}) a ORDER BY {H}, l_orderkey, l_linenumber LIMIT 3000")
def q_load_strategy(spark, sf):
    return S.load_strategy(FR.activity(spark, sf), "random", 3000, KEYS, "o_orderstatus", "l_shipdate")


@register("sample_rows", f"SELECT * FROM ({A}) a ORDER BY {H}, l_orderkey, l_linenumber LIMIT 10000")
def q_sample_rows(spark, sf):
    return S.sample_rows(FR.activity(spark, sf), KEYS, 10_000, 42)


@register("rank_rows", f"""SELECT o_orderpriority, CAST(SUM(l_quantity) AS DOUBLE) AS total,
       CAST(row_number() OVER (ORDER BY SUM(l_quantity) DESC, o_orderpriority) AS INTEGER) AS rank
FROM ({A}) a GROUP BY o_orderpriority""")
def q_rank_rows(spark, sf):
    from ..operators.explore import rank_rows
    totals = FR.activity(spark, sf).groupBy("o_orderpriority").agg(
        F.sum("l_quantity").cast("double").alias("total"))
    return rank_rows(totals, "total", tie_keys=["o_orderpriority"])


TOP_NATIONS_SQL = """SELECT n.n_name, CAST(COUNT(*) AS BIGINT) AS n
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name ORDER BY n DESC, n.n_name LIMIT 8"""


@register("top_k_groups", TOP_NATIONS_SQL)
def q_top_k_groups(spark, sf):
    from ..operators.explore import top_k_groups
    return top_k_groups(_orders_nation(spark, sf), "n_name", 8)


def _orders_nation(spark, sf):
    orders = IO.read_table(spark, "orders", sf)
    cust = IO.read_table(spark, "customer", sf).select("c_custkey", "c_nationkey")
    nation = IO.read_table(spark, "nation", sf).select("n_nationkey", "n_name")
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))


# ------------------------------------------------------------------------ C
DIRTY_COLS = [n for n, _ in FR.DIRTY_EXPRS]


@register("null_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count, "
    f"{r6(f'(COUNT(*) - COUNT({c})) / COUNT(*)')} AS null_fraction FROM ({D}) d" for c in DIRTY_COLS))
def q_null_profile(spark, sf):
    return rounded(P.null_profile(FR.dirty(spark, sf)))


@register("duplicate_count", f"""SELECT CAST(COUNT(*) AS BIGINT) AS rows,
       CAST((SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ({D}) x) y) AS BIGINT) AS distinct_rows,
       CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ({D}) x) y) AS BIGINT) AS duplicates
FROM ({D}) d""")
def q_duplicate_count(spark, sf):
    return P.duplicate_count(FR.dirty(spark, sf))


@register("drop_all_null_columns", f"SELECT * EXCLUDE (empty_col) FROM ({D}) d")
def q_drop_all_null(spark, sf):
    return P.drop_all_null_columns(FR.dirty(spark, sf))


@register("drop_constant_columns", f"SELECT * EXCLUDE (empty_col, const_col) FROM ({D}) d")
def q_drop_constant(spark, sf):
    return P.drop_constant_columns(FR.dirty(spark, sf), keep=("o_orderstatus",))


CRIT = ("l_orderkey", "o_orderstatus", "l_returnflag", "o_orderpriority")


@register("drop_missing_critical", f"""SELECT * FROM ({D}) d WHERE l_orderkey IS NOT NULL
AND o_orderstatus IS NOT NULL AND l_returnflag IS NOT NULL AND o_orderpriority IS NOT NULL""")
def q_drop_missing(spark, sf):
    return C.drop_missing_critical(FR.dirty(spark, sf), CRIT)


@register("impute_median", f"""WITH d AS ({D})
SELECT * REPLACE (COALESCE(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM d)) AS l_quantity)
FROM d""")
def q_impute_median(spark, sf):
    d = FR.dirty(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)      # joined once for the fit and the output
    p = C.fit_impute(d)
    p.modes = {}
    return C.apply_impute(d, p)


@register("impute_mode", f"""WITH d AS ({D}),
m AS (SELECT o_orderpriority AS v FROM d WHERE o_orderpriority IS NOT NULL
      GROUP BY o_orderpriority ORDER BY COUNT(*) DESC, o_orderpriority LIMIT 1)
SELECT * REPLACE (COALESCE(o_orderpriority, (SELECT v FROM m)) AS o_orderpriority) FROM d""")
def q_impute_mode(spark, sf):
    d = FR.dirty(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)      # joined once for the fit and the output
    p = C.fit_impute(d)
    p.medians = {}
    return C.apply_impute(d, p)


@register("drop_duplicates", f"SELECT DISTINCT * FROM ({D}) d")
def q_drop_duplicates(spark, sf):
    return C.drop_duplicates(FR.dirty(spark, sf))


@register("coerce_numeric", f"""SELECT l_orderkey, l_linenumber,
       COALESCE(TRY_CAST(half_text AS DOUBLE), 0) AS half_num,
       COALESCE(TRY_CAST(l_quantity AS DOUBLE), 0) AS quantity_num FROM ({D}) d""")
def q_coerce_numeric(spark, sf):
    d = FR.dirty(spark, sf)
    return d.select("l_orderkey", "l_linenumber", C.coerce_numeric("half_text").alias("half_num"),
                    C.coerce_numeric("l_quantity").alias("quantity_num"))


EV_Q = "SELECT quantile_cont(COALESCE(value, 0), 0.25) AS q1, quantile_cont(COALESCE(value, 0), 0.75) AS q3 FROM events"


@register("clip_iqr", f"""WITH b AS ({EV_Q})
SELECT events.* REPLACE (LEAST(GREATEST(COALESCE(value, 0), q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS value)
FROM events, b""")
def q_clip_iqr(spark, sf):
    return C.clip_iqr(IO.read_table(spark, "events", sf), ["value"])


@register("clip_percentile", """WITH b AS (SELECT quantile_cont(COALESCE(value, 0), 1 - 0.98) AS lo,
                  quantile_cont(COALESCE(value, 0), 0.98) AS hi FROM events)
SELECT events.* REPLACE (LEAST(GREATEST(COALESCE(value, 0), lo), hi) AS value) FROM events, b""")
def q_clip_percentile(spark, sf):
    return C.clip_percentile(IO.read_table(spark, "events", sf), ["value"], 0.98)


@register("replace_zscore", """WITH b AS (SELECT AVG(COALESCE(value, 0)) AS m, STDDEV_POP(COALESCE(value, 0)) AS s,
                  quantile_cont(COALESCE(value, 0), 0.05) AS q05, quantile_cont(COALESCE(value, 0), 0.5) AS q50,
                  quantile_cont(COALESCE(value, 0), 0.95) AS q95 FROM events)
SELECT events.* REPLACE (CASE WHEN ABS((COALESCE(value, 0) - m) / s) > 3
                       THEN CASE WHEN COALESCE(value, 0) > q50 THEN q95 ELSE q05 END
                       ELSE COALESCE(value, 0) END AS value) FROM events, b""")
def q_replace_zscore(spark, sf):
    return C.replace_zscore(IO.read_table(spark, "events", sf), ["value"])


@register("outlier_bounds", f"""WITH b AS ({EV_Q})
SELECT 'value' AS variable, 'iqr' AS method, CAST(q1 - 1.5 * (q3 - q1) AS DOUBLE) AS lower_bound,
       CAST(q3 + 1.5 * (q3 - q1) AS DOUBLE) AS upper_bound,
       CAST(COUNT(*) FILTER (WHERE COALESCE(value, 0) < q1 - 1.5 * (q3 - q1)
                              OR COALESCE(value, 0) > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers_count
FROM events, b GROUP BY q1, q3""")
def q_outlier_bounds(spark, sf):
    ev = IO.read_table(spark, "events", sf)
    return C.outlier_bounds(ev, C.fit_outliers(ev, ["value"], "iqr"))


@register("count_changed", f"""WITH b AS ({EV_Q})
SELECT 'value' AS variable, CAST(COUNT(*) FILTER (WHERE value IS DISTINCT FROM
       LEAST(GREATEST(COALESCE(value, 0), q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1))) AS BIGINT) AS changed
FROM events, b""")
def q_count_changed(spark, sf):
    ev = IO.read_table(spark, "events", sf)
    params = C.fit_outliers(ev, ["value"], "iqr")
    b = params.bounds["value"]
    return ev.agg(F.count_if(~F.col("value").eqNullSafe(C.outlier_expr("value", b, "iqr")))
                  .cast("bigint").alias("changed")).select(F.lit("value").alias("variable"), "changed")


INF_EVENTS = "SELECT * REPLACE (CASE WHEN event_type = 'error' AND value > 400 THEN CAST('inf' AS DOUBLE) ELSE value END AS value) FROM events"


@register("replace_infinite", f"""WITH e AS ({INF_EVENTS}),
m AS (SELECT quantile_cont(CASE WHEN isinf(value) THEN NULL ELSE value END, 0.5) AS med FROM e)
SELECT * REPLACE (CASE WHEN isinf(value) THEN (SELECT med FROM m) ELSE value END AS value) FROM e""")
def q_replace_infinite(spark, sf):
    ev = IO.read_table(spark, "events", sf).withColumn(
        "value", F.when((F.col("event_type") == "error") & (F.col("value") > 400), F.lit(float("inf")))
        .otherwise(F.col("value")))
    return C.replace_infinite(ev)


@register("quality_score", f"""WITH d AS ({D}),
s AS (SELECT COUNT(*) AS rows, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM d) x) AS distinct_rows,
             {" + ".join(f"(COUNT(*) - COUNT({c}))" for c in DIRTY_COLS)} AS null_cells FROM d)
SELECT CAST(rows AS BIGINT) AS rows, CAST(rows * {len(DIRTY_COLS)} AS BIGINT) AS cells,
       CAST(null_cells AS BIGINT) AS null_cells, CAST(distinct_rows AS BIGINT) AS distinct_rows,
       {r6(f"((rows * {len(DIRTY_COLS)} - null_cells) / (rows * {len(DIRTY_COLS)}) * 0.7 + distinct_rows / rows * 0.3) * 100")} AS quality_score
FROM s""")
def q_quality_score(spark, sf):
    return rounded(P.quality_score(FR.dirty(spark, sf)))


CLEAN_KW = dict(target="o_orderstatus", critical=("l_orderkey", "o_orderstatus", "l_returnflag"),
                outlier_names=("l_quantity", "mostly_null"), outlier_prefixes=())

CLEAN_CTES = f"""d AS ({D}),
c AS (SELECT * EXCLUDE (empty_col, const_col) FROM d
      WHERE l_orderkey IS NOT NULL AND o_orderstatus IS NOT NULL AND l_returnflag IS NOT NULL),
md AS (SELECT quantile_cont(l_quantity, 0.5) AS m FROM c),
mo AS (SELECT o_orderpriority AS v FROM c WHERE o_orderpriority IS NOT NULL
       GROUP BY o_orderpriority ORDER BY COUNT(*) DESC, o_orderpriority LIMIT 1),
i AS (SELECT DISTINCT * REPLACE (COALESCE(l_quantity, (SELECT m FROM md)) AS l_quantity,
                                 COALESCE(o_orderpriority, (SELECT v FROM mo)) AS o_orderpriority) FROM c),
b AS (SELECT quantile_cont(COALESCE(l_quantity, 0), 0.25) AS a1, quantile_cont(COALESCE(l_quantity, 0), 0.75) AS a3,
             quantile_cont(COALESCE(mostly_null, 0), 0.25) AS b1, quantile_cont(COALESCE(mostly_null, 0), 0.75) AS b3
      FROM i),
cl AS (SELECT i.* REPLACE (
    LEAST(GREATEST(COALESCE(l_quantity, 0), a1 - 1.5 * (a3 - a1)), a3 + 1.5 * (a3 - a1)) AS l_quantity,
    LEAST(GREATEST(COALESCE(mostly_null, 0), b1 - 1.5 * (b3 - b1)), b3 + 1.5 * (b3 - b1)) AS mostly_null)
FROM i, b)"""

CLEAN_SQL = f"WITH {CLEAN_CTES} SELECT * FROM cl"


@register("clean_dataset", CLEAN_SQL)
def q_clean_dataset(spark, sf):
    return C.clean_dataset(FR.dirty(spark, sf), **CLEAN_KW).df


_NF = len(DIRTY_COLS) - 2
_CL_NULLS = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in DIRTY_COLS if c not in ("empty_col", "const_col"))


@register("cleaning_report", f"""WITH {CLEAN_CTES}
SELECT CAST((SELECT COUNT(*) FROM d) AS BIGINT) AS initial_records,
       CAST({len(DIRTY_COLS)} AS BIGINT) AS initial_features,
       CAST((SELECT {" + ".join(f"(COUNT(*) - COUNT({c}))" for c in DIRTY_COLS)} FROM d) AS BIGINT) AS initial_nulls,
       CAST((SELECT COUNT(*) FROM d) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM d) x) AS BIGINT) AS initial_duplicates,
       CAST((SELECT COUNT(*) FROM c) AS BIGINT) AS records_after_null_cleaning,
       CAST((SELECT COUNT(*) FROM c) - (SELECT COUNT(*) FROM i) AS BIGINT) AS duplicates_removed,
       CAST((SELECT COUNT(*) FILTER (WHERE i.l_quantity IS DISTINCT FROM
                LEAST(GREATEST(COALESCE(i.l_quantity, 0), a1 - 1.5 * (a3 - a1)), a3 + 1.5 * (a3 - a1)))
              + COUNT(*) FILTER (WHERE i.mostly_null IS DISTINCT FROM
                LEAST(GREATEST(COALESCE(i.mostly_null, 0), b1 - 1.5 * (b3 - b1)), b3 + 1.5 * (b3 - b1)))
              FROM i, b) AS BIGINT) AS outliers_treated,
       CAST((SELECT COUNT(*) FROM cl) AS BIGINT) AS final_records,
       CAST({_NF} AS BIGINT) AS final_features,
       CAST((SELECT {_CL_NULLS} FROM cl) AS BIGINT) AS final_nulls,
       CAST((SELECT COUNT(*) FROM d) - (SELECT COUNT(*) FROM cl) AS BIGINT) AS records_removed,
       CAST(2 AS BIGINT) AS features_removed,
       (SELECT {r6(f"((COUNT(*) * {_NF} - ({_CL_NULLS})) / (COUNT(*) * {_NF}) * 0.7 + (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM cl) x) / COUNT(*) * 0.3) * 100")} FROM cl) AS data_quality_score""")
def q_cleaning_report(spark, sf):
    res = C.clean_dataset(FR.dirty(spark, sf), **CLEAN_KW)
    rep = C.cleaning_report(spark, res.report)
    return rounded(rep.drop("columns_dropped", "numerical_variables"))


@register("narrow_types")
def q_narrow_types(spark, sf):
    return C.narrow_types(IO.read_table(spark, "lineitem", sf))


@register("select_outlier_columns", """SELECT column_name FROM information_schema.columns
WHERE table_name = 'lineitem' AND (column_name IN ('l_quantity', 'l_tax') OR column_name LIKE 'l_ext%')""")
def q_outlier_columns(spark, sf):
    cols = IO.read_table(spark, "lineitem", sf).columns
    chosen = C.outlier_columns(cols, names=("l_quantity", "l_tax"), prefixes=("l_ext",))
    return spark.createDataFrame([(c,) for c in chosen if c in cols], "column_name string")
