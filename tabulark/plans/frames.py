"""Driver-table analogues of the learning-activity frames.

Every frame has a Spark builder and the equivalent SQL text, so a registered
query can be checked against an independent SQL engine on the same parquet
files. Mapping (activity -> driver tables):

* activity ⋈ student info   -> lineitem ⋈ orders on the order key
* final_result              -> o_orderstatus (F, O, P)
* sum_click                 -> l_quantity;  a skewed measure: events.value
* age_band / code_module    -> o_orderpriority / l_returnflag
* gender                    -> l_linestatus
* code_presentation         -> year(o_orderdate) || (B for months 1-6 else J)
* date (day offset)         -> days from o_orderdate to l_shipdate
* prediction / score        -> l_linenumber % 3 / l_discount

The "dirty" frame injects nulls, an all-null column, a constant column, a
mostly-null column, unparseable text and duplicate rows deterministically
(the driver tables have none of those).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

ACTIVITY_INFO_COLS = ["o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice"]


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.joins import activity_outcome_join
    li = read_table(spark, "lineitem", sf_dir)
    orders = read_table(spark, "orders", sf_dir)
    return activity_outcome_join(li, orders, ["l_orderkey"], ["o_orderkey"], ACTIVITY_INFO_COLS)


ACTIVITY_SQL = """SELECT l.*, o.o_orderstatus, o.o_orderpriority, o.o_orderdate, o.o_totalprice
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


DIRTY_EXPRS = [
    ("l_orderkey", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    ("l_quantity", "NULLIF(l_quantity, 7)"),
    ("l_extendedprice", "l_extendedprice"),
    ("l_discount", "l_discount"),
    ("l_tax", "l_tax"),
    ("l_returnflag", "l_returnflag"),
    ("l_linestatus", "l_linestatus"),
    ("o_orderstatus", "o_orderstatus"),
    ("o_orderpriority", "CASE WHEN l_quantity = 3 THEN NULL ELSE o_orderpriority END"),
    ("empty_col", "CAST(NULL AS DOUBLE)"),
    ("const_col", "'x'"),
    ("mostly_null", "CASE WHEN l_quantity > 20 THEN NULL ELSE l_tax END"),
    ("half_text", "CASE WHEN l_linenumber = 1 THEN 'x' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END"),
]


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = activity(spark, sf_dir)
    proj = a.select(*[F.expr(e.replace("VARCHAR", "STRING")).alias(n) for n, e in DIRTY_EXPRS])
    twice = F.when(F.col("l_linenumber") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return proj.select("*", F.explode(twice).alias("_copy")).drop("_copy")       # one join for both copies


def _dirty_select() -> str:
    return ",\n       ".join(f"{e} AS {n}" for n, e in DIRTY_EXPRS)


DIRTY_SQL = f"""WITH a AS ({ACTIVITY_SQL}),
p AS (SELECT {_dirty_select()} FROM a)
SELECT * FROM p UNION ALL SELECT * FROM p WHERE l_linenumber = 1"""


# code_presentation analogue with a few malformed codes
PRESENTATION_SQL_EXPR = ("CASE WHEN l_linenumber = 7 THEN ' ' || CAST(year(o_orderdate) AS VARCHAR) || 'B ' "
                         "WHEN l_linenumber = 6 AND l_quantity = 50 THEN 'bad' "
                         "ELSE CAST(year(o_orderdate) AS VARCHAR) || "
                         "CASE WHEN month(o_orderdate) <= 6 THEN 'B' ELSE 'J' END END")


def with_presentation(df: DataFrame) -> DataFrame:
    return df.withColumn("code_presentation",
                         F.expr(PRESENTATION_SQL_EXPR.replace("VARCHAR", "STRING")))


def learning_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity renamed to the learning-activity vocabulary, for the composed pipeline."""
    a = with_presentation(activity(spark, sf_dir))
    return a.select(
        F.col("l_orderkey").alias("id_student"),
        F.col("l_linenumber").alias("id_site"),
        F.col("l_returnflag").alias("code_module"),
        "code_presentation",
        F.datediff(F.col("l_shipdate"), F.col("o_orderdate")).cast("bigint").alias("date"),
        F.col("l_quantity").alias("sum_click"),
        F.col("o_orderstatus").alias("final_result"),
        F.col("l_linestatus").alias("gender"),
        F.col("o_orderpriority").alias("age_band"),
        F.col("l_discount").alias("highest_education_score"),
    )


LEARNING_SQL = f"""SELECT l_orderkey AS id_student, l_linenumber AS id_site, l_returnflag AS code_module,
       {PRESENTATION_SQL_EXPR} AS code_presentation,
       CAST(datediff('day', o_orderdate, l_shipdate) AS BIGINT) AS date,
       l_quantity AS sum_click, o_orderstatus AS final_result, l_linestatus AS gender,
       o_orderpriority AS age_band, l_discount AS highest_education_score
FROM ({ACTIVITY_SQL}) a"""
