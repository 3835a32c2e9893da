"""The flagship query: join -> IQR clip -> group mean -> difference -> share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import features as FE
from . import frames as FR


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = FR.activity(spark, sf_dir)
    a = C.clip_iqr(a, ["l_quantity"])
    a = FE.group_mean_feature(a, "o_orderpriority", "l_quantity", "priority_avg_quantity")
    a = a.withColumn("quantity_vs_priority_avg", F.col("l_quantity") - F.col("priority_avg_quantity"))
    by = a.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.avg("quantity_vs_priority_avg").alias("mean_diff"))
    tot = a.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_group"))
    out = by.join(tot, "o_orderpriority").select(
        "o_orderpriority", "o_orderstatus", "n",
        F.round(F.col("n") / F.col("n_group"), 6).alias("share"),
        F.round("mean_diff", 6).alias("mean_diff"))
    return out
