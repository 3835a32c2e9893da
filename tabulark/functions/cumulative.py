"""Running totals in a global order without a single-partition window.

``Window.orderBy(x)`` without a partition key moves every row to one task.
Here the rows are range-partitioned on ``(by..., order)`` (balanced by
sampling), the partitioned frame is checkpointed so partition ids are stable,
each range partition computes its own running sums, and a tiny table of
per-partition totals (one row per partition and group) gives the offsets.
The input is expected to be pre-aggregated (one row per distinct order value),
which also makes ties exact: a row's running sum includes all rows with an
equal order value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize


def running_totals(df: DataFrame, order: str, values: list[str], by: list[str] | None = None,
                   partitions: int | None = None, descending: bool = False) -> DataFrame:
    """Add ``cum_<v>`` = sum of ``v`` over rows ordered before or equal to this row
    (within each ``by`` group), for every ``v`` in ``values``."""
    by = list(by or [])
    spark = df.sparkSession
    parts = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.col(order).desc() if descending else F.col(order).asc()
    ranged = materialize(df.repartitionByRange(parts, *[F.col(b) for b in by], key)
                         .withColumn("_pid", F.spark_partition_id()))
    w = (Window.partitionBy("_pid", *by).orderBy(key)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(v).over(w).alias(f"_loc_{v}") for v in values])
    totals = (ranged.groupBy("_pid", *by).agg(*[F.sum(v).alias(f"_tot_{v}") for v in values])
              .collect())   # one row per (partition, group): bounded by partitions x groups
    totals.sort(key=lambda r: r["_pid"])
    running: dict = {}
    offsets = []
    for r in totals:
        g = tuple(r[b] for b in by)
        acc = running.setdefault(g, [0] * len(values))
        offsets.append((r["_pid"], *g, *acc))
        for i, v in enumerate(values):
            acc[i] += r[f"_tot_{v}"] or 0
    fields = [T.StructField("_pid", T.IntegerType())] + [
        T.StructField(b, df.schema[b].dataType) for b in by] + [
        T.StructField(f"_off_{v}", df.schema[v].dataType if isinstance(
            df.schema[v].dataType, T.DoubleType) else T.LongType()) for v in values]
    off = spark.createDataFrame(offsets, T.StructType(fields))
    cond = local["_pid"] == off["_pid"]
    for b in by:
        cond = cond & local[b].eqNullSafe(off[b])
    joined = local.join(F.broadcast(off), cond, "left")
    out_cols = [local[c] for c in df.columns] + [
        (F.col(f"_loc_{v}") + F.coalesce(F.col(f"_off_{v}"), F.lit(0))).alias(f"cum_{v}") for v in values]
    return joined.select(*out_cols)
