"""Connected components of an edge table by distributed minimum labels."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize


LEAST_TASKS, TASK_EDGES = 8, 50_000
BROADCAST_LABELS = 200_000     # rows (16 bytes each) of a label table sent to all tasks at most


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and reread. Unlike a checkpoint, which keeps the size estimated
    for its plan (a product of all sizes joined, so its digits triple with each round of a loop), it has the
    size of its files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node of an edge, ``component`` the smallest node
    it reaches. Each round takes the least label among the neighbours and then
    jumps to the label's own label, so rounds grow with the logarithm of the
    longest path; the labels of each round are written to the checkpoint folder."""
    edges = materialize(edges.select(F.col(a).alias(a), F.col(b).alias(b)))
    # few edges need few tasks, each round anew
    parts = min(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(LEAST_TASKS, edges.count() // TASK_EDGES + 1))
    edges = edges.coalesce(parts)
    both = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                  .union(edges.select(F.col(b), F.col(a))).filter("u <> v").distinct().coalesce(parts))
    labels = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select(F.col("u").alias("node"), F.least("u", "m").alias("component")).coalesce(parts))
    # labels of a checked size go to all tasks, which saves the shuffles of every round
    small = labels.count() <= BROADCAST_LABELS
    while True:
        if small:
            labels = F.broadcast(labels)
        near = (both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("m")))
        step = (near.join(labels, labels["node"] == near["u"])
                .select("node", F.least("component", "m").alias("component"), F.col("component").alias("old")))
        up = labels.select(F.col("node").alias("root"), F.col("component").alias("up"))
        up = F.broadcast(up) if small else up
        new = stored(step.join(up, step["component"] == up["root"], "left")
                     .select("node", F.least("component", F.coalesce("up", "component")).alias("component"), "old").coalesce(parts))
        changed = new.filter("component <> old").limit(1).count()
        labels = new.drop("old")
        if not changed:
            return labels
