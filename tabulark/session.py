"""Session helpers: building a session for tests/bench and reading cluster settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest lookup table we are willing to ship to every task as a broadcast.
DEFAULT_BROADCAST_ROWS = 100_000


def build_session(master: str | None = None, app: str = "tabulark",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and benchmarks (a cluster brings its own)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TABULARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only when the
    cluster has not named one (tests, local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tabulark-ckpt-")
    sc.setCheckpointDir(local)
    return local


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the cluster's checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_lookup(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Prepare a fitted lookup frame (one row per group) for a join back.

    The frame is computed once. If it has at most ``max_rows`` rows it is rebuilt
    on the driver as a local relation and marked for broadcast (size proven by
    the count); otherwise it is checkpointed and left to a shuffle join, where
    AQE can still split skewed partitions.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        local = df.sparkSession.createDataFrame(rows, schema=df.schema)
        return F.broadcast(local), True
    return materialize(df), False
