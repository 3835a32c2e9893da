"""Gapless numbers within groups in a global order, with one exchange."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _number(first: dict[tuple[int, int], int], group: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for b in batches:
            pid = b.column("_pid").to_numpy(zero_copy_only=False).astype(np.int64)
            own = b.column(group).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.empty(len(pid), np.int64)
            for p, g in np.unique(np.stack([pid, own], 1), axis=0).tolist() if len(pid) else []:
                rows = np.flatnonzero((pid == p) & (own == g))
                at[rows] = first[p, g] + seen.get((p, g), 0) + np.arange(len(rows))
                seen[p, g] = seen.get((p, g), 0) + len(rows)
            yield b.drop_columns(["_pid"]).append_column(name, pa.array(at))
    return run


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, ... within each integer ``group`` in the given order.

    Rows are exchanged once by ranges of the order (a large group spreads over many
    ranges) and kept in a checkpoint, so that ranges don't change; each range numbers
    its rows from the count of the ranges before it, a few counts for each range."""
    ranged = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()))
    counts = ranged.groupBy("_pid", group).count().collect()
    first, total = {}, {}
    for r in sorted(counts, key=lambda r: (r["_pid"], r[group])):
        first[r["_pid"], r[group]] = total.get(r[group], 0)
        total[r[group]] = total.get(r[group], 0) + r["count"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return ranged.mapInArrow(_number(first, group, name), f"{kinds}, `{name}` long")
