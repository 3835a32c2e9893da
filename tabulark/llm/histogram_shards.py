"""Operator 5: shards of near-equal bytes by histogram sort.

Rows are ordered by a hash of their text, then id, then row, so equal texts stand
together. The order is cut where the bytes below a boundary reach each shard's
share: every round counts the exact bytes in the slots of each open bracket (one
aggregation of narrow rows, a bounded number of counts on the driver) and goes on
inside the slot that holds the target, until a boundary is within the tolerance.
A text that alone exceeds the tolerance is cut by id, a repeated id by row, so a
hot group spreads over shards. Then the rows are exchanged once, range by range,
and numbered from the counts of the ranges before them.

Defined results: a null text has no bytes (size 1, checksum 0); null ids come last
among equal texts; repeated rows are rows of their own; an empty table gives an
empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .numbering import numbered

SLOTS = 128               # counts of a bracket and round
TOLERANCE = 1000          # a boundary may miss its target by a shard's share / 1000
LEVELS = ("key", "ord", "rid")
NULL_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Bracket:
    """Open interval ``[lo, hi)`` of a level below fixed values of the levels before it."""
    prefix: tuple
    lo: int
    hi: int
    below: int            # exact bytes before it

    def width(self) -> int:
        return max(1, -(-(self.hi - self.lo) // SLOTS))

    def slot(self):
        c = F.col(LEVELS[len(self.prefix)])
        inside = (c >= F.lit(self.lo)) & (c <= F.lit(self.hi - 1))
        for name, value in zip(LEVELS, self.prefix):
            inside = inside & (F.col(name) == F.lit(value))
        # ids may span more than a long holds
        wide = "cast({} as decimal(20,0))".format
        return inside, F.expr(f"cast(({wide(LEVELS[len(self.prefix)])} - {wide(repr(str(self.lo)))}) div {wide(repr(str(self.width())))} as long)"
                              if self.prefix else f"({LEVELS[0]} - {self.lo}L) div {self.width()}L")


def splitters(rows: DataFrame, shards: int, tolerance: int = TOLERANCE) -> list[tuple]:
    """``shards - 1`` ascending lower bounds ``(key, ord, rid)`` of the shards after the first."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    allowed = max(1, total // shards // tolerance)
    goal = {j: total * j // shards for j in range(1, shards)}
    at = {j: Bracket((), 0, (1 << 63) - 1, 0) for j in goal}
    found: dict[int, tuple] = {}
    while total and len(found) < len(goal):
        open_ = sorted({at[j] for j in goal if j not in found}, key=lambda b: (b.prefix, b.lo))
        which = slot = None
        for i, b in enumerate(open_):                          # brackets are equal or disjoint
            inside, s = b.slot()
            which = F.when(inside, i) if which is None else which.when(inside, i)
            slot = F.when(inside, s) if slot is None else slot.when(inside, s)
        level = F.col(LEVELS[0])
        depth = {len(b.prefix) for b in open_}
        if depth != {0}:
            level = F.coalesce(*[F.when(which == i, F.col(LEVELS[len(b.prefix)])) for i, b in enumerate(open_)])
        counts = (rows.select(which.alias("b"), slot.alias("s"), level.alias("v"), "size").filter("b is not null")
                  .groupBy("b", "s").agg(F.sum("size").alias("bytes"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                  .collect())                                  # at most SLOTS for each bracket
        by: dict[int, list] = {}
        for r in sorted(counts, key=lambda r: (r["b"], r["s"])):
            by.setdefault(r["b"], []).append(r)
        for j in goal:
            if j in found:
                continue
            b = at[j]
            below = b.below
            for r in by[open_.index(b)]:
                end = below + r["bytes"]
                if goal[j] < end:
                    break
                below = end
            last = r["lo"] == r["hi"] and len(b.prefix) == len(LEVELS) - 1
            if goal[j] - below <= allowed or (last and goal[j] - below <= end - goal[j]):
                found[j] = (*b.prefix, r["lo"])
            elif end - goal[j] <= allowed or last:
                found[j] = (*b.prefix, r["hi"] + 1)
            elif r["lo"] == r["hi"]:
                at[j] = Bracket((*b.prefix, r["lo"]), -(1 << 63), 1 << 63, below)
            else:
                at[j] = Bracket(b.prefix, r["lo"], r["hi"] + 1, below)
    return [found[j] + (None,) * (len(LEVELS) - len(found[j])) for j in sorted(found)]


def _not_below(bound: tuple):
    """Rows at or after a lower bound (levels it leaves open start at their least value)."""
    out = None
    for name, value in reversed([(n, v) for n, v in zip(LEVELS, bound) if v is not None]):
        c = F.col(name)
        out = (c >= F.lit(value)) if out is None else (c > F.lit(value)) | ((c == F.lit(value)) & out)
    return out


def histogram_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                     tolerance: int = TOLERANCE) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.shiftrightunsigned(F.xxhash64(text), 1).alias("key"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("ord"),
        F.monotonically_increasing_id().alias("rid")))
    shard = F.lit(0)
    for bound in splitters(rows, shards, tolerance):
        shard = shard + _not_below(bound).cast("int")
    out = numbered(rows.withColumn("shard", shard), "shard", ["key", "ord", "rid"], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                           F.lit(None).cast("int").alias("grown_shard"))
