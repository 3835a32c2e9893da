"""Operator 8: length buckets of least padding, and token-budget batches in them.

Texts are cut into sequences of at most ``max_tokens`` words. The histogram of
their lengths (``max_tokens + 1`` counts at most, whatever the corpus) goes to the
driver, where dynamic programming finds the ``buckets`` boundaries with the least
total padding. Every sequence is padded to its bucket's boundary and batches of
one bucket take as many as fit the token budget; a bucket's batches are all full
but its last one. Texts are read once: their lengths are kept with a row number.
Sequences are numbered across ranges of an order by a hash of id, part and row
number, so neither a bucket nor the rows of one id are gathered in a task.

Defined results: a null or empty text is one sequence of length 0; a null id is
passed through; repeated rows are sequences of their own; an empty table gives an
empty one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .numbering import numbered

MAX_TOKENS, BUCKETS, BUDGET = 2048, 16, 65536


def length_buckets(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Ascending boundaries (at most ``buckets`` of the ``lengths``) with the least padding."""
    n = len(lengths)
    if n == 0:
        return []
    c = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    s = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    # cost[i, j]: padding of lengths i..j-1 in one bucket that ends at lengths[j-1]
    cost = lengths[None, :] * (c[None, 1:] - c[:-1, None]) - (s[None, 1:] - s[:-1, None])
    cost = np.where(np.arange(n)[:, None] <= np.arange(n)[None, :], cost, np.inf)
    best = cost[0].copy()
    came = [np.zeros(n, np.int64)]
    for _ in range(1, min(buckets, n)):
        through = np.concatenate([[np.inf], best[:-1]])[:, None] + cost
        came.append(np.minimum(through.argmin(0), np.arange(n)))
        new = through.min(0)
        if not new[-1] < best[-1]:
            came.pop()
            break
        best = new
    out, j = [], n - 1
    for back in reversed(came):
        out.append(int(lengths[j]))
        j = int(back[j]) - 1
        if j < 0:
            break
    return out[::-1]


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))).cast("long")


def pack_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS,
                 buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per sequence: ``doc_id, part, start, length`` (in words), ``bucket``, its
    ``bucket_length``, ``batch`` (within the bucket) and ``position`` in the batch."""
    if budget < max_tokens:
        raise ValueError("the budget must hold a sequence of max_tokens")
    sized = materialize(docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("n"),
                                    F.monotonically_increasing_id().alias("row")))
    parts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr(f"cast((n - 1) div {max_tokens} as int)")))
    seqs = sized.select("doc_id", "n", "row", F.explode(parts).alias("part")).select(
        "doc_id", "row", "part", (F.col("part").cast("long") * max_tokens).alias("start"),
        F.least(F.col("n") - F.col("part") * max_tokens, F.lit(max_tokens)).cast("int").alias("length"))
    seqs = seqs.select("*", F.xxhash64("doc_id", "part", "row").alias("mix"))
    hist = seqs.groupBy("length").count().orderBy("length").collect()     # max_tokens + 1 rows at most
    ends = length_buckets(np.array([r["length"] for r in hist], np.int64), np.array([r["count"] for r in hist], np.int64), buckets)
    if not ends:
        return seqs.select("doc_id", "part", "start", "length", F.lit(0).alias("bucket"), F.lit(0).alias("bucket_length"),
                           F.lit(0).cast("long").alias("batch"), F.lit(0).cast("long").alias("position"))
    bucket, size = F.lit(len(ends) - 1), F.lit(ends[-1])
    for i in reversed(range(len(ends) - 1)):
        bucket = F.when(F.col("length") <= ends[i], i).otherwise(bucket)
        size = F.when(F.col("length") <= ends[i], ends[i]).otherwise(size)
    placed = numbered(seqs.withColumn("bucket", bucket).withColumn("bucket_length", size),
                      "bucket", ["bucket", "mix", "row", "part"], "at")
    room = F.expr(f"cast({budget} div greatest(bucket_length, 1) as long)")
    return placed.select("doc_id", "part", "start", "length", "bucket", "bucket_length",
                         F.expr(f"at div cast({budget} div greatest(bucket_length, 1) as long)").alias("batch"),
                         F.pmod("at", room).alias("position"))
