"""Operator 10: exact top-k inner products with an impact-ordered index.

Every block of vectors is an index of posting segments: the components of one
impact level (their magnitude, in octaves), stored with quantised impacts. A query
adds up segments from the highest level down, score at a time. After a level the
components not seen are bounded by Cauchy-Schwarz (the norm of what is left of a
vector is in the index) and the quantisation by its step, so every score has a
lower and an upper bound; a query stops only when few vectors can still be
members, that is when their upper bound reaches the k-th lower bound. Those are
rescored exactly in integers. Blocks give k rows for each query, merged by query.

Queries are a stated set against all rows, met in blocks: vectors and queries are
packed into bounded blocks and joined block by block.

Defined results: a null vector, or one with a null or non-finite component, takes
no part; a null id takes no part; missing components of shorter vectors count as
0; a query has no candidates among rows with its own id, repeated rows of a query
ask once, repeated candidates stand once each; no queries give an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .blocks import pack, unpack

LEVELS = (64, 32, 16, 8, 4, 0)      # least magnitude of a level
STEP_BITS = 2                       # impacts are kept to a step of 4
POSSIBLE = 64                       # members left to rescore when a query may stop
BLOCK_ROWS, CHUNK_QUERIES, SLICE = 8192, 16384, 256


def integer_vector(v: Column) -> Column:
    """floor(256 x) of every component, null unless all components are finite numbers."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda x: F.floor(x.cast("double") * 256).cast("long")))


def _pack_rows(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                b = batch.slice(lo, rows)
                v = b.column("v")
                n = np.diff(v.offsets.to_numpy())
                flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                mat = np.zeros((len(n), int(n.max(initial=0))), np.int64)
                mat[np.arange(mat.shape[1])[None, :] < n[:, None]] = flat
                kind = "<i2" if abs(mat).max(initial=0) < 1 << 15 else "<i8"
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pack([b.column("vec_id").to_numpy(), np.array(mat.shape), mat.astype(kind).ravel()])], pa.binary())],
                    names=["blob"])
    return run


def _open(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids, shape, flat = unpack(blob)
    return ids, flat.reshape(shape).astype(np.int64)


class Segments:
    """The posting segments of a block by impact level, and the norms left below each."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        size = np.abs(vectors)
        coarse = ((vectors >> STEP_BITS) << STEP_BITS) + ((1 << STEP_BITS) - 1) / 2
        big = int(size.max(initial=0)) ** 2 * max(1, vectors.shape[1]) * 2 >= 1 << 23
        kind = np.float64 if big else np.float32            # sums stay exact
        top = np.iinfo(np.int64).max
        self.parts, self.rest = [], []
        for low in LEVELS:
            here = (size >= low) & (size < top)
            self.parts.append(np.where(here, coarse, 0).T.astype(kind))
            self.rest.append(np.sqrt((np.where(size < low, vectors, 0).astype(np.float64) ** 2).sum(1)))
            top = low
        self.kind = kind


def search(index: Segments, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, candidate row, score) of the k best of the block for each query."""
    n, v = len(queries), len(ids)
    score = np.zeros((n, v), index.kind)
    blocked = own[:, None] == ids[None, :]
    norm = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    step = np.abs(queries).sum(1) * ((1 << STEP_BITS) - 1) / 2
    live = np.arange(n)
    out_q, out_c = [], []
    for level, part in enumerate(index.parts):
        score[live] += queries[live].astype(index.kind) @ part
        last = level == len(index.parts) - 1
        if not last and LEVELS[level] > 8:
            continue
        slack = norm[live, None] * index.rest[level][None, :] + step[live, None] + 1
        sure = np.where(blocked[live], -np.inf, score[live] - slack)
        kth = np.partition(sure, v - k, 1)[:, v - k] if v > k else np.full(len(live), -np.inf)
        may = (score[live] + slack >= kth[:, None]) & ~blocked[live]
        stop = np.full(len(live), True) if last else may.sum(1) <= POSSIBLE
        q, c = np.nonzero(may[stop])
        out_q.append(live[stop][q])
        out_c.append(c)
        live = live[~stop]
        if len(live) == 0:
            break
    q, c = np.concatenate(out_q), np.concatenate(out_c)
    exact = np.empty(len(q), np.int64)
    for lo in range(0, len(q), 1 << 16):                        # rescore possible members
        s = slice(lo, lo + (1 << 16))
        exact[s] = (queries[q[s]] * index.vectors[c[s]]).sum(1)
    o = np.lexsort((ids[c], -exact, q))
    q, c, exact = q[o], c[o], exact[o]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    keep = rank < k
    return q[keep], c[keep], exact[keep]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, mat = _open(batch.column("blob")[i].as_py())
                qids, queries = _open(batch.column("queries")[i].as_py())
                d = max(mat.shape[1], queries.shape[1])
                mat = np.pad(mat, ((0, 0), (0, d - mat.shape[1])))
                queries = np.pad(queries, ((0, 0), (0, d - queries.shape[1])))
                index = Segments(mat)
                for lo in range(0, len(qids), SLICE):
                    q, c, s = search(index, ids, queries[lo:lo + SLICE], qids[lo:lo + SLICE], k)
                    yield pa.RecordBatch.from_arrays([pa.array(qids[lo + q]), pa.array(ids[c]), pa.array(s)],
                                                     names=["query_id", "vec_id", "score"])
    return run


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
               vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` rows of ``vectors`` with the
    highest integer inner product, ties to the smaller id."""
    rows = lambda df: df.select(F.col(id_col).cast("long").alias("vec_id"), integer_vector(F.col(vector_col)).alias("v")).filter(
        "vec_id is not null and v is not null")
    asked = rows(queries).distinct()
    chunks = max(1, -(-asked.count() // CHUNK_QUERIES))

    def chunk(t: pa.Table) -> pa.Table:
        blobs = list(_pack_rows(t.num_rows)(iter(t.select(["vec_id", "v"]).combine_chunks().to_batches())))
        return pa.table({"chunk": t.column("chunk").slice(0, 1), "queries": pa.Table.from_batches(blobs).column("blob")})

    packed = (asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))
              .groupBy("chunk").applyInArrow(chunk, "chunk int, queries binary"))
    # every block of vectors meets every chunk of queries
    blocks = rows(vectors).mapInArrow(_pack_rows(BLOCK_ROWS), "blob binary")
    met = (blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
           .repartition("blob", "chunk").join(packed, "chunk").select("blob", "queries"))
    best = met.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
