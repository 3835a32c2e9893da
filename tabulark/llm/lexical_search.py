"""Operator 11: ranked lexical search by grouping documents under presence masks.

Items (a stated query set) are met with all documents in blocks. Documents become blocks
of postings: the terms of each that any item of the block asks for, with their counts.
From these come, in one job, the number of documents and terms and each term's document
count, and with them the weights. Then, for each item and block of documents:

* the documents of each of the item's terms are set as bits of a bitmap, one row a term;
  read down the columns, a document's bits are its *presence mask*, and documents with
  equal masks make a group;
* a mask's maximum score is the sum, over its terms, of the greatest contribution the
  term has in the block;
* groups are evaluated exactly, in integers, by descending maximum score; the item is
  finished when the next maximum is below the score of its k-th document so far, which
  is carried from block to block of a task (at equality it goes on, as a smaller id wins).

Each task gives at most k documents an item. These are ranked first by item and a part of
the ids, then by item, so no task gets the lists of all tasks.

What travels with the tasks are the terms of one block of items: blocks are cut so that
they have some ``ITEM_PAIRS`` different (item, term) pairs and ``ITEM_BYTES`` of terms, and
the driver counts both before it fetches one (an item larger than that is a block of its
own). More items make more blocks, each a pass over the documents.

Defined results: a null or empty text has no terms; documents without any are not counted;
a null document id ranks behind all others of its score; repeated rows of documents are
documents each; rows of one item id are one item that asks for the terms of all its
different texts (a null item id is an item like others); an item without terms, or whose
terms no document holds, has no rows; scores of 0 have no rows; empty tables give an empty
result; ids are read as long; other columns are not read, so no name can clash. A very long
text is read in slices that end between terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .blocks import pack, ragged, unpack

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ITEM_PAIRS, ITEM_BYTES = 1 << 17, 8 << 20
BLOCK_DOCS, BLOCK_POSTINGS, SLICE_BYTES = 8192, 1 << 20, 1 << 20
BITS_AT_ONCE = 1 << 25              # bits of one bitmap
SALT = 64                           # parts of the first ranking

_PLAIN = bytearray(b" " * 128 + bytes(range(128, 256)))
for _c in "0123456789" + LOWER:
    _PLAIN[ord(_c)] = ord(_c)
for _a, _b in zip(UPPER, LOWER):
    _PLAIN[ord(_a)] = ord(_b)
_PLAIN = bytes(_PLAIN)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in slices."""
    plain = text.translate(_PLAIN)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + SLICE_BYTES) if len(plain) - at > SLICE_BYTES else -1
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, term, n`` of the different texts of each item."""
    texts = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).filter("text is not null").distinct()
    plain = F.translate("text", UPPER, LOWER)
    terms = texts.select("item_id", F.explode(F.regexp_extract_all(plain, F.lit(f"({TERM})"))).alias("term"))
    return terms.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("n"))


def _index(vocabulary: dict[bytes, int]):
    """Blocks of documents: ids, lengths and the counts of terms in the vocabulary."""
    def flush(ids, sizes, rows) -> pa.RecordBatch:
        n = np.array(sizes, np.int64)
        per = np.array([len(t) for t, _ in rows], np.int64)
        term = np.concatenate([t for t, _ in rows]) if rows else np.zeros(0, np.int32)
        tf = np.concatenate([c for _, c in rows]) if rows else np.zeros(0, np.int64)
        known = np.array([i is not None for i in ids], np.uint8)
        blob = pack([np.array([i or 0 for i in ids], np.int64), known, n, per, term.astype(np.int32), tf.astype(np.int64)])
        terms, df = np.unique(term, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([blob], pa.binary()), pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
             pa.array([terms.astype(np.int32).tolist()], pa.list_(pa.int32())), pa.array([df.astype(np.int64).tolist()], pa.list_(pa.int64()))],
            names=["blob", "docs", "terms", "term", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, rows, postings = [], [], [], 0
        get = vocabulary.get
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                n, found = 0, []
                for words in _words(text.as_py() or b""):
                    n += len(words)
                    t = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                    found.append(np.unique(t[t >= 0], return_counts=True))
                if n == 0:
                    continue
                if len(found) > 1:
                    t, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                    c = np.zeros(len(t), np.int64)
                    np.add.at(c, at, np.concatenate([f[1] for f in found]))
                    found = [(t, c)]
                ids.append(doc_id.as_py())
                sizes.append(n)
                rows.append(found[0])
                postings += len(found[0][0])
                if len(ids) >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield flush(ids, sizes, rows)
                    ids, sizes, rows, postings = [], [], [], 0
        if ids:
            yield flush(ids, sizes, rows)
    return run


class Block:
    """Postings of a block of documents with the impact of each."""

    def __init__(self, blob: bytes, n_docs: int, n_terms: int):
        self.ids, known, size, per, self.term, tf = unpack(blob)
        self.known = known.astype(bool)
        if int(size.max(initial=0)) * 25 * n_docs < 1 << 62:
            m = 75 + (25 * n_docs * size) // n_terms
        else:
            m = np.array([75 + 25 * n_docs * int(n) // n_terms for n in size], np.int64)
        self.start = np.concatenate([[0], np.cumsum(per)])
        doc = np.repeat(np.arange(len(per)), per)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
        order = np.argsort(self.term, kind="stable")             # the same postings, term by term
        self.by_term, self.by_doc = self.term[order], doc[order]
        self.terms, self.first = np.unique(self.by_term, return_index=True)
        self.last = np.append(self.first[1:], len(order))
        self.most = np.maximum.reduceat(self.impact[order], self.first) if len(order) else np.zeros(0, np.int64)

    def masks(self, at: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Presence masks of the documents ``lo`` to ``hi`` over the terms at ``at``: the different
        ones as rows of booleans, the documents with any term, and which mask each has."""
        bitmap = np.zeros((len(at), hi - lo), np.uint8)
        length = self.last[at] - self.first[at]
        doc = self.by_doc[ragged(self.first[at], length)] - lo
        row = np.repeat(np.arange(len(at)), length)
        inside = (doc >= 0) & (doc < hi - lo)
        bitmap[row[inside], doc[inside]] = 1
        packed = np.packbits(bitmap, axis=0)
        wide = np.zeros((-(-len(packed) // 8) * 8, hi - lo), np.uint8)
        wide[:len(packed)] = packed
        columns = np.ascontiguousarray(wide.T).view(np.uint64)
        docs = np.flatnonzero(columns.any(1))
        columns = columns[docs]
        order = np.lexsort(columns.T)
        columns = columns[order]
        new = np.ones(len(order), bool)
        new[1:] = (columns[1:] != columns[:-1]).any(1)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        distinct = np.unpackbits(np.ascontiguousarray(columns[new]).view(np.uint8).reshape(-1, len(wide)), axis=1)[:, :len(at)]
        return distinct, docs + lo, group

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of documents; ``weight`` by term of the vocabulary."""
        length = self.start[docs + 1] - self.start[docs]
        at = ragged(self.start[docs], length)
        sums = np.concatenate([[0], np.cumsum(weight[self.term[at]] * self.impact[at])])
        ends = np.cumsum(length)
        return sums[ends] - sums[ends - length]


class Best:
    """The k best documents of an item so far: highest score, then known and smallest id."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        use = score >= max(1, self.least)
        if use.any():
            score, ids, known = (np.concatenate([a, b[use]]) for a, b in ((self.score, score), (self.ids, ids), (self.known, known)))
            order = np.lexsort((ids, ~known, -score))[:self.k]
            self.score, self.ids, self.known = score[order], ids[order], known[order]


def search_block(block: Block, term: np.ndarray, value: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Add a block's documents to ``best`` for an item with terms ``term`` of total weights ``value``;
    ``weight`` is a scratch array over the vocabulary. Returns the number of documents evaluated."""
    at = np.searchsorted(block.terms, term)
    here = (at < len(block.terms)) & (value > 0)
    here[here] = block.terms[at[here]] == term[here]
    if not here.any():
        return 0
    at, term, value = at[here], term[here], value[here]
    weight[term] = value
    evaluated = 0
    step = max(64, BITS_AT_ONCE // len(at))
    for lo in range(0, len(block.ids), step):
        masks, docs, group = block.masks(at, lo, min(lo + step, len(block.ids)))
        most = masks.astype(np.int64) @ (value * block.most[at])
        order = np.argsort(-most, kind="stable")
        by_group = np.argsort(group, kind="stable")
        size = np.bincount(group, minlength=len(most))
        starts = np.cumsum(size) - size
        met = np.cumsum(size[order])                             # documents up to each mask
        done, take = 0, best.k
        while done < len(order):
            if most[order[done]] < best.least:
                break                                            # no mask left can reach the list
            upto = int(np.searchsorted(met, take)) + 1
            part = order[done:upto]
            part = part[most[part] >= best.least]
            chosen = docs[by_group[ragged(starts[part], size[part])]]
            best.add(block.scores(chosen, weight), block.ids[chosen], block.known[chosen])
            evaluated += len(chosen)
            done, take = upto, 2 * int(met[min(upto, len(met)) - 1])
    weight[term] = 0
    return evaluated


def _search(items: list[tuple[int | None, np.ndarray, np.ndarray]], size: int, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        weight = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column("blob"):
                block = Block(blob.as_py(), n_docs, n_terms)
                for (_, term, value), b in zip(items, best):
                    search_block(block, term, value, weight, b)
        for (item, _, _), b in zip(items, best):
            if len(b.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(b.score), pa.int64()), pa.array(b.ids, mask=~b.known), pa.array(b.score)],
                    names=["item_id", "doc_id", "score"])
    return run


def lexical_topk(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring rows of ``docs`` for each item."""
    spark = docs.sparkSession
    pairs = materialize(item_terms(items, item_col, item_text_col).withColumn("spread", F.xxhash64("item_id")))
    size = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.col("term").cast("binary"))).alias("bytes")).first()
    found = [spark.createDataFrame([], "item_id long, doc_id long, score long")]
    blocks = max(-(-size["n"] // ITEM_PAIRS), -(-(size["bytes"] or 0) // ITEM_BYTES))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    for b in range(blocks):
        asked = pairs.filter(F.pmod("spread", F.lit(blocks)) == b).collect()     # one block of items: counted above
        vocabulary = {t: i for i, t in enumerate(sorted({r["term"].encode() for r in asked}))}
        index = materialize(rows.mapInArrow(_index(vocabulary), "blob binary, docs long, terms long, term array<int>, df array<long>"))
        totals = index.agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
        n_docs, n_terms = totals["docs"] or 0, totals["terms"] or 0
        if n_terms == 0:
            continue
        counts = index.select(F.explode(F.arrays_zip("term", "df")).alias("e")).groupBy("e.term").agg(F.sum("e.df").alias("df"))
        df = np.zeros(len(vocabulary), np.int64)
        for r in counts.collect():                               # at most one row a term of the block
            df[r["term"]] = r["df"]
        weight = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)
        weight[df == 0] = 0
        wanted: dict[int | None, list[tuple[int, int]]] = {}
        for r in asked:
            wanted.setdefault(r["item_id"], []).append((vocabulary[r["term"].encode()], r["n"]))
        ready = []
        for item, terms in wanted.items():
            t, n = np.array(sorted(terms), np.int64).T
            ready.append((item, t, n * weight[t]))
        found.append(index.select("blob").mapInArrow(_search(ready, len(vocabulary), n_docs, n_terms, k), "item_id long, doc_id long, score long"))
    best = found[0]
    for f in found[1:]:
        best = best.unionByName(f)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SALT))
    best = best.withColumn("part", part).withColumn("place", F.row_number().over(
        Window.partitionBy("item_id", "part").orderBy(*order))).filter(F.col("place") <= k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
