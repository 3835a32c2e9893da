"""Operator 13: how filters interact, by contracting contingency tensors.

Each row fails or passes every filter, whatever the order they run in. So the counts
of one part of a corpus over the 2^n patterns of failures, reshaped to a tensor with
one axis of (pass, fail) a filter, hold the results of every order: an order's step is
one contraction that selects *pass* on the axes before it, *fail* on its own and *all*
on the rest. Three tensors a part (rows, rows that a first flag marks, rows that a
second one marks) are all that leaves the aggregation, so the work of all orders does
not grow with the corpus; one ``einsum`` a batch of parts contracts them.

``audit_filters`` takes failure columns and gives every order; ``document_failures``
makes the five failure columns of ``op13``. Texts are met once, where they are; whether
a text stands in a smaller id is found from digests, first pre-aggregated by (digest,
part, id), so a hot text has no hot task: of a text's rows only those at its smallest id
pass, and these are found by joining on (digest, id) together.

Defined results: a null text is empty (and equal to other empty ones); a null failure
counts as passed, a null flag as not marked; a null part is the empty string; a null id
has no smaller id and is not one, so its row never fails as a copy and makes no other row
fail; rows with one id and text all stand at that id; repeated rows count each; labels of
an id that differ mark it if any does; an empty table gives no parts and no rows; columns
of ``docs`` other than those named are not read, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
MAX_FILTERS = 6                     # 720 orders of 6 steps a part
PARTS_AT_ONCE = 64


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, distinct words, characters, capitals and symbols of whole texts."""
    others = bytes(set(range(256)) - set(UPPER.encode()))
    symbols = bytes(set(range(256)) - set(b"#$%&*|"))
    continued = bytes(range(0x80, 0xC0))
    for batch in batches:
        rows = []
        for value in batch.column("text"):
            text = value.as_py() or b""
            words = text.split()                     # bytes split at exactly 0x20 and 0x09-0x0D
            rows.append((len(words), len(set(words)), len(text.translate(None, continued)),
                         len(text.translate(None, others)), len(text.translate(None, symbols))))
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)],
            names=kept + ["words", "distinct_words", "chars", "capitals", "symbols"])


def document_failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``id, part, digest, n, A, B, C, D, E``: rows of ``docs`` grouped by text, part and id, ``n`` rows
    each; ``E`` tells that the same text stands at a smaller id anywhere in the table."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    met = rows.mapInArrow(_counts, f"id {kind}, part string, digest binary, words long, distinct_words long, "
                                   "chars long, capitals long, symbols long")
    fails = met.select(
        "id", "part", "digest", (F.col("words") < 50).alias("A"), (100 * F.col("distinct_words") < 65 * F.col("words")).alias("B"),
        (100 * F.col("capitals") > 5 * F.col("chars")).alias("C"), (F.col("symbols") > 0).alias("D"))
    grouped = fails.groupBy("digest", "part", "id").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in "ABCD"])
    first = grouped.groupBy("digest").agg(F.min("id").alias("id"))
    # a text's rows at its smallest id; all other rows with an id are copies
    first = first.filter("id is not null").select(F.col("digest").alias("_digest"), F.col("id").alias("_id"))
    return grouped.join(first, (F.col("digest") == F.col("_digest")) & (F.col("id") == F.col("_id")), "left").select(
        "id", "part", "digest", "n", *"ABCD", (F.col("id").isNotNull() & F.col("_id").isNull()).alias("E"))


def with_marks(rows: DataFrame, marks: DataFrame, key: str = "id", salt: str = "digest") -> DataFrame:
    """``rows`` with the columns of ``marks`` (one row an id); rows without an id, which find none, are
    dealt by ``salt`` and so fill no single task."""
    dealt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(salt), F.lit(1 << 16))).otherwise(F.lit(0))
    found = marks.withColumnRenamed(key, "_key").withColumn("_salt", F.lit(0).cast("long"))
    return rows.withColumn("_dealt", dealt.cast("long")).join(
        found, (F.col(key) == F.col("_key")) & (F.col("_dealt") == F.col("_salt")), "left").drop("_key", "_salt", "_dealt")


def orders(n: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of ``n`` filters and, for each order and step, the selection on every axis for the
    rows that arrive: an array (orders, steps, axes, 2)."""
    all_orders = list(permutations(range(n)))
    arrive = np.empty((len(all_orders), n, n, 2), np.int64)
    arrive[:] = ALL
    for o, order in enumerate(all_orders):
        for step in range(n):
            arrive[o, step, list(order[:step])] = PASS
    return all_orders, arrive


def _contract(tensors: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """(parts, 2, ..., 2) x (selections, axes, 2) -> (parts, selections)."""
    n = tensors.ndim - 1
    args: list = [tensors, [0, *range(2, n + 2)]]
    for axis in range(n):
        args += [picks[:, axis], [1, axis + 2]]
    return np.einsum(*args, [0, 1], optimize=False)


def contract_orders(tensors: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Counts of all orders and steps, each (parts, orders, steps), of the tensors ``rows``, ``first``
    and ``second`` (parts, 2, ..., 2)."""
    rows = tensors["rows"]
    n = rows.ndim - 1
    all_orders, arrive = orders(n)
    own = np.array(all_orders)
    here = np.arange(n)
    removed_picks, kept_picks, unique_picks, failing_picks = (np.array(arrive) for _ in range(4))
    failing_picks[:] = ALL
    unique_picks[:] = PASS
    for o in range(len(all_orders)):
        removed_picks[o, here, own[o]] = FAIL
        kept_picks[o, here, own[o]] = PASS
        failing_picks[o, here, own[o]] = FAIL
        unique_picks[o, here, own[o]] = FAIL
    flat = lambda picks: picks.reshape(-1, n, 2)                       # noqa: E731
    shape = (len(rows), len(all_orders), n)
    get = lambda name, picks: _contract(tensors[name], flat(picks)).reshape(shape)
    removed = get("rows", removed_picks)
    total = np.zeros((len(rows), n), np.int64)                         # over all orders, by filter
    for o in range(len(all_orders)):
        total[:, own[o]] += removed[:, o]
    return {"kept": get("rows", kept_picks), "removed": removed, "redundant": get("rows", failing_picks) - removed,
            "unique_fails": get("rows", unique_picks), "first_lost": get("first", removed_picks),
            "second_lost": get("second", removed_picks), "shapley": total[:, own]}


def audit_filters(rows: DataFrame, filters: list[str], part: Column, first: Column, second: Column,
                  weight: Column | None = None, names: tuple[str, str] = ("first_lost", "second_lost")) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, <names>, shapley``.

    ``filters`` names boolean failure columns of ``rows`` (their letters make up
    ``filter_order``), ``first`` and ``second`` are flags whose losses are counted and
    ``weight`` is the number of rows that a row stands for."""
    n = len(filters)
    if not 1 <= n <= MAX_FILTERS:
        raise ValueError(f"between 1 and {MAX_FILTERS} filters")
    w = F.lit(1) if weight is None else weight
    pattern = sum((F.coalesce(F.col(f"`{c}`").cast("int"), F.lit(0)) * (1 << (n - 1 - k)) for k, c in enumerate(filters)), F.lit(0))
    marked = lambda flag: F.when(F.coalesce(flag, F.lit(False)), w).otherwise(F.lit(0)).cast("long")      # noqa: E731
    cells = rows.select(F.coalesce(part, F.lit("")).alias("part"), pattern.alias("pattern"), w.cast("long").alias("n"),
                        marked(first).alias("f"), marked(second).alias("s"))
    cells = cells.groupBy("part", "pattern").agg(*[F.sum(c).alias(c) for c in "nfs"])
    # at most 2^n cells a part
    parts = cells.groupBy("part").agg(*[F.map_from_entries(F.collect_list(F.struct("pattern", c))).alias(c) for c in "nfs"])

    def cell(c):
        return lambda p: F.coalesce(F.col(c)[p], F.lit(0))
    dense = [F.transform(F.sequence(F.lit(0), F.lit((1 << n) - 1)), cell(c)).alias(c) for c in "nfs"]
    kept = ["kept", "removed", "redundant", "unique_fails", "first_lost", "second_lost", "shapley"]
    shown = ["".join(filters[f] for f in order) for order in permutations(range(n))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, PARTS_AT_ONCE):
                b = batch.slice(lo, PARTS_AT_ONCE)
                tensors = {name: b.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, *[2] * n)
                           for name, c in (("rows", "n"), ("first", "f"), ("second", "s"))}
                out = contract_orders(tensors)
                each = len(shown) * n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(b.column("part").to_pylist(), object), each), pa.string()),
                     pa.array(np.tile(np.repeat(np.array(shown, object), n), b.num_rows), pa.string()),
                     pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), b.num_rows * len(shown))),
                     *[pa.array(out[k].ravel()) for k in kept]], names=["part", "filter_order", "step", *kept])
    result = parts.select("part", *dense).mapInArrow(
        run, "part string, filter_order string, step int, " + ", ".join(f"{k} long" for k in kept))
    return result.withColumnsRenamed(dict(zip(("first_lost", "second_lost"), names)))
