"""Decision trees grown by Spark: forests of any depth, random cuts, and multinomial boosting.

Rows are packed once into blocks of a checkpointed table; every pass over the data is a map
over blocks whose per-task sums are added up by node.

* **Top levels.** Nodes with more than ``row_bound`` rows are split level by level: each
  task routes its rows and sums statistics by (tree, node, feature, bin), one aggregation
  adds them up and picks each node's split. Cut points are values of the data (quantiles).
* **Below the bound** a node's rows go to one task, which grows the rest of the tree, to
  pure leaves unless a depth is given, over all cut points, a whole level at a time.
* **Random cuts** (extremely randomised trees) draw one seeded uniform cut between the
  node's minimum and maximum for each feature, at the top as below.
* **Boosting** grows one tree a class in each round on shared softmax residuals, with
  Newton leaf values. Scores are a column of the block table, checkpointed every
  ``CHECKPOINT_ROUNDS`` rounds; in between a pass adds the few trees since then.

Statistics of a node decide everything: class weights (``gini``), weight, sum and sum of
squares (``mse``), or residual, curvature and count (``newton``). Subtrees stay a table:
a model beyond ``PORTION_BYTES`` meets the rows in tasks, by portions of subtrees and chunks
of rows, and does not pass through the driver. Bootstrap counts are Poisson draws seeded by tree and block, so a lost task
draws them again. Rows without a label or features, or with a component that is not finite,
are left out of fits.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import MIX_A, MIX_B, MODULUS
from ..session import materialize

SEED = 42
BLOCK_ROWS = 16384
ROW_BOUND = 50_000
HIST_BYTES = 64 << 20               # of the histograms of one pass, per task
DRIVER_BYTES = 4 << 20              # of partial sums that the driver adds up itself
BATCH_BYTES = 4 << 20               # of sums that leave a task at once
PORTION_BYTES = 32 << 20             # of subtrees that a prediction task holds, or that travel with a pass
CHUNK_BYTES = 64 << 20              # of rows that a prediction task holds
FAN_IN = 256                        # partial sums added up by one task
CHECKPOINT_ROUNDS = 10
CELLS = 1 << 20                     # of bins and classes up to which boosting counts rows by cell


# ----------------------------------------------------------------------------
# statistics and rules
# ----------------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """How a node is judged and when it may be split."""

    kind: str = "gini"                  # gini, mse, newton
    max_depth: int | None = None
    min_leaf: int = 1
    max_features: int | None = None     # features drawn for each node (None: all)
    random_cuts: bool = False
    bins: int = 64
    seed: int = SEED

    def quality(self, s: np.ndarray) -> np.ndarray:
        """What a split maximises, summed over its sides; statistics on the last axis."""
        w = self.weight(s)
        top = (s * s).sum(-1) if self.kind == "gini" else (s[..., 1] if self.kind == "mse" else s[..., 0]) ** 2
        return np.divide(top, w, out=np.zeros(np.shape(w)), where=w > 0)

    def weight(self, s: np.ndarray) -> np.ndarray:
        if self.kind == "gini":
            return s.sum(-1)
        return s[..., 0] if self.kind == "mse" else s[..., 2]

    def pure(self, s: np.ndarray) -> np.ndarray:
        if self.kind == "gini":
            return s.max(-1) >= s.sum(-1)
        if self.kind == "mse":
            return s[..., 2] - self.quality(s) <= 1e-12 * np.maximum(s[..., 2], 1e-300)
        return np.zeros(s.shape[:-1], bool)

    def splittable(self, s: np.ndarray, depth: int | np.ndarray) -> np.ndarray:
        deep = self.max_depth is not None and depth >= self.max_depth if np.isscalar(depth) else (
            depth >= self.max_depth if self.max_depth is not None else np.zeros(len(s), bool))
        return ~self.pure(s) & (self.weight(s) >= 2 * self.min_leaf) & ~np.asarray(deep)


def hashed(seed: int, *keys) -> np.ndarray:
    """``functions.hashing.hash_sql`` on arrays of integers."""
    h = np.full(np.broadcast_shapes(*(np.shape(k) for k in keys)), seed % MODULUS, np.int64)
    for k in keys:
        h = (h * 31 + np.asarray(k, np.int64) % MODULUS) % MODULUS
        h = (h * MIX_A + 11) % MODULUS
        h = (h * h + 7) % MODULUS
    return (h * MIX_B + 13) % MODULUS


def child_key(key, side: int):
    """A node's number from its parent's (the root is 1)."""
    return hashed(side + 1, key)


def drawn_features(rule: Rule, tree: int, key: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """Which features each node may split on: ``max_features`` of the usable ones, by seeded hash."""
    if rule.max_features is None or rule.max_features >= usable.shape[1]:
        return usable
    order = hashed(rule.seed + 1, tree, key[:, None], np.arange(usable.shape[1])[None, :])
    order = np.where(usable, order, MODULUS + 1)
    last = np.partition(order, rule.max_features - 1, 1)[:, rule.max_features - 1]
    return usable & (order <= last[:, None])


def drawn_cuts(rule: Rule, tree: int, key: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One uniform cut between the node's minimum and maximum for each feature (below the maximum)."""
    u = hashed(rule.seed, tree, key[:, None], np.arange(low.shape[1])[None, :]) / float(MODULUS)
    return np.where(high > low, np.minimum(low + u * (high - low), np.nextafter(high, -np.inf)), np.nan)


# ----------------------------------------------------------------------------
# flat trees
# ----------------------------------------------------------------------------
@dataclass
class Tree:
    feature: list[int] = field(default_factory=list)       # -1: a leaf
    threshold: list[float] = field(default_factory=list)   # at most it: left
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    stats: list[np.ndarray] = field(default_factory=list)
    key: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)

    def add(self, stats: np.ndarray, key: int, depth: int) -> int:
        for column, v in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.stats, stats),
                          (self.key, int(key)), (self.depth, depth)):
            column.append(v)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, threshold: float, left: np.ndarray, right: np.ndarray) -> tuple[int, int]:
        self.feature[node], self.threshold[node] = int(feature), float(threshold)
        self.left[node] = self.add(left, child_key(self.key[node], 0), self.depth[node] + 1)
        self.right[node] = self.add(right, child_key(self.key[node], 1), self.depth[node] + 1)
        return self.left[node], self.right[node]

    def flat(self) -> Flat:
        return Flat(np.array(self.feature, np.int32), np.array(self.threshold, np.float64), np.array(self.left, np.int32),
                    np.array(self.right, np.int32), np.array(self.stats, np.float64).reshape(len(self.feature), -1))


@dataclass
class Flat:
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    stats: np.ndarray
    gain: np.ndarray | None = None          # of the splits by feature, once the statistics are replaced

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int32)
        going = np.flatnonzero(self.feature[node] >= 0)
        while len(going):
            at = node[going]
            down = x[going, self.feature[at]] <= self.threshold[at]
            node[going] = np.where(down, self.left[at], self.right[at])
            going = going[self.feature[node[going]] >= 0]
        return node

    def gains(self, rule: Rule, d: int) -> np.ndarray:
        """Gain of the splits by feature."""
        at = np.flatnonzero(self.feature >= 0)
        q = rule.quality(self.stats)
        return np.bincount(self.feature[at], q[self.left[at]] + q[self.right[at]] - q[at], minlength=d)


def grow(x: np.ndarray, s: np.ndarray, rule: Rule, tree: int, key: int = 1, depth: int = 0) -> Flat:
    """A whole tree over rows in memory, a level at a time; ``s`` holds each row's statistics."""
    stats, keys = s.sum(0)[None], np.array([key], np.int64)          # of this level's nodes
    x, s = np.asfortranarray(x), np.asfortranarray(s)                # a level reads whole columns
    order = [np.argsort(x[:, f], kind="stable") for f in range(x.shape[1])]
    place = np.empty(x.shape, np.int64, "F")
    for f, o in enumerate(order):
        place[o, f] = np.arange(len(o))
    rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)       # open rows, ascending, and their node in the level
    levels, count = [], 1
    while True:
        feature, threshold = np.full(len(stats), -1, np.int32), np.zeros(len(stats))
        child = np.full((len(stats), 2), -1, np.int32)
        levels.append((feature, threshold, child, stats))
        open_ = np.flatnonzero(rule.splittable(stats, depth))
        if len(open_):
            number = np.full(len(stats), -1)
            number[open_] = np.arange(len(open_))
            node = number[node]
            rows, node = rows[node >= 0], node[node >= 0]
            f, cut, left = best_splits(x, s, place, order, rows, node, stats[open_], keys[open_], rule, tree)
            found = np.flatnonzero(f >= 0)
        if not len(open_) or not len(found):
            break
        at = open_[found]
        feature[at], threshold[at] = f[found], cut[found]
        child[at] = count + np.arange(2 * len(found)).reshape(-1, 2)
        count += 2 * len(found)
        side = (x[rows, f[node]] > cut[node]).astype(np.int64)
        number = np.full(len(open_), -1)
        number[found] = np.arange(len(found))
        node = number[node]
        keep = node >= 0
        rows, node = rows[keep], 2 * node[keep] + side[keep]
        stats = np.stack([left[found], stats[at] - left[found]], 1).reshape(-1, s.shape[1])
        keys = np.stack([child_key(keys[at], 0), child_key(keys[at], 1)], 1).ravel()
        depth += 1
    feature, threshold, child, stats = (np.concatenate([level[i] for level in levels]) for i in range(4))
    return Flat(feature, threshold, child[:, 0].copy(), child[:, 1].copy(), stats)


def best_splits(x, s, place, order, rows, node, stats, keys, rule: Rule, tree: int):
    """(feature, threshold, statistics of the left side) of each node of a level; feature -1: none.

    ``rows`` are the open rows, ascending, ``node`` their nodes; ``order`` sorts all rows by each feature and
    ``place`` is its inverse, so one sort of whole numbers, node above place, orders rows by node and value."""
    n_nodes, (n, d), m = len(stats), x.shape, s.shape[1]
    shift = max(1, n.bit_length())
    mask, above = (1 << shift) - 1, node << shift
    size = np.bincount(node, minlength=n_nodes)
    starts = np.cumsum(size) - size
    by_node = above | rows
    by_node.sort()
    by_node &= mask
    low, high = np.empty((n_nodes, d)), np.empty((n_nodes, d))
    for f in range(d):
        v = x[by_node, f]
        low[:, f], high[:, f] = np.minimum.reduceat(v, starts), np.maximum.reduceat(v, starts)
    drawn = drawn_features(rule, tree, keys, high > low)
    cuts = drawn_cuts(rule, tree, keys, low, high) if rule.random_cuts else None
    best = np.full(n_nodes, -np.inf)
    feature, threshold, left = np.full(n_nodes, -1), np.zeros(n_nodes), np.zeros_like(stats)
    for f in range(d):
        nodes = np.flatnonzero(drawn[:, f])
        if not len(nodes):
            continue
        use = slice(None) if len(nodes) == n_nodes else drawn[:, f][node]
        if rule.random_cuts:
            mine_rows, at = rows[use], node[use]
            low_side = x[mine_rows, f] <= cuts[at, f]
            mine_rows, at = mine_rows[low_side], at[low_side]
            mine = np.stack([np.bincount(at, s[mine_rows, j], n_nodes) for j in range(m)], 1)
            rest = stats - mine
            where = np.flatnonzero(drawn[:, f] & (rule.weight(mine) >= rule.min_leaf) & (rule.weight(rest) >= rule.min_leaf))
            cut, mine = cuts[where, f], mine[where]
            score = rule.quality(mine) + rule.quality(rest[where])
        else:
            key = above[use] | place[rows[use], f]
            key.sort()
            key &= mask
            sorted_rows = order[f][key]
            v = x[sorted_rows, f]
            at = np.repeat(nodes, size[nodes])
            edge = v[1:] > v[:-1]
            edge[np.cumsum(size[nodes])[:-1] - 1] = False                      # between two nodes
            edge = np.flatnonzero(edge)
            if not len(edge):
                continue
            where = at[edge]
            first = np.zeros(n_nodes, np.int64)                                # of each node in this order
            first[nodes] = np.cumsum(size[nodes]) - size[nodes]
            mine = np.empty((m, len(edge)))
            for j in range(m):
                sums = np.cumsum(s[sorted_rows, j])
                before = np.where(first > 0, sums[np.maximum(first, 1) - 1], 0.0)
                np.subtract(sums[edge], before[where], out=mine[j])
            rest = stats.T[:, where] - mine
            ok = (rule.weight(mine.T) >= rule.min_leaf) & (rule.weight(rest.T) >= rule.min_leaf)
            if not ok.all():
                edge, mine, rest, where = edge[ok], mine[:, ok], rest[:, ok], where[ok]
            if not len(edge):
                continue
            score = rule.quality(mine.T) + rule.quality(rest.T)
            # the first of the best of each node
            runs = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
            top = np.repeat(np.maximum.reduceat(score, runs), np.diff(np.append(runs, len(where))))
            pick = np.flatnonzero(score == top)
            pick = pick[np.concatenate([[True], where[pick][1:] != where[pick][:-1]])]
            edge, mine, where, score = edge[pick], mine[:, pick].T, where[pick], score[pick]
            cut = v[edge] + (v[edge + 1] - v[edge]) / 2
            cut = np.where(cut < v[edge + 1], cut, v[edge])
        better = score > best[where]
        where = where[better]
        best[where], feature[where], threshold[where], left[where] = score[better], f, cut[better], mine[better]
    return feature, threshold, left


# ----------------------------------------------------------------------------
# blocks of rows
# ----------------------------------------------------------------------------
def feature_array(df: DataFrame, col: str) -> Column:
    return vector_to_array(F.col(col), "float64") if df.schema[col].dataType.simpleString() == "vector" else F.col(col).cast("array<double>")


def pack_blocks(df: DataFrame, features_col: str = "features", label_col: str = "label", rows: int = BLOCK_ROWS) -> tuple[DataFrame, int, int]:
    """Table of blocks (no, n, x, y), the number of features and of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, xs, ys, n = TaskContext.get().partitionId() << 32, [], [], 0

        def out(x, y):
            return pa.RecordBatch.from_arrays([pa.array([no], pa.int64()), pa.array([len(y)], pa.int32()), pa.array([x.tobytes()], pa.binary()),
                                               pa.array([y.tobytes()], pa.binary())], names=["no", "n", "x", "y"])
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                b = batch.slice(lo, rows)
                xs.append(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
                ys.append(b.column("y").to_numpy(zero_copy_only=False))
                n += b.num_rows
                if n >= rows:
                    yield out(np.concatenate(xs), np.concatenate(ys))
                    no, xs, ys, n = no + 1, [], [], 0
        if n:
            yield out(np.concatenate(xs), np.concatenate(ys))
    x = feature_array(df, features_col)
    clean = df.select(x.alias("x"), F.col(label_col).cast("double").alias("y")).filter(
        "x is not null and y is not null and not isnan(y)").filter(~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == math.inf)))
    blocks = materialize(clean.mapInArrow(run, "no long, n int, x binary, y binary"))
    size = blocks.agg(F.sum("n").alias("n"), F.max(F.length("x") / F.col("n")).alias("d"), F.count(F.lit(1)).alias("blocks")).first()
    many = min(size["blocks"], df.sparkSession.sparkContext.defaultParallelism)
    if blocks.rdd.getNumPartitions() < many:           # each pass over the blocks is work for all cores
        blocks = materialize(blocks.repartition(many))
    return blocks, int((size["d"] or 0) / 8), int(size["n"] or 0)


def open_block(batch: pa.RecordBatch, i: int, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    return (batch.column("no")[i].as_py(), np.frombuffer(batch.column("x")[i].as_buffer(), np.float64).reshape(-1, d),
            np.frombuffer(batch.column("y")[i].as_buffer(), np.float64))


def cut_points(df: DataFrame, features_col: str, d: int, bins: int) -> list[np.ndarray]:
    """At most ``bins - 1`` values of each feature, ascending, that splits may cut at."""
    shares = [i / bins for i in range(1, bins)]
    x = feature_array(df, features_col)
    rows = df.select(F.posexplode(x).alias("f", "v")).groupBy("f").agg(
        F.percentile_approx("v", shares, 10_000).alias("q"), F.max("v").alias("top"), F.min("v").alias("low")).collect()
    out = [np.zeros(0)] * d
    for r in rows:                                     # one row a feature
        q = np.unique(np.array([r["low"], *r["q"]], np.float64))
        out[r["f"]] = q[q < r["top"]]
    return out


def add_up(parts: DataFrame, key: str, value: str, n_parts: int, ordered: bool = False, then: Callable | None = None) -> DataFrame:
    """Sums of binary float64 arrays by key, ``FAN_IN`` partial sums a task; ``ordered`` adds them in an order of their own.
    ``then(key, sum)`` makes the array that is kept of a sum."""
    def summed(t: pa.Table) -> np.ndarray:
        out = None
        for v in sorted(t.column(value), key=lambda v: v.as_buffer().to_pybytes()) if ordered else t.column(value):
            a = np.frombuffer(v.as_buffer(), np.float64)
            if out is None:
                out = a.copy()
            else:
                out += a
        return out

    def total(t: pa.Table) -> pa.Table:
        return pa.table({key: t.column(key).slice(0, 1), value: pa.array([summed(t).tobytes()], pa.binary())})

    def kept(t: pa.Table) -> pa.Table:
        return pa.table({key: t.column(key).slice(0, 1), value: pa.array([then(t.column(key)[0].as_py(), summed(t)).tobytes()], pa.binary())})
    kind = parts.schema[key].dataType.simpleString()
    width = -(-n_parts // FAN_IN)
    while width > 1:
        parts = (parts.withColumn("_part", F.pmod(F.xxhash64(value), F.lit(width))).groupBy(key, "_part")
                 .applyInArrow(total, f"{key} {kind}, {value} binary"))
        width = -(-width // FAN_IN)
    return parts.groupBy(key).applyInArrow(kept if then else total, f"{key} {kind}, {value} binary")


def sum_batches(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A task's sums (i, v), ``BATCH_BYTES`` at a time; they leave ``held``."""
    while held:
        ids, values, size = [], [], 0
        while held and size < BATCH_BYTES:
            i, v = held.popitem()
            ids.append(i)
            values.append(v.tobytes())
            size += v.nbytes
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(values, pa.binary())], names=["i", "v"])


def sums_of(parts: DataFrame, n_parts: int, many: int, size: int, then: Callable | None = None) -> list:
    """The sum by number (of ``many``, ``size`` numbers each at most) of partial sums (i, v), or what ``then`` makes of it.
    Beyond ``DRIVER_BYTES`` they are added up in tasks, and only what ``then`` keeps of them comes back."""
    far = n_parts * many * size * 8 > DRIVER_BYTES
    if far:
        parts = add_up(parts, "i", "v", n_parts, then=then)
    out: list = [None] * many
    for r in parts.collect():
        v = np.frombuffer(bytes(r["v"]), np.float64)
        out[r["i"]] = v if out[r["i"]] is None else out[r["i"]] + v
    return out if far or then is None else [None if v is None else then(i, v) for i, v in enumerate(out)]


# ----------------------------------------------------------------------------
# top levels
# ----------------------------------------------------------------------------
class Scan:
    """Passes over the blocks. ``stats_of(no, x, y, extra)`` gives, for a block, a function
    from a tree to the statistics of the block's rows."""

    def __init__(self, blocks: DataFrame, d: int, stats_of: Callable, edges: list[np.ndarray]):
        self.blocks, self.d, self.stats_of, self.edges = blocks, d, stats_of, edges
        self.parts = blocks.rdd.getNumPartitions()

    def by_node(self, trees: dict[int, Flat], wanted: list[tuple[int, int]], per_node: Callable, make: Callable) -> Callable:
        """A map over blocks: ``per_node(i, x, bins, s, value so far)`` for the rows of each wanted node,
        and ``make`` of what a task has at its end."""
        d, edges, stats_of = self.d, self.edges, self.stats_of
        places: dict[int, list[tuple[int, int]]] = {}
        for i, (t, node) in enumerate(wanted):
            places.setdefault(t, []).append((node, i))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, object] = {}
            for batch in batches:
                for b in range(batch.num_rows):
                    no, x, y = open_block(batch, b, d)
                    extra = {c: batch.column(c)[b].as_buffer() for c in batch.schema.names if c not in ("no", "n", "x", "y")}
                    stats = stats_of(no, x, y, extra)
                    bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1) if edges else None
                    for t, nodes in places.items():
                        s = stats(t)
                        counted = np.flatnonzero(np.logical_or.reduce([s[:, j] != 0 for j in range(s.shape[1])]))
                        leaf = trees[t].leaves(x[counted])
                        leaf = leaf.astype(np.uint16) if len(trees[t].feature) <= 1 << 16 else leaf
                        order = np.argsort(leaf, kind="stable")
                        leaf, order = leaf[order], counted[order]
                        spans = np.searchsorted(leaf, [[node, node + 1] for node, _ in nodes])
                        for (node, i), (lo, hi) in zip(nodes, spans):
                            if hi > lo:
                                rows = order[lo:hi]
                                held[i] = per_node(i, x[rows], None if bins is None else bins[rows], s[rows], held.get(i))
                        yield from make(held, False)
            yield from make(held, True)
        return run

    def sums(self, trees: dict[int, Flat], wanted: list[tuple[int, int]], per_node: Callable, size: int, then: Callable | None = None) -> list:
        """Each wanted node's sum of ``per_node(i, x, bins, s)``, an array of ``size`` numbers at most, or what ``then(i, sum)`` makes of it."""
        def one(i, x, bins, s, so_far):
            v = per_node(i, x, bins, s)
            return v if so_far is None else so_far + v

        def make(held, end):
            if end:
                yield from sum_batches(held)
        parts = self.blocks.mapInArrow(self.by_node(trees, wanted, one, make), "i int, v binary")
        return sums_of(parts, self.parts, len(wanted), size, then)

    def ranges(self, trees: dict[int, Flat], wanted: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest value of every feature in each wanted node."""
        def one(i, x, bins, s, so_far):
            v = np.stack([x.min(0), x.max(0)])
            return v if so_far is None else np.stack([np.minimum(v[0], so_far[0]), np.maximum(v[1], so_far[1])])

        def make(held, end):
            if end and held:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), *[pa.array([v[k].tolist() for v in held.values()])
                                                                                      for k in (0, 1)]], names=["i", "low", "high"])
        found = self.blocks.mapInArrow(self.by_node(trees, wanted, one, make), "i int, low array<double>, high array<double>")
        low, high = np.full((len(wanted), self.d), np.nan), np.full((len(wanted), self.d), np.nan)
        for r in found.groupBy("i").agg(F.array(*[F.min(F.col("low")[f]) for f in range(self.d)]).alias("low"),
                                        F.array(*[F.max(F.col("high")[f]) for f in range(self.d)]).alias("high")).collect():
            low[r["i"]], high[r["i"]] = r["low"], r["high"]
        return low, high


def split_level(scan: Scan, trees: dict[int, Tree], wanted: list[tuple[int, int]], rule: Rule) -> list[tuple[int, int]]:
    """Split the wanted (tree, node) pairs by one pass (two for random cuts); returns those without a split.
    The cut is chosen where a node's sums are added up."""
    flats = {t: trees[t].flat() for t in {t for t, _ in wanted}}
    keys = [np.array([trees[t].key[n]], np.int64) for t, n in wanted]
    m, d = len(trees[wanted[0][0]].stats[0]), scan.d
    whole = [trees[t].stats[n] for t, n in wanted]
    if rule.random_cuts:
        low, high = scan.ranges(flats, wanted)
        drawn = np.concatenate([drawn_features(rule, t, key, (high > low)[i:i + 1]) for i, ((t, _), key) in enumerate(zip(wanted, keys))])
        cuts = np.concatenate([drawn_cuts(rule, t, key, low[i:i + 1], high[i:i + 1]) for i, ((t, _), key) in enumerate(zip(wanted, keys))])

        def left_sums(i, x, bins, s):
            return ((x <= cuts[i]).T.astype(np.float64) @ s).ravel()

        def best(i, v):
            left = v.reshape(d, m)
            right = whole[i] - left
            ok = drawn[i] & (rule.weight(left) >= rule.min_leaf) & (rule.weight(right) >= rule.min_leaf)
            score = np.where(ok, rule.quality(left) + rule.quality(right), -np.inf)
            f = int(score.argmax())
            return np.concatenate([[f, cuts[i, f]], left[f], right[f]]) if np.isfinite(score[f]) else np.zeros(0)
        found = scan.sums(flats, wanted, left_sums, d * m, best)
    else:
        edges = scan.edges
        usable = np.array([[len(e) > 0 for e in edges]])
        drawn = np.concatenate([drawn_features(rule, t, key, usable) for (t, _), key in zip(wanted, keys)])
        width = max(len(e) for e in edges) + 1

        def histogram(i, x, bins, s):
            out = np.zeros((d, width, m))
            for f in np.flatnonzero(drawn[i]):
                for j in range(m):
                    out[f, :, j] = np.bincount(bins[:, f], s[:, j], width)
            return out.ravel()

        def best(i, v):
            return _best_cut(whole[i], v.reshape(d, -1, m), rule, edges, drawn[i])
        found = scan.sums(flats, wanted, histogram, d * width * m, best)
    stuck = []
    for (t, node), v in zip(wanted, found):
        if v is None or not len(v):
            stuck.append((t, node))
        else:
            trees[t].split(node, v[0], v[1], v[2:2 + m], v[2 + m:])
    return stuck


# ----------------------------------------------------------------------------
# forests
# ----------------------------------------------------------------------------
def _values_of(rule: Rule) -> Callable:
    """What a leaf says, from its statistics."""
    if rule.kind == "gini":
        return lambda flat: flat.stats / np.maximum(flat.stats.sum(1, keepdims=True), 1e-300)
    return lambda flat: (flat.stats[:, 1] / np.maximum(flat.stats[:, 0], 1e-300))[:, None]


@dataclass
class Forest:
    """Top levels on the driver, subtrees in a checkpointed table (i, tree, node, bytes, arrays)."""

    rule: Rule
    tops: dict[int, Tree]
    pending: list[tuple[int, int]]          # (tree, node) of each subtree, by i
    subtrees: DataFrame | None
    d: int
    width: int                              # statistics a node

    def values(self, flat: Flat) -> np.ndarray:
        """What a leaf says: class shares, or the mean."""
        return _values_of(self.rule)(flat)

    def spans(self) -> list[tuple[int, int]]:
        """Subtrees from one number to before another, ``PORTION_BYTES`` at a time (a larger one by itself)."""
        if self.subtrees is None:
            return [(0, 0)]
        size, lo, spans = 0, 0, []
        for r in self.subtrees.select("i", "bytes").orderBy("i").collect():    # numbers of one row a subtree
            if size and size + r["bytes"] > PORTION_BYTES:
                spans.append((lo, r["i"]))
                lo, size = r["i"], 0
            size += r["bytes"]
        return [*spans, (lo, len(self.pending))]

    def portions(self) -> Iterator[list[tuple[Flat, np.ndarray]]]:
        """The trees with the values of the leaves of a portion (others 0), portion by portion."""
        open_nodes: dict[int, list[int]] = {}
        for t, node in self.pending:
            open_nodes.setdefault(t, []).append(node)
        for n, (lo, hi) in enumerate(self.spans()):
            grafts: dict[int, list] = {}
            if hi > lo:
                for r in self.subtrees.filter((F.col("i") >= lo) & (F.col("i") < hi)).collect():
                    grafts.setdefault(r["tree"], []).append((r["node"], read_flat(r, self.width)))
            out = []
            for t, top in self.tops.items():
                flat = top.flat()
                value = self.values(flat)
                value[open_nodes.get(t, [])] = 0.0
                if n:
                    value[:] = 0.0                     # leaves of the top count once
                    if t not in grafts:
                        continue
                out.append(graft(flat, value, [(node, sub, self.values(sub)) for node, sub in grafts.get(t, [])]))
            yield out

    def first_splits(self) -> list[tuple[int, int, float, float]]:
        """(tree, feature, cut, summed quality of both sides) of the roots that are split."""
        flats = {t: top.flat() for t, top in self.tops.items()}
        rule, width, root = self.rule, self.width, "tree int, feature int, threshold double, score double"

        def split(t: int, flat: Flat) -> list[tuple[int, int, float, float]]:
            if flat.feature[0] < 0:
                return []
            sides = rule.quality(flat.stats[[flat.left[0], flat.right[0]]])
            return [(t, int(flat.feature[0]), float(flat.threshold[0]), float(sides.sum()))]

        def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    r = {c: batch.column(c)[k].as_buffer() for c in ("feature", "threshold", "left", "right", "stats")}
                    for row in split(batch.column("tree")[k].as_py(), read_flat(r, width)):
                        yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int32()), pa.array([row[1]], pa.int32()), pa.array([row[2]]),
                                                          pa.array([row[3]])], names=["tree", "feature", "threshold", "score"])
        below: list[tuple] = []
        if self.subtrees is not None:                                      # one row a tree at most, made where the subtrees are
            below = [tuple(r) for r in self.subtrees.filter("node = 0").mapInArrow(roots, root).collect()]
        grown = {t for t, node in self.pending if node == 0}
        return sorted(below + [row for t, flat in flats.items() if t not in grown for row in split(t, flat)])

    def importances(self) -> np.ndarray:
        """Mean over trees of each feature's share of a tree's gain."""
        gains = {t: top.flat().gains(self.rule, self.d) for t, top in self.tops.items()}
        if self.subtrees is not None:
            total = self.subtrees.groupBy("tree").agg(F.array(*[F.sum(F.col("gains")[f]) for f in range(self.d)]).alias("g"))
            for r in total.collect():                  # one row a tree
                gains[r["tree"]] = gains[r["tree"]] + np.array(r["g"])
        shares = [g / g.sum() for g in gains.values() if g.sum() > 0]
        out = np.mean(shares, 0) if shares else np.zeros(self.d)
        return out / out.sum() if out.sum() > 0 else out


SUBTREE = "i int, tree int, node int, bytes long, feature binary, threshold binary, left binary, right binary, stats binary, gains array<double>"


def read_flat(r, width: int) -> Flat:
    return Flat(np.frombuffer(r["feature"], np.int32), np.frombuffer(r["threshold"], np.float64), np.frombuffer(r["left"], np.int32),
                np.frombuffer(r["right"], np.int32), np.frombuffer(r["stats"], np.float64).reshape(-1, width))


def packed(a: np.ndarray) -> bytes:
    """Numbers in the narrowest of three types that keeps them all, named by the first byte."""
    with np.errstate(over="ignore", invalid="ignore"):
        for code, kind in ((0, np.uint8), (1, np.float32)):
            short = a.astype(kind)
            if np.array_equal(short, a) and not np.signbit(a[a == 0]).any():
                return bytes([code]) + short.tobytes()
    return bytes([2]) + np.ascontiguousarray(a, np.float64).tobytes()


def unpacked(v: pa.Buffer, width: int) -> np.ndarray:
    kind = (np.uint8, np.float32, np.float64)[np.frombuffer(v, np.uint8, 1)[0]]
    return np.frombuffer(v, np.uint8, offset=1).view(kind).astype(np.float64).reshape(-1, width)


def graft(flat: Flat, value: np.ndarray, subs: list[tuple[int, Flat, np.ndarray]]) -> tuple[Flat, np.ndarray]:
    """The tree with subtrees put in the place of leaves."""
    if not subs:
        return flat, value
    offset, parts = len(flat.feature), [flat]
    for _, sub, _ in subs:
        parts.append(replace(sub, left=np.where(sub.left >= 0, sub.left + offset, -1), right=np.where(sub.right >= 0, sub.right + offset, -1)))
        offset += len(sub.feature)
    joined = Flat(*[np.concatenate([getattr(p, c) for p in parts]) for c in ("feature", "threshold", "left", "right")], np.zeros((0, 0)))
    value = np.concatenate([value, *[v for _, _, v in subs]])
    at = len(flat.feature)
    for node, sub, v in subs:
        for column in (joined.feature, joined.threshold, joined.left, joined.right):
            column[node] = column[at]
        value[node] = value[at]
        at += len(sub.feature)
    return joined, value


def class_stats(num_classes: int, bootstrap: bool, seed: int) -> Callable:
    def of_block(no, x, y, extra):
        one_hot = np.eye(num_classes)[y.astype(np.int64)]

        def of_tree(t):
            return one_hot * np.random.default_rng([seed, t, no]).poisson(1.0, len(y))[:, None] if bootstrap else one_hot
        return of_tree
    return of_block


def value_stats(bootstrap: bool, seed: int) -> Callable:
    def of_block(no, x, y, extra):
        moments = np.stack([np.ones(len(y)), y, y * y], 1)

        def of_tree(t):
            return moments * np.random.default_rng([seed, t, no]).poisson(1.0, len(y))[:, None] if bootstrap else moments
        return of_tree
    return of_block


def fit_forest(train: DataFrame, num_classes: int | None, num_trees: int = 200, max_depth: int | None = None,
               max_features: int | str | None = "sqrt", bootstrap: bool = True, random_cuts: bool = False, min_leaf: int = 1,
               bins: int = 64, row_bound: int = ROW_BOUND, seed: int = SEED, features_col: str = "features",
               label_col: str = "label") -> Forest:
    """Trees of any depth; ``num_classes`` None fits values. The driver keeps the top levels, about
    ``num_trees * rows / row_bound`` nodes."""
    blocks, d, n = pack_blocks(train, features_col, label_col)
    if n == 0:
        raise ValueError("no rows to fit")
    few = max(1, int(math.sqrt(d))) if max_features == "sqrt" else max_features
    rule = Rule("gini" if num_classes else "mse", max_depth, min_leaf, few, random_cuts, bins, seed)
    stats_of = class_stats(num_classes, bootstrap, seed) if num_classes else value_stats(bootstrap, seed)
    width = num_classes or 3
    edges = cut_points(train, features_col, d, bins) if n > row_bound and not random_cuts else []
    scan = Scan(blocks, d, stats_of, edges)
    empty = Flat(np.array([-1]), np.zeros(1), np.array([-1]), np.array([-1]), np.zeros((1, width)))
    roots = scan.sums({t: empty for t in range(num_trees)}, [(t, 0) for t in range(num_trees)], lambda i, x, b, s: s.sum(0), width)
    tops = {}
    for t, s in enumerate(roots):
        tops[t] = Tree()
        tops[t].add(np.zeros(width) if s is None else s, 1, 0)
    stuck: set[tuple[int, int]] = set()
    at_once = max(1, HIST_BYTES // (8 * d * width * (1 if random_cuts else bins)))
    while True:
        wide = [(t, i) for t, tree in tops.items() for i, f in enumerate(tree.feature) if f < 0 and (t, i) not in stuck
                and rule.weight(tree.stats[i]) > row_bound and rule.splittable(tree.stats[i][None], tree.depth[i])[0]]
        if not wide:
            break
        for lo in range(0, len(wide), at_once):
            stuck.update(split_level(scan, tops, wide[lo:lo + at_once], rule))
    pending = [(t, i) for t, tree in tops.items() for i, f in enumerate(tree.feature)
               if f < 0 and (t, i) not in stuck and rule.splittable(tree.stats[i][None], tree.depth[i])[0]]
    return Forest(rule, tops, pending, _finish(scan, tops, pending, rule, width) if pending else None, d, width)


def _finish(scan: Scan, tops: dict[int, Tree], pending: list[tuple[int, int]], rule: Rule, width: int) -> DataFrame:
    """Each pending node's subtree, grown in a task that has its rows."""
    d = scan.d
    flats = {t: tops[t].flat() for t in {t for t, _ in pending}}
    info = [(t, node, tops[t].key[node], tops[t].depth[node]) for t, node in pending]

    def one(i, x, bins, s, so_far):
        return [*(so_far or []), (x, s)]

    def make(held, end):
        for i, parts in held.items():
            x, s = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed(x)], pa.binary()), pa.array([packed(s)], pa.binary())],
                                             names=["i", "x", "s"])
        held.clear()

    def finished(t: pa.Table) -> pa.Table:
        i = t.column("i")[0].as_py()
        tree, node, key, depth = info[i]
        # the rows in an order of their own, whatever order the parts came in
        parts = [(unpacked(a.as_buffer(), d), unpacked(b.as_buffer(), width)) for a, b in zip(t.column("x"), t.column("s"))]
        parts.sort(key=lambda p: (p[0].tobytes(), p[1].tobytes()))
        x, s = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        del parts
        flat = grow(x, s, rule, tree, key, depth)
        blobs = [getattr(flat, c).tobytes() for c in ("feature", "threshold", "left", "right", "stats")]
        return pa.table({"i": pa.array([i], pa.int32()), "tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()),
                         "bytes": pa.array([sum(map(len, blobs))], pa.int64()),
                         **{c: pa.array([b], pa.binary()) for c, b in zip(("feature", "threshold", "left", "right", "stats"), blobs)},
                         "gains": pa.array([flat.gains(rule, d).tolist()], pa.list_(pa.float64()))})
    narrow = Scan(scan.blocks, d, scan.stats_of, [])
    rows = narrow.blocks.mapInArrow(narrow.by_node(flats, pending, one, make), "i int, x binary, s binary")
    many = max(1, min(len(pending), max(scan.parts, scan.blocks.sparkSession.sparkContext.defaultParallelism)))
    return materialize(rows.repartition(many, "i").groupBy("i").applyInArrow(finished, SUBTREE))


def predict_forest(forest: Forest, df: DataFrame, features_col: str = "features", out: str = "_votes") -> DataFrame:
    """``df`` with the mean of the trees' leaf values (array; null for rows without features)."""
    spans = forest.spans()
    if len(spans) > 1:
        return _met(forest, df, spans, features_col, out)
    size = forest.width if forest.rule.kind == "gini" else 1
    x = feature_array(df, features_col)
    portion = next(forest.portions())
    return df.withColumn(out, _adder(portion, size, len(forest.tops))(x, F.lit(None).cast("array<double>")))


def _met(forest: Forest, df: DataFrame, spans: list[tuple[int, int]], features_col: str, out: str) -> DataFrame:
    """``predict_forest`` where subtrees and rows meet in tasks. A block of rows goes down the tops; what reaches
    subtrees of a span goes to the task of that span (and of the block's chunk), which sends back sums of leaf values."""
    size, total, d, width = forest.width if forest.rule.kind == "gini" else 1, len(forest.tops), forest.d, forest.width
    starts, leaf_values = np.array([lo for lo, _ in spans]), _values_of(forest.rule)
    number = {at: i for i, at in enumerate(forest.pending)}
    tops = []
    for t, top in forest.tops.items():
        flat = top.flat()
        sub = np.array([number.get((t, node), -1) for node in range(len(flat.feature))], np.int32)
        value = forest.values(flat)
        value[sub >= 0] = 0.0
        tops.append((replace(flat, stats=np.zeros((0, 0))), value, sub))
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    chunks = max(1, math.ceil(rows.count() * min(1.0, total / len(spans)) * 8 * d / CHUNK_BYTES))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(lo, BLOCK_ROWS)
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                votes, at, subs = np.zeros((len(x), size)), [], []
                for flat, value, sub in tops:
                    leaf = flat.leaves(x)
                    votes += value[leaf]
                    i = sub[leaf]
                    at.append(np.flatnonzero(i >= 0).astype(np.int32))
                    subs.append(i[at[-1]])
                at, subs = np.concatenate(at), np.concatenate(subs)
                span = np.searchsorted(starts, subs, "right") - 1
                order = np.argsort(span, kind="stable")
                found, first = np.unique(span[order], return_index=True)
                ends = np.append(first[1:], len(order))
                for k, (p, a, b) in enumerate(zip(found, first, ends) if len(found) else [(0, 0, 0)]):
                    mine = order[a:b]
                    # the block's row numbers and the votes of the tops travel with its first part
                    pos = np.arange(len(x), dtype=np.int32) if k == 0 else np.unique(at[mine])
                    cells = [[int(p)], [(task + seq) % chunks], [(task << 32) + seq],
                             [batch.column("_row").to_numpy().astype(np.int64).tobytes() if k == 0 else b""], [votes.tobytes() if k == 0 else b""],
                             [pos.tobytes()], [packed(x[pos])], [np.searchsorted(pos, at[mine]).astype(np.int32).tobytes()], [subs[mine].tobytes()]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(cells, (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 6))],
                                                     names=["p", "c", "b", "ids", "votes", "pos", "x", "at", "i"])
                seq += 1

    def voted(key, left: pa.Table, right: pa.Table) -> pa.Table:
        trees = {}
        for k in range(right.num_rows):
            flat = read_flat({c: right.column(c)[k].as_buffer() for c in ("feature", "threshold", "left", "right", "stats")}, width)
            trees[right.column("i")[k].as_py()] = flat, leaf_values(flat)
        sums = []
        for k in range(left.num_rows):
            pos, at, i = (np.frombuffer(left.column(c)[k].as_buffer(), np.int32) for c in ("pos", "at", "i"))
            x, votes = unpacked(left.column("x")[k].as_buffer(), d), np.frombuffer(left.column("votes")[k].as_buffer(), np.float64)
            v = votes.reshape(-1, size).copy() if votes.size else np.zeros((len(pos), size))
            order = np.argsort(i, kind="stable")
            found, first = np.unique(i[order], return_index=True)
            for one, a, b in zip(found, first, np.append(first[1:], len(order))):
                flat, value = trees[int(one)]
                v[at[order[a:b]]] += value[flat.leaves(x[at[order[a:b]]])]
            sums.append(v.tobytes())
        return pa.table({"b": left.column("b"), "ids": left.column("ids"), "pos": left.column("pos"), "v": pa.array(sums, pa.binary())})

    def total_of(t: pa.Table) -> pa.Table:
        ids = next(np.frombuffer(v.as_buffer(), np.int64) for v in t.column("ids") if v.as_buffer().size)
        parts = sorted((v.as_buffer().to_pybytes(), w.as_buffer().to_pybytes()) for v, w in zip(t.column("pos"), t.column("v")))
        votes = np.zeros((len(ids), size))
        for pos, v in parts:
            votes[np.frombuffer(pos, np.int32)] += np.frombuffer(v, np.float64).reshape(-1, size)
        offsets = pa.array(np.arange(0, (len(ids) + 1) * size, size, dtype=np.int32))
        return pa.table({"_row": pa.array(ids), out: pa.ListArray.from_arrays(offsets, pa.array((votes / total).ravel()))})

    x = feature_array(df, features_col)
    sent = rows.select("_row", x.alias("x")).where("x is not null").mapInArrow(
        routed, "p int, c int, b long, ids binary, votes binary, pos binary, x binary, at binary, i binary")
    span_of = F.pandas_udf(lambda i: pd.Series(np.searchsorted(starts, i.to_numpy(), "right").astype(np.int32) - 1), "int")
    subtrees = forest.subtrees.drop("gains", "bytes", "tree", "node").withColumn("p", span_of("i")).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    sums = sent.groupBy("p", "c").cogroup(subtrees.groupBy("p", "c")).applyInArrow(voted, "b long, ids binary, pos binary, v binary")
    votes = sums.groupBy("b").applyInArrow(total_of, f"_row long, {out} array<double>")
    return rows.join(materialize(votes), "_row", "left").select(*[rows[c] for c in df.columns], F.col(out))


def _adder(portion: list[tuple[Flat, np.ndarray]], size: int, total: int):
    @F.pandas_udf("array<double>")
    def add(x: pd.Series, so_far: pd.Series) -> pd.Series:
        has = np.flatnonzero(x.notna().to_numpy())
        out: list = [None] * len(x)
        for lo in range(0, len(has), BLOCK_ROWS):
            at = has[lo:lo + BLOCK_ROWS]
            rows = np.stack([np.asarray(v, np.float64) for v in x.iloc[at]])
            votes = np.zeros((len(at), size))
            for flat, value in portion:
                votes += value[flat.leaves(rows)]
            for k, i in enumerate(at):
                before = so_far.iloc[i]
                out[i] = votes[k] / total if before is None else votes[k] / total + np.asarray(before)
        return pd.Series(out, dtype=object)
    return add


# ----------------------------------------------------------------------------
# multinomial boosting
# ----------------------------------------------------------------------------
@dataclass
class Boosted:
    start: list[float]                      # log shares of the classes
    rate: float
    rounds: list[list[Flat]]                # a tree a class; the leaf values are its first statistic
    losses: list[float]                     # mean log-loss before each round

    def importances(self, d: int) -> np.ndarray:
        """Share of each feature in the gain of all splits."""
        total = np.sum([flat.gain for trees in self.rounds for flat in trees], 0) if self.rounds else np.zeros(d)
        return total / total.sum() if total.sum() > 0 else total

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.start)))
        for trees in self.rounds:
            for k, flat in enumerate(trees):
                out[:, k] += self.rate * flat.stats[flat.leaves(x), 0]
        return out


def softmax(f: np.ndarray) -> np.ndarray:
    e = np.exp(f - f.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_boosted(train: DataFrame, num_classes: int, rounds: int = 100, max_depth: int = 3, rate: float = 0.1, bins: int = 64,
                min_leaf: int = 1, features_col: str = "features", label_col: str = "label") -> Boosted:
    """One softmax model of ``num_classes`` trees a round. Splits reduce the squared error of the
    residuals, leaves take a Newton step of the log-loss. Each level of a round is one pass over
    the rows' bins."""
    blocks, d, n = pack_blocks(train, features_col, label_col)
    if n == 0:
        raise ValueError("no rows to fit")
    k, edges = num_classes, cut_points(train, features_col, d, bins)
    counts = np.zeros(k)
    for r in train.groupBy(F.col(label_col).cast("int").alias("y")).count().collect():         # one row a class
        if r["y"] is not None:
            counts[r["y"]] = r["count"]
    start = np.log(np.maximum(counts, 1e-9) / counts.sum())
    rule = Rule("newton", max_depth, min_leaf, None, False, bins)
    model = Boosted(start.tolist(), rate, [], [])
    if n > BLOCK_ROWS and k * math.prod(len(e) + 1 for e in edges) <= CELLS:
        binned = materialize(_cells(blocks, edges, d, start))
        size = binned.agg(F.sum(F.length("y") / 4)).first()[0]
    else:
        binned, size = materialize(blocks.mapInArrow(_binned(edges, d, start), BINNED)), n
    width = max(len(e) for e in edges) + 1
    if size > BLOCK_ROWS:
        source = _Passes(binned, d, width, rate)
        model.rounds, model.losses = _grow_rounds(source, rounds, k, n, d, width, rule, edges)
        return model

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = sorted([(batch.column("at")[i].as_py(), _open_binned(batch, i, d)) for batch in batches for i in range(batch.num_rows)], key=lambda o: o[0])
        rows = [np.concatenate([o[i] for _, o in opened], axis) for i, axis in enumerate((0, 1, 0, 0))]
        found = _grow_rounds(_Rows(*rows, d, width, rate), rounds, k, n, d, width, rule, edges)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["v"])
    # rows of one block at most are one task's work, so other fits can run beside it
    fitted = binned.withColumn("at", F.monotonically_increasing_id()).coalesce(1).mapInArrow(whole, "v binary").first()
    model.rounds, model.losses = pickle.loads(bytes(fitted["v"]))
    return model


class _Rows:
    """Rows in memory with their scores."""

    def __init__(self, y: np.ndarray, b: np.ndarray, f: np.ndarray, w: np.ndarray, d: int, width: int, rate: float):
        self.y, self.b, self.f, self.w, self.d, self.width, self.rate = y, b, f, w, d, width, rate

    def sums(self, flats: list, level: list[list[int]], then: Callable) -> list[np.ndarray]:
        sums = _block_sums(self.y, self.b, self.f, self.w, [], self.rate, flats, _places(flats, level), level, self.d, self.width)
        return [then(i, v) for i, v in enumerate(sums)]

    def add(self, trees: list) -> None:
        self.f = _scored(self.f, self.b, [trees], self.rate)


class _Passes:
    """A table of blocks; every level is a pass."""

    def __init__(self, binned: DataFrame, d: int, width: int, rate: float):
        self.binned, self.parts, self.recent = binned, binned.rdd.getNumPartitions(), []      # trees since the scores were brought up to date
        self.d, self.width, self.rate = d, width, rate

    def sums(self, flats: list, level: list[list[int]], then: Callable) -> list[np.ndarray]:
        if len(self.recent) >= CHECKPOINT_ROUNDS:
            self.binned, self.recent = materialize(self.binned.mapInArrow(_carried(self.recent, self.rate, self.d), BINNED)), []
        return _level_sums(self.binned, self.parts, self.recent, self.rate, flats, level, self.d, self.width, then)

    def add(self, trees: list) -> None:
        self.recent.append(trees)


def _grow_rounds(source: _Rows | _Passes, rounds: int, k: int, n: int, d: int, width: int, rule: Rule,
                 edges: list[np.ndarray]) -> tuple[list[list[Flat]], list[float]]:
    """A tree a class for each round, and the mean log-loss before it."""
    grown, losses = [], []
    for _ in range(rounds):
        trees = [Tree() for _ in range(k)]
        for t in trees:
            t.add(np.array([0.0, 0.0, float(n)]), 1, 0)
        level = [[0] for _ in range(k)]
        while any(level):
            wanted = [(c, node) for c, nodes in enumerate(level) for node in nodes]
            cut_of = _cut_of([None if node == 0 else trees[c].stats[node] for c, node in wanted], d, width, rule, edges)
            found = source.sums([_by_bin(t.flat(), edges) for t in trees], level, cut_of)
            if level == [[0]] * k:
                losses.append(float(found[-1][0]) / n)
            nxt: list[list[int]] = [[] for _ in range(k)]
            for (c, node), v in zip(wanted, found):
                tree = trees[c]
                if node == 0:
                    tree.stats[0] = v[:3]
                if len(v) > 3 and rule.splittable(tree.stats[node][None], tree.depth[node])[0]:
                    nxt[c] += [i for i in tree.split(node, v[3], v[4], v[5:8], v[8:]) if rule.splittable(tree.stats[i][None], tree.depth[i])[0]]
            level = nxt
        done = []
        for tree in trees:
            flat = tree.flat()
            flat.gain = flat.gains(rule, d)
            flat.stats[:, 0] = (k - 1) / k * np.divide(flat.stats[:, 0], flat.stats[:, 1], out=np.zeros(len(flat.stats)), where=flat.stats[:, 1] > 1e-150)
            done.append(flat)
        grown.append(done)
        source.add([_by_bin(flat, edges) for flat in done])
    return grown, losses


BINNED = "y binary, b binary, f binary, w binary"


def _binned(edges: list[np.ndarray], d: int, start: np.ndarray):
    """Blocks of labels, bins and scores from blocks of values."""
    kind = np.uint8 if max(len(e) for e in edges) < 256 else np.int32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, x, y = open_block(batch, i, d)
                b = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]).astype(kind)
                yield _binned_batch(y.astype(np.int32), b, np.tile(start, (len(y), 1)), np.ones(len(y)))
    return run


def _cells(blocks: DataFrame, edges: list[np.ndarray], d: int, start: np.ndarray) -> DataFrame:
    """``_binned`` with the rows of one cell of bins and class as one of that weight: all rounds treat them alike.
    There are ``CELLS`` at most, however many rows."""
    shape = [len(e) + 1 for e in edges]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, x, y = open_block(batch, i, d)
                at = np.ravel_multi_index((y.astype(np.int64), *[np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]), (len(start), *shape))
                cell, n = np.unique(at, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint8 if max(shape) <= 256 else np.int32
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(lo, BLOCK_ROWS)
                y, *b = np.unravel_index(batch.column("cell").to_numpy(), (len(start), *shape))
                yield _binned_batch(y.astype(np.int32), np.stack(b).astype(kind), np.tile(start, (len(y), 1)), batch.column("n").to_numpy().astype(np.float64))
    return blocks.mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).mapInArrow(opened, BINNED)


def _binned_batch(y: np.ndarray, b: np.ndarray, f: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (y, b, f, w)], names=["y", "b", "f", "w"])


def _open_binned(batch: pa.RecordBatch, i: int, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    y, b, f, w = (batch.column(c)[i].as_buffer() for c in ("y", "b", "f", "w"))
    y = np.frombuffer(y, np.int32)
    return (y, np.frombuffer(b, np.uint8 if b.size == len(y) * d else np.int32).reshape(d, -1), np.frombuffer(f, np.float64).reshape(len(y), -1),
            np.frombuffer(w, np.float64))


def _by_bin(flat: Flat, edges: list[np.ndarray]) -> tuple[Flat, int]:
    """A tree that compares bins (leaves point to themselves), and its depth."""
    leaf = flat.feature < 0
    own = np.arange(len(leaf), dtype=np.int32)
    cut = np.array([0 if f < 0 else np.searchsorted(edges[f], t) for f, t in zip(flat.feature, flat.threshold)], np.int32)
    left, right = np.where(leaf, own, flat.left), np.where(leaf, own, flat.right)
    depth, at = 0, np.array([0])
    while not leaf[at].all():
        depth, at = depth + 1, np.unique(np.concatenate([left[at], right[at]]))
    return Flat(np.maximum(flat.feature, 0), cut, left, right, flat.stats), depth


def _leaves_by_bin(tree: tuple[Flat, int], b: np.ndarray) -> np.ndarray:
    flat, depth = tree
    rows, node = np.arange(b.shape[1]), np.zeros(b.shape[1], np.int32)
    for _ in range(depth):
        node = np.where(b[flat.feature[node], rows] <= flat.threshold[node], flat.left[node], flat.right[node])
    return node


def _scored(f: np.ndarray, b: np.ndarray, recent: list, rate: float) -> np.ndarray:
    out = f.copy()
    for trees in recent:
        for c, tree in enumerate(trees):
            out[:, c] += rate * tree[0].stats[_leaves_by_bin(tree, b), 0]
    return out


def _carried(recent: list, rate: float, d: int):
    """Scores brought up to date."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                y, b, f, w = _open_binned(batch, i, d)
                yield _binned_batch(y, b, _scored(f, b, recent, rate), w)
    return run


def _places(flats: list, level: list[list[int]]) -> list[np.ndarray]:
    """The place in the level of each tree's nodes (-1: not in it)."""
    places = []
    for (flat, _), nodes in zip(flats, level):
        place = np.full(len(flat.feature), -1)
        place[nodes] = np.arange(len(nodes))
        places.append(place)
    return places


def _block_sums(y, b, f, w, recent: list, rate: float, flats: list, places: list, level: list[list[int]], d: int, width: int) -> list[np.ndarray]:
    """Sums of residual, curvature and count by (statistic, feature, bin) for each node of each class, and the log-loss, of a block."""
    p = softmax(_scored(f, b, recent, rate))
    found = []
    for c, (tree, place, nodes) in enumerate(zip(flats, places, level)):
        if not nodes:
            continue
        at = place[_leaves_by_bin(tree, b)]
        keep = slice(None) if (at >= 0).all() else np.flatnonzero(at >= 0)
        at, pc = at[keep] * width, p[keep, c]
        mass, alike = w[keep], (w == 1).all()
        r, h = mass * ((y[keep] == c) - pc), mass * (pc * (1 - pc))
        out = np.empty((len(nodes), 3, d, width))
        for g in range(d):
            cell = at + b[g][keep]
            for j, v in enumerate((r, h, None if alike else mass)):
                out[:, j, g] = np.bincount(cell, v, len(nodes) * width).reshape(len(nodes), width)
        found += list(out.reshape(len(nodes), -1))
    return [*found, np.array([-(w * np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))).sum()])]


def _cut_of(whole: list, d: int, width: int, rule: Rule, edges: list[np.ndarray]) -> Callable:
    """What is kept of a node's sums: its statistics, then its best cut if there is one. The last sum is the log-loss."""
    def kept(i, v):
        if i == len(whole):
            return v
        hist = v.reshape(3, d, width).transpose(1, 2, 0)
        stats = hist[0].sum(0) if whole[i] is None else whole[i]
        return np.concatenate([stats, _best_cut(stats, hist, rule, edges)])
    return kept


def _level_sums(binned: DataFrame, parts: int, recent: list, rate: float, flats: list, level: list[list[int]], d: int, width: int,
                then: Callable) -> list[np.ndarray]:
    """``then`` of the ``_block_sums`` of all blocks."""
    places, many = _places(flats, level), sum(map(len, level)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                for j, v in enumerate(_block_sums(*_open_binned(batch, i, d), recent, rate, flats, places, level, d, width)):
                    held[j] = held[j] + v if j in held else v
        yield from sum_batches(held)
    return sums_of(binned.mapInArrow(run, "i int, v binary"), parts, many, d * width * 3, then)


def _best_cut(whole: np.ndarray, hist: np.ndarray, rule: Rule, edges: list[np.ndarray], drawn: np.ndarray | None = None) -> np.ndarray:
    """(feature, cut, statistics of both sides) of the best split of a node by its sums (feature, bin, statistic); empty: none."""
    left = np.cumsum(hist.transpose(2, 0, 1), 2)[:, :, :-1].transpose(1, 2, 0)     # a statistic's sums lie together
    right = whole - left
    inside = np.arange(left.shape[1])[None, :] < np.array([len(e) for e in edges])[:, None]
    if drawn is not None:
        inside &= drawn[:, None]
    ok = inside & (rule.weight(left) >= rule.min_leaf) & (rule.weight(right) >= rule.min_leaf)
    score = np.where(ok, rule.quality(left) + rule.quality(right), -np.inf)
    if not score.size or not np.isfinite(score.max()):
        return np.zeros(0)
    f, b = np.unravel_index(int(score.argmax()), score.shape)
    return np.concatenate([[f, edges[f][b]], left[f, b], right[f, b]])


def predict_boosted(model: Boosted, df: DataFrame, features_col: str = "features", out: str = "_shares") -> DataFrame:
    """``df`` with the class probabilities (array; null for rows without features)."""
    @F.pandas_udf("array<double>")
    def shares(x: pd.Series) -> pd.Series:
        has = np.flatnonzero(x.notna().to_numpy())
        found: list = [None] * len(x)
        for lo in range(0, len(has), BLOCK_ROWS):
            at = has[lo:lo + BLOCK_ROWS]
            p = softmax(np.array(model.start) + model.scores(np.stack([np.asarray(v, np.float64) for v in x.iloc[at]])))
            for i, row in zip(at, p):
                found[i] = row
        return pd.Series(found, dtype=object)
    return df.withColumn(out, shares(feature_array(df, features_col)))


# ----------------------------------------------------------------------------
# saving
# ----------------------------------------------------------------------------
NODES = "tree int, round int, node int, feature int, threshold double, left int, right int, stats array<double>, key long, depth int"


def save_trees(model: Forest | Boosted, path: str) -> None:
    """Nodes as a table, subtrees as another, the rest as one row of JSON."""
    import json

    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    rows: list[tuple] = []
    if isinstance(model, Forest):
        meta = {"kind": "forest", "rule": vars(model.rule), "pending": model.pending, "d": model.d, "width": model.width}
        for t, top in model.tops.items():
            rows += [(t, 0, i, top.feature[i], top.threshold[i], top.left[i], top.right[i], [float(v) for v in top.stats[i]], top.key[i], top.depth[i])
                     for i in range(len(top.feature))]
        if model.subtrees is not None:
            model.subtrees.write.mode("overwrite").parquet(f"{path}/subtrees")
    else:
        meta = {"kind": "boosted", "start": model.start, "rate": model.rate, "losses": model.losses,
                "gains": [[flat.gain.tolist() for flat in trees] for trees in model.rounds]}
        for r, trees in enumerate(model.rounds):
            for t, flat in enumerate(trees):
                rows += [(t, r, i, int(flat.feature[i]), float(flat.threshold[i]), int(flat.left[i]), int(flat.right[i]), flat.stats[i].tolist(), 0, 0)
                         for i in range(len(flat.feature))]
    spark.createDataFrame(rows, NODES).write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").parquet(f"{path}/meta")


def load_trees(spark, path: str) -> Forest | Boosted:
    import json
    meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
    by_tree: dict[tuple[int, int], list] = {}
    for r in spark.read.parquet(f"{path}/nodes").collect():
        by_tree.setdefault((r["round"], r["tree"]), []).append(r)
    built = {}
    for where, nodes in by_tree.items():
        nodes.sort(key=lambda r: r["node"])
        built[where] = Tree(*[[r[c] for r in nodes] for c in ("feature", "threshold", "left", "right")],
                            [np.array(r["stats"]) for r in nodes], [r["key"] for r in nodes], [r["depth"] for r in nodes])
    if meta["kind"] == "forest":
        pending = [tuple(p) for p in meta["pending"]]
        return Forest(Rule(**meta["rule"]), {t: built[0, t] for _, t in sorted(built)}, pending,
                      spark.read.parquet(f"{path}/subtrees") if pending else None, meta["d"], meta["width"])
    rounds = [[built[r, t].flat() for t in range(len(meta["start"]))] for r in range(len(meta["losses"]))]
    for trees, gains in zip(rounds, meta["gains"]):
        for flat, g in zip(trees, gains):
            flat.gain = np.array(g)
    return Boosted(meta["start"], meta["rate"], rounds, meta["losses"])
