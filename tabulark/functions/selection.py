"""Exact order statistics on distributed data.

``percentile`` in Spark is exact but keeps a value -> count map of the whole
column inside one aggregation buffer, which does not survive a near-unique
double column at cluster scale. Here an exact order statistic is found by
narrowing a bracket instead:

1. a bracket ``[lo, hi]`` that probably holds the wanted rank (from
   ``percentile_approx`` or from [min, max]),
2. one aggregation pass that counts rows below the bracket and histograms the
   bracket into ``BUCKETS`` equal-width buckets (count, min, max per bucket),
   which locates the wanted rank exactly and shrinks the bracket,
3. once a bracket holds at most ``FINAL_ROWS`` rows, one ranking pass over
   only those rows (``row_number`` partitioned by target) picks the value.

A bracket of equal values resolves at once, so a value that fills a third of
the column costs nothing extra. Every pass is a partial (map-side) aggregation
whose output is bounded by ``targets x (BUCKETS + 2)`` rows; no task ever holds
more than ``FINAL_ROWS`` values of one target, and nothing but bucket summaries
reaches the driver. Values are handled as doubles, so long values must stay
below 2**53 in magnitude.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 4096
FINAL_ROWS = 200_000
MAX_TARGETS = 200_000
MAX_PASSES = 64


@dataclass
class _Target:
    group: tuple
    col: int
    rank: int            # 0-based rank among the non-null values of the group
    lo: float | None = None
    hi: float | None = None
    below: int | None = None   # rows with value < lo (exact once a pass ran)
    count: int | None = None   # rows inside [lo, hi]
    value: float | None = None
    done: bool = False
    value_below: int | None = None  # rows strictly below ``value``


def _value_expr(value_cols: list[str]) -> F.Column:
    if len(value_cols) == 1:
        return F.col(value_cols[0]).cast("double")
    arr = F.array(*[F.col(c).cast("double") for c in value_cols])
    return F.element_at(arr, F.col("_ci") + 1)


def _attach_probes(df: DataFrame, by: list[str], value_cols: list[str],
                   probes: dict[int, tuple], final: bool) -> DataFrame:
    """Rows of ``df`` paired with each open probe ``(group, col, lo, hi)`` of their group."""
    spark = df.sparkSession
    if len(probes) > MAX_TARGETS:
        raise ValueError(f"too many selection targets ({len(probes)} > {MAX_TARGETS})")
    uniq = list(dict.fromkeys([*by, *value_cols]))
    base = df.select(*uniq)
    if by:
        group_fields = [df.schema[c] for c in by]
        schema = T.StructType(
            [T.StructField(f"_g{i}", f.dataType, True) for i, f in enumerate(group_fields)]
            + [T.StructField("_tid", T.IntegerType(), False),
               T.StructField("_ci", T.IntegerType(), False),
               T.StructField("_lo", T.DoubleType(), True),
               T.StructField("_hi", T.DoubleType(), True)])
        rows = [tuple(g) + (pid, ci, lo, hi) for pid, (g, ci, lo, hi) in probes.items()]
        # bounded by MAX_TARGETS rows: safe to broadcast
        tdf = F.broadcast(spark.createDataFrame(rows, schema))
        cond = None
        for i, c in enumerate(by):
            e = base[c].eqNullSafe(tdf[f"_g{i}"])
            cond = e if cond is None else cond & e
        joined = base.join(tdf, cond, "inner")
    else:
        # no grouping: a handful of probes, fanned out with an array literal
        # instead of a keyless join
        tstructs = [F.struct(F.lit(pid).alias("_tid"), F.lit(ci).alias("_ci"),
                             F.lit(lo).cast("double").alias("_lo"),
                             F.lit(hi).cast("double").alias("_hi"))
                    for pid, (_, ci, lo, hi) in probes.items()]
        vals = list(dict.fromkeys(value_cols))
        if final:                         # most rows are in no bracket: they are not fanned out
            base = base.where(reduce(or_, [_inside(F.col(value_cols[ci]).cast("double"), lo, hi)
                                           for _, ci, lo, hi in probes.values()]))
        joined = base.select(*vals, F.explode(F.array(*tstructs)).alias("_t")).select(
            *vals, "_t._tid", "_t._ci", "_t._lo", "_t._hi")
    v = _value_expr(value_cols)
    out = joined.select("_tid", "_lo", "_hi", v.alias("_v")).where(F.col("_v").isNotNull())
    if final:
        out = out.where(
            (F.col("_lo").isNull() | (F.col("_v") >= F.col("_lo")))
            & (F.col("_hi").isNull() | (F.col("_v") <= F.col("_hi"))))
    return out


def _inside(v: F.Column, lo: float | None, hi: float | None) -> F.Column:
    inside = v.isNotNull()
    if lo is not None:
        inside = inside & (v >= F.lit(lo))
    return inside if hi is None else inside & (v <= F.lit(hi))


def _probes_of(targets: dict[int, _Target]):
    probes, members = {}, defaultdict(list)
    index = {}
    for tid, t in targets.items():
        key = (t.group, t.col, t.lo, t.hi)
        if key not in index:
            index[key] = len(probes)
            probes[index[key]] = key
        members[index[key]].append(t)
    return probes, members


def _count_pass(df, value_cols, targets):
    """Without groups, one plain aggregate places the targets whose bracket holds their rank; the others are returned."""
    probes, members = _probes_of({tid: t for tid, t in targets.items() if t.below is None and t.lo is not None and t.hi is not None})
    if not probes:
        return targets
    aggs = []
    for pid, (_, ci, lo, hi) in probes.items():
        v = F.col(value_cols[ci]).cast("double")
        aggs += [F.count_if(v < F.lit(lo)).alias(f"b{pid}"), F.count_if(_inside(v, lo, hi)).alias(f"i{pid}")]
    row = df.agg(*aggs).first()
    for pid, ts in members.items():
        below, inside = row[f"b{pid}"], row[f"i{pid}"]
        for t in ts:
            if below <= t.rank < below + inside:
                t.below, t.count = below, inside
                if t.lo == t.hi:
                    t.value, t.done, t.value_below = t.lo, True, below
    return {tid: t for tid, t in targets.items() if not t.done and (t.count is None or t.count > FINAL_ROWS)}


def _refine_pass(df, by, value_cols, targets):
    if not by:
        targets = _count_pass(df, value_cols, targets)
        placed = {tid: t for tid, t in targets.items() if t.below is not None}
        targets = {tid: t for tid, t in targets.items() if t.below is None}
        if placed:
            _bucket_pass(df, by, value_cols, placed, True)
    if targets:
        _bucket_pass(df, by, value_cols, targets, False)


def _bucket_pass(df, by, value_cols, targets, placed):
    """Buckets of the brackets; with ``placed`` targets only rows inside the brackets are read, as those below are counted."""
    probes, members = _probes_of(targets)
    rows = _attach_probes(df, by, value_cols, probes, final=placed)
    lo, hi, v = F.col("_lo"), F.col("_hi"), F.col("_v")
    width = hi - lo
    bucket = (
        F.when(lo.isNotNull() & (v < lo), F.lit(-1))
        .when(hi.isNotNull() & (v > hi), F.lit(BUCKETS))
        .when(lo.isNull() | hi.isNull() | (width <= 0), F.lit(0))
        .otherwise(F.least(F.floor((v - lo) / width * BUCKETS).cast("int"), F.lit(BUCKETS - 1)))
    )
    summary = (rows.groupBy("_tid", bucket.alias("_b"))
               .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("mn"), F.max(v).alias("mx"))
               .collect())
    per = defaultdict(list)
    for r in summary:
        per[r["_tid"]].append((r["_b"], r["n"], r["mn"], r["mx"]))
    for pid, ts in members.items():
        buckets = sorted(per.get(pid, []))
        for t in ts:
            cum = t.below if placed else 0
            chosen = None
            for b, n, mn, mx in buckets:
                if cum + n > t.rank:
                    chosen = (n, mn, mx)
                    break
                cum += n
            if chosen is None:
                raise ValueError(f"rank {t.rank} out of range for {t.group}/{t.col}")
            n, mn, mx = chosen
            t.below, t.count, t.lo, t.hi = cum, n, mn, mx
            if mn == mx:
                # a bucket of one value: everything before it is strictly smaller
                t.value, t.done, t.value_below = mn, True, cum


def _final_pass(df, by, value_cols, targets):
    probes, members = _probes_of(targets)
    rows = _attach_probes(df, by, value_cols, probes, final=True)
    w = Window.partitionBy("_tid").orderBy("_v")
    want = sorted({(pid, t.rank - t.below + 1) for pid, ts in members.items() for t in ts})
    spark = df.sparkSession
    want_df = F.broadcast(spark.createDataFrame(want, "_tid int, _rn int"))
    ranked = rows.select("_tid", "_v", F.row_number().over(w).alias("_rn"))
    # first position of each value inside the bracket: rows strictly below it
    first = ranked.withColumn("_first", F.min("_rn").over(Window.partitionBy("_tid", "_v")))
    picked = first.join(want_df, ["_tid", "_rn"], "inner").collect()
    got = {(r["_tid"], r["_rn"]): (r["_v"], r["_first"]) for r in picked}
    for pid, ts in members.items():
        for t in ts:
            key = (pid, t.rank - t.below + 1)
            if key not in got:
                raise RuntimeError(f"selection lost rank {t.rank} of {t.group}/{t.col}")
            v, first_rn = got[key]
            t.value, t.done = v, True
            t.value_below = t.below + first_rn - 1


def order_statistics(df: DataFrame, value_cols: list[str], wanted: dict,
                     by: list[str] | None = None, brackets: dict | None = None,
                     sizes: dict | None = None, with_below: bool = False) -> dict:
    """Exact values at 0-based ranks.

    ``wanted`` maps ``(group_tuple, col_index)`` to an iterable of ranks among the
    non-null values of ``value_cols[col_index]`` within the group; ``brackets``
    optionally maps the same keys to a ``(lo, hi)`` guess (checked, never trusted);
    ``sizes`` optionally gives the exact non-null count per key, which lets small
    groups go straight to the ranking pass. Returns ``{(group, col_index, rank): value}``,
    or ``(value, rows strictly below value)`` pairs with ``with_below``.
    """
    by = list(by or [])
    brackets = brackets or {}
    sizes = sizes or {}
    targets: dict[int, _Target] = {}
    for (group, ci), ranks in wanted.items():
        lo, hi = brackets.get((group, ci), (None, None))
        n = sizes.get((group, ci))
        for r in sorted(set(int(x) for x in ranks)):
            t = _Target(tuple(group), ci, r, lo, hi)
            if n is not None and n <= FINAL_ROWS:
                t.lo, t.hi, t.below, t.count = None, None, 0, n
            targets[len(targets)] = t
    for _ in range(MAX_PASSES):
        open_t = {tid: t for tid, t in targets.items() if not t.done}
        if not open_t:
            break
        ready = {tid: t for tid, t in open_t.items()
                 if t.count is not None and t.count <= FINAL_ROWS}
        if ready:
            _final_pass(df, by, value_cols, ready)
        rest = {tid: t for tid, t in open_t.items() if tid not in ready}
        if rest:
            _refine_pass(df, by, value_cols, rest)
    else:
        raise RuntimeError("order statistics did not converge")
    if with_below:
        return {(t.group, t.col, t.rank): (t.value, t.value_below) for t in targets.values()}
    return {(t.group, t.col, t.rank): t.value for t in targets.values()}


def quantiles(df: DataFrame, cols: list[str], probs: list[float],
              by: list[str] | None = None, accuracy: int = 100_000,
              exact: bool = True) -> dict:
    """Linear-interpolated quantiles (pandas ``quantile``, DuckDB ``quantile_cont``).

    Returns ``{group_tuple: {col: [q(p) for p in probs]}}`` (the group tuple is
    ``()`` without ``by``); a column with no non-null values gives ``None``s.
    ``exact=False`` returns ``percentile_approx`` values from the single pass.
    """
    by = list(by or [])
    probs = [float(p) for p in probs]
    if not cols:
        return {}
    delta = 4.0 / accuracy

    def clamp(x):
        return min(1.0, max(0.0, x))

    edges = sorted({clamp(p + s * delta) for p in probs for s in (-1, 1)}) if exact else probs
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs.append(F.count(x).alias(f"n{i}"))
        aggs.append(F.percentile_approx(x, F.array(*[F.lit(e) for e in edges]), accuracy)
                    .alias(f"a{i}"))
    stats = df.groupBy(*by).agg(*aggs).collect() if by else [df.agg(*aggs).first()]
    out: dict = {}
    wanted, brackets, plan = {}, {}, []
    for row in stats:
        group = tuple(row[c] for c in by)
        out[group] = {}
        for i, c in enumerate(cols):
            n = row[f"n{i}"]
            if not n:
                out[group][c] = [None] * len(probs)
                continue
            approx = [float(a) for a in row[f"a{i}"]]
            if not exact:
                out[group][c] = approx
                continue
            at = dict(zip(edges, approx))
            out[group][c] = [None] * len(probs)
            for j, p in enumerate(probs):
                pos = p * (n - 1)
                k = int(math.floor(pos))
                key = (group, i * len(probs) + j)
                wanted[key] = {k, min(k + 1, n - 1)}
                brackets[key] = (at[clamp(p - delta)], at[clamp(p + delta)])
                plan.append((group, c, key, j, pos, k, n))
    if not wanted:
        return out
    # target (column i, probability j) reads value column i * len(probs) + j
    value_cols = [c for c in cols for _ in probs]
    sizes = {key: n for (_g, _c, key, _j, _p, _k, n) in plan}
    vals = order_statistics(df, value_cols, wanted, by=by, brackets=brackets, sizes=sizes)
    for group, c, key, j, pos, k, n in plan:
        frac = pos - k
        a = vals[(group, key[1], k)]
        b = vals[(group, key[1], min(k + 1, n - 1))]
        out[group][c][j] = float(a if frac == 0 or a == b else a + (b - a) * frac)
    return out


def global_quantiles(df: DataFrame, cols: list[str], probs: list[float], **kw) -> dict:
    """``{col: [q(p) for p in probs]}`` over the whole frame."""
    res = quantiles(df, cols, probs, by=None, **kw)
    return res.get((), {c: [None] * len(probs) for c in cols})
