"""Row sampling: random, class-balanced, most-recent, fixed-size.

All sampling is "the first n rows in a total order": a seeded row hash for
random draws, the date (then the hash) for recent rows, always ending with the
row keys, so the result is deterministic and independent of partitioning.
The first n rows are found without sorting the data: exact order statistics
(``functions.selection``) give, per group, the order value of row n, and a
single lexicographic filter keeps everything up to it; only rows tied with that
value on every level (a handful) are ranked by a window, to find the key of
the last row taken.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import MODULUS, row_hash
from ..functions.selection import order_statistics

MAX_GROUPS = 100_000
PIECE = 8192                    # equal rows written out by one row of a job
SLICES = 4096                   # of a hash's range, by which rows are counted


def _attach(df: DataFrame, small: DataFrame, by: list[str]) -> DataFrame:
    """Left-join a small per-group table (bounded by MAX_GROUPS rows, broadcast)."""
    if not by:
        row = small.first()
        return df.select("*", *[F.lit(row[c] if row else None).cast(small.schema[c].dataType).alias(c)
                                for c in small.columns])
    renamed = small
    for c in by:
        renamed = renamed.withColumnRenamed(c, f"_k_{c}")
    cond = None
    for c in by:
        e = df[c].eqNullSafe(renamed[f"_k_{c}"])
        cond = e if cond is None else cond & e
    return df.join(F.broadcast(renamed), cond, "left").drop(*[f"_k_{c}" for c in by])


def first_n(df: DataFrame, levels: list[Column], n: int | dict, tie_keys: list[str],
            by: list[str] | None = None, flag: str = "_first", spread: int | None = None) -> DataFrame:
    """``df`` with a boolean ``flag``: is the row among the first ``n`` of its group
    in ascending ``levels`` order, ties broken by ``tie_keys``.

    ``n`` is an int (same for every group) or ``{group_tuple: n}``. The rule is a
    per-group lexicographic threshold on (levels, tie_keys), found with exact
    order statistics; rows are never sorted or gathered.
    Rows with a null level are never selected.

    ``spread`` says that the first level is a hash within [0, ``spread``). Without groups one
    pass then counts rows by slices of that range, and only rows up to the slice of row ``n``
    are held and read by the later passes; the input as a whole is neither held nor read again."""
    by = list(by or [])
    spark = df.sparkSession
    lv = [f"_o{i}" for i in range(len(levels))]
    work = df.select("*", *[e.cast("double").alias(name) for e, name in zip(levels, lv)])
    # the fit passes read only (group, levels, keys): persist that narrow projection
    # once instead of recomputing the input (a join, say) for every pass
    valid = work.select(*by, *lv, *[k for k in tie_keys if k not in by])
    for name in lv:
        valid = valid.where(F.col(name).isNotNull())
    near, bracket = None, None
    if spread and not by:
        valid, counts, near, bracket = _sliced(valid, lv[0], spread, n.get((), 0) if isinstance(n, dict) else n)
    valid = valid.persist(StorageLevel.MEMORY_AND_DISK)
    if near is None:
        counts = valid.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).limit(MAX_GROUPS + 1).collect()
    if len(counts) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} sampling groups")
    want = {}
    for r in counts:
        g = tuple(r[c] for c in by)
        k = n.get(g, 0) if isinstance(n, dict) else n
        want[g] = (min(int(k or 0), r["_n"]), r["_n"])
    partial = {g: k for g, (k, total) in want.items() if 0 < k < total}
    whole = {g for g, (k, total) in want.items() if k > 0 and k >= total}
    thresholds = {g: [] for g in partial}
    need = dict(partial)
    sizes = {(g, 0): total if near is None else near for g, (k, total) in want.items() if g in partial}
    for i, name in enumerate(lv):
        if not partial:
            break
        sub = _restrict(valid, by, partial, thresholds, lv[:i], spark)
        vals = order_statistics(sub, [name], {(g, 0): [need[g] - 1] for g in partial}, by=by,
                                brackets={((), 0): bracket} if bracket and i == 0 else None,
                                sizes=sizes if i == 0 else None, with_below=True)
        for g in partial:
            value, below = vals[(g, 0, need[g] - 1)]
            thresholds[g].append(value)
            need[g] -= below
    key_thr, dup_need, cut = {}, {}, False       # cut: some copies of the last key stay out
    if partial:
        # rows tied with the thresholds on every level: distinct keys with one hash, so
        # few, whatever the number of their copies; the last key taken may be cut
        tied = _restrict(valid, by, partial, thresholds, lv, spark)
        per = {}
        for r in tied.groupBy(*by, *tie_keys).agg(F.count(F.lit(1)).alias("_c")).collect():
            per.setdefault(tuple(r[c] for c in by), []).append(([r[k] for k in tie_keys], r["_c"]))
        for g in partial:
            left = need[g]
            for key, copies in sorted(per[g], key=lambda x: [(v is not None, v) for v in x[0]]):
                key_thr[g], dup_need[g], cut = key, left, cut or left < copies
                if left <= copies:
                    break
                left -= copies
    valid.unpersist()
    fields = ([work.schema[c] for c in by]
              + [T.StructField("_all", T.BooleanType()), T.StructField("_m", T.LongType())]
              + [T.StructField(f"_t{i}", T.DoubleType()) for i in range(len(lv))]
              + [T.StructField(f"_tk{j}", work.schema[k].dataType) for j, k in enumerate(tie_keys)])
    rows = [tuple(g) + (True, None) + (None,) * (len(lv) + len(tie_keys)) for g in whole]
    rows += [tuple(g) + (False, dup_need[g]) + tuple(thresholds[g]) + tuple(key_thr[g]) for g in partial]
    thr = spark.createDataFrame(rows, T.StructType(fields))
    joined = _attach(work, thr, by)
    cols = lv + list(tie_keys)
    tcols = [f"_t{i}" for i in range(len(lv))] + [f"_tk{j}" for j in range(len(tie_keys))]
    valid_row = None
    for name in lv:
        e = F.col(name).isNotNull()
        valid_row = e if valid_row is None else valid_row & e
    # structs compare field by field, nulls first; a level (a long hash, say) is then one expression of the filter
    row, last = (F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(names)]) for names in (cols, tcols))
    if not cut:                                   # one pass decides every row
        return joined.select(*df.columns, (F.coalesce(F.col("_all") | (row <= last), F.lit(False)) & valid_row).alias(flag))
    full_eq = F.coalesce(~F.col("_all") & (row == last) & valid_row, F.lit(False))
    strict = F.coalesce(F.col("_all") | (row < last), F.lit(False)) & valid_row
    # every row but those with the last key: decided by the strict rule
    main = joined.where(~full_eq).select(*df.columns, strict.alias(flag))
    copies = joined.where(full_eq).select(*df.columns)
    if tie_keys:
        content = F.xxhash64(*[F.to_json(F.col(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema.fields])
        halves = [F.shiftrightunsigned(content, 32), content.bitwiseAND(F.lit(0xFFFFFFFF))]
        return main.unionByName(first_n(copies, halves, dup_need, [], by, flag))
    return main.unionByName(_first_equal(copies, dup_need, by, flag))


def _sliced(valid: DataFrame, level: str, spread: int, k: int | None):
    """The rows up to the slice of ``level`` that holds row ``k``, the count of all rows (as a row
    without groups), the number of rows up to that slice and its edges."""
    part = F.floor(F.col(level) * F.lit(SLICES / spread))
    slices = sorted(tuple(r) for r in valid.groupBy(part.alias("_s")).agg(F.count(F.lit(1)).alias("_n")).collect())
    total, k = sum(m for _, m in slices), int(k or 0)
    if not 0 < k < total:                              # no row or all rows: nothing is left to read
        return valid.limit(0), [{"_n": total}], 0, None
    upto = 0
    for s, m in slices:
        upto += m
        if upto >= k:
            break
    width = spread / SLICES
    return valid.where(part <= F.lit(s)), [{"_n": total}], upto, (s * width - 1, (s + 1) * width + 1)


def _first_equal(rows: DataFrame, need: dict, by: list[str], flag: str) -> DataFrame:
    """Flag ``need`` rows of each group's equal rows (different ones only if their hashes collide)."""
    numbers = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_c"))
    fields = [rows.schema[c] for c in by] + [T.StructField("_m", T.LongType())]
    numbers = _attach(numbers, rows.sparkSession.createDataFrame([tuple(g) + (m,) for g, m in need.items()], T.StructType(fields)), by)
    order = Window.partitionBy(*by).orderBy(*[c for c in rows.columns]).rowsBetween(Window.unboundedPreceding, -1)
    numbers = numbers.withColumn("_m", F.col("_m") - F.coalesce(F.sum("_c").over(order), F.lit(0)))
    pieces = numbers.withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_c") - 1) / PIECE))))
    spread = pieces.repartition(*[F.col(c) for c in ("_p", *by)])
    each = F.sequence(F.col("_p") * PIECE, F.least((F.col("_p") + 1) * PIECE, F.col("_c")) - 1)
    return spread.withColumn("_i", F.explode(each)).select(*rows.columns, (F.col("_i") < F.col("_m")).alias(flag))


def take_first(df: DataFrame, levels: list[Column], n: int | dict, tie_keys: list[str],
               by: list[str] | None = None, spread: int | None = None) -> DataFrame:
    """The first ``n`` rows (per group) of ``first_n``, as a filter on one scan."""
    return first_n(df, levels, n, tie_keys, by, "_first", spread).where(F.col("_first")).drop("_first")


def _thr_frame(work, by, groups, thresholds, names, spark):
    fields = [work.schema[c] for c in by] + [T.StructField(f"_t{i}", T.DoubleType())
                                              for i in range(len(names))]
    rows = [tuple(g) + tuple(thresholds[g][:len(names)]) for g in groups]
    return spark.createDataFrame(rows, T.StructType(fields))


def _restrict(work, by, groups, thresholds, names, spark, strict_last=False):
    """Rows of the listed groups equal to the thresholds on ``names``
    (strictly below on the last one when ``strict_last``)."""
    if by:
        thr = _thr_frame(work, by, groups, thresholds, names, spark)
        renamed = thr
        for c in by:
            renamed = renamed.withColumnRenamed(c, f"_k_{c}")
        cond = None
        for c in by:
            e = work[c].eqNullSafe(renamed[f"_k_{c}"])
            cond = e if cond is None else cond & e
        out = work.join(F.broadcast(renamed), cond, "inner").drop(*[f"_k_{c}" for c in by])
    else:
        out = work.select("*", *[F.lit(thresholds[()][i]).alias(f"_t{i}")
                                 for i in range(len(names))])
    for i, name in enumerate(names):
        last = i == len(names) - 1
        if strict_last and last:
            out = out.where(F.col(name) < F.col(f"_t{i}"))
        else:
            out = out.where(F.col(name) == F.col(f"_t{i}"))
    return out.drop(*[f"_t{i}" for i in range(len(names))])


def random_sample(df: DataFrame, n: int | None, keys: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows drawn uniformly by a seeded hash of ``keys``; ``n`` null/0 -> all rows."""
    if not n:
        return df
    return take_first(df, [row_hash(keys, seed)], int(n), keys, spread=MODULUS)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, the null class kept as its own group."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def balanced_sample(df: DataFrame, label: str, n: int | None, keys: list[str],
                    seed: int = 42, class_source: DataFrame | None = None) -> DataFrame:
    """``n // number_of_classes`` random rows per class.

    The classes are counted on ``class_source`` (the outcome table, as in the
    reference; default ``df``), the null class included in the divisor. The null
    class never matches an equality filter, so it contributes no rows.
    """
    if not n:
        return df
    src = class_source if class_source is not None else df
    classes = [r[0] for r in src.select(label).distinct().limit(MAX_GROUPS + 1).collect()]
    if len(classes) > MAX_GROUPS:
        raise ValueError("too many classes for balanced sampling")
    per = int(n) // max(1, len(classes))
    quota = {(c,): per for c in classes if c is not None}
    return take_first(df.where(F.col(label).isNotNull()), [row_hash(keys, seed)], quota,
                      keys, by=[label])


def recent_sample(df: DataFrame, date_col: str, n: int | None, keys: list[str],
                  seed: int = 42) -> DataFrame:
    """The ``n`` rows with the latest ``date_col`` (ties by the seeded hash, then keys)."""
    c = F.col(date_col)
    dt = df.schema[date_col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        num = F.unix_micros(c.cast("timestamp"))
    elif isinstance(dt, T.DateType):
        num = F.unix_date(c)
    else:
        num = c
    if not n:
        return df
    return take_first(df.where(c.isNotNull()), [-num, row_hash(keys, seed)], int(n), keys)


def sample_rows(df: DataFrame, keys: list[str], n: int = 10_000, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows for quick exploration."""
    return take_first(df, [row_hash(keys, seed)], int(n), keys, spread=MODULUS)


def load_strategy(df: DataFrame, strategy: str, n: int | None, keys: list[str], label: str,
                  date_col: str, seed: int = 42, class_source: DataFrame | None = None) -> DataFrame:
    """``balanced`` / ``recent`` / anything else -> random."""
    if strategy == "balanced":
        return balanced_sample(df, label, n, keys, seed, class_source)
    if strategy == "recent":
        return recent_sample(df, date_col, n, keys, seed)
    return random_sample(df, n, keys, seed)
