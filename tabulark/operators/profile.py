"""Profiling: nulls, duplicates, constant columns, quality score.

The whole profile of a frame comes from ONE shuffle: the frame is grouped on all
of its columns (a partial aggregation, so copies of a row collapse map-side even
when one row value holds a third of the data), and every statistic is read off
the distinct rows weighted by their multiplicity: rows, distinct rows, nulls per
column, non-null count, min and max per column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATOMIC = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
          T.TimestampNTZType, T.BinaryType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def numeric_columns(df: DataFrame, exclude: tuple = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


@dataclass
class Profile:
    rows: int
    distinct_rows: int
    nulls: dict = field(default_factory=dict)
    non_null: dict = field(default_factory=dict)
    constant: dict = field(default_factory=dict)   # <= 1 distinct non-null value

    @property
    def duplicates(self) -> int:
        return self.rows - self.distinct_rows

    @property
    def total_nulls(self) -> int:
        return sum(self.nulls.values())

    @property
    def columns(self) -> list[str]:
        return list(self.nulls)

    def quality_score(self) -> float | None:
        """C17: (0.7 * completeness + 0.3 * distinct/rows) * 100; None on empty input."""
        cells = self.rows * len(self.nulls)
        if self.rows == 0 or cells == 0:
            return None
        completeness = (cells - self.total_nulls) / cells
        uniqueness = self.distinct_rows / self.rows
        return (completeness * 0.7 + uniqueness * 0.3) * 100


def _nan_to_null(df: DataFrame) -> DataFrame:
    """Spark keeps NaN as a value; the reference treats it as missing."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def profile(df: DataFrame) -> Profile:
    """One job: rows, distinct rows, per-column nulls / non-nulls / constancy."""
    df = _nan_to_null(df)
    cols = df.columns
    if not cols:
        n = df.count()
        return Profile(n, min(n, 1))
    grouped = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__cnt"))
    cnt = F.col("__cnt")
    aggs = [F.sum(cnt).alias("__rows"), F.count(F.lit(1)).alias("__distinct")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        aggs.append(F.sum(F.when(c.isNull(), cnt).otherwise(0)).alias(f"n{i}"))
        if isinstance(f.dataType, ATOMIC):
            aggs.append((F.min(c) == F.max(c)).alias(f"k{i}"))
        else:
            aggs.append(F.lit(False).alias(f"k{i}"))
    row = grouped.agg(*aggs).first()
    rows = int(row["__rows"] or 0)
    p = Profile(rows, int(row["__distinct"] or 0))
    for i, c in enumerate(cols):
        nn = int(row[f"n{i}"] or 0)
        p.nulls[c] = nn
        p.non_null[c] = rows - nn
        # all-null counts as constant (pandas nunique() == 0)
        p.constant[c] = (rows - nn == 0) or bool(row[f"k{i}"])
    return p


def column_profile(df: DataFrame) -> Profile:
    """Nulls and constancy per column from one plain aggregate (no shuffle of rows);
    copies are not counted (``distinct_rows`` 0)."""
    work = _nan_to_null(df)
    cols = work.columns
    row = work.agg(F.count(F.lit(1)).alias("__rows"), *[a for i, c in enumerate(cols) for a in (
        F.count_if(F.col(c).isNull()).alias(f"n{i}"),
        (F.min(F.col(c)) == F.max(F.col(c)) if isinstance(work.schema[c].dataType, ATOMIC) else F.lit(False)).alias(f"k{i}"))]).first()
    rows = int(row["__rows"])
    p = Profile(rows, 0)
    for i, c in enumerate(cols):
        nn = int(row[f"n{i}"] or 0)
        p.nulls[c], p.non_null[c] = nn, rows - nn
        p.constant[c] = (rows - nn == 0) or bool(row[f"k{i}"])
    return p


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count, null_fraction) for every column; one aggregation."""
    df = _nan_to_null(df)
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    stacked = one.select(
        "__rows",
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
                            for i, c in enumerate(cols)])).alias("s"))
    return stacked.select(
        "s.column_name",
        F.col("s.null_count").cast("bigint").alias("null_count"),
        F.when(F.col("__rows") > 0, F.col("s.null_count") / F.col("__rows")).alias("null_fraction"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row (rows, distinct_rows, duplicates); exact, grouped on all columns."""
    grouped = _nan_to_null(df).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__cnt"))
    return grouped.agg(
        F.coalesce(F.sum("__cnt"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
    ).select("rows", "distinct_rows", (F.col("rows") - F.col("distinct_rows")).alias("duplicates"))


def all_null_columns(p: Profile) -> list[str]:
    return [c for c in p.columns if p.nulls[c] == p.rows]


def constant_columns(p: Profile, keep: tuple = ("final_result",)) -> list[str]:
    return [c for c in p.columns if p.constant[c] and c not in keep]


def columns_to_drop(p: Profile, advanced: bool = True, keep: tuple = ("final_result",)) -> list[str]:
    """C3 + C4 in the reference's order, each column listed once."""
    out = all_null_columns(p)
    if advanced:
        out += [c for c in constant_columns(p, keep) if c not in out]
    return out


def drop_all_null_columns(df: DataFrame, p: Profile | None = None) -> DataFrame:
    """C3."""
    p = p or column_profile(df)
    return df.drop(*all_null_columns(p))


def drop_constant_columns(df: DataFrame, keep: tuple = ("final_result",),
                          p: Profile | None = None) -> DataFrame:
    """C4: drop columns with <= 1 distinct non-null value, except ``keep``."""
    p = p or column_profile(df)
    return df.drop(*constant_columns(p, keep))


def changed_counts(df: DataFrame, pairs: dict) -> dict:
    """Cells changed per column, ``pairs`` maps name -> (old expr, new expr).

    A null replaced by 0 counts as changed (NaN != 0 in the reference)."""
    if not pairs:
        return {}
    row = df.agg(*[F.count_if(~old.eqNullSafe(new)).alias(f"c{i}")
                   for i, (old, new) in enumerate(pairs.values())]).first()
    return {name: int(row[f"c{i}"]) for i, name in enumerate(pairs)}


def quality_score(df: DataFrame) -> DataFrame:
    """C17 as a one-row frame (rows, cells, null_cells, distinct_rows, quality_score),
    computed by the same single group-on-all-columns shuffle."""
    df = _nan_to_null(df)
    cols = df.columns
    row_nulls = sum((F.col(c).isNull().cast("bigint") for c in cols), F.lit(0).cast("bigint"))
    grouped = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__cnt"),
                                    F.first(row_nulls).alias("__rn"))
    rows = F.coalesce(F.sum("__cnt"), F.lit(0)).cast("bigint")
    out = grouped.agg(rows.alias("rows"),
                      F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
                      F.coalesce(F.sum(F.col("__cnt") * F.col("__rn")), F.lit(0)).cast("bigint")
                      .alias("null_cells"))
    cells = F.col("rows") * F.lit(len(cols))
    score = F.when(cells > 0, ((cells - F.col("null_cells")) / cells * 0.7
                               + F.col("distinct_rows") / F.col("rows") * 0.3) * 100)
    return out.select("rows", cells.cast("bigint").alias("cells"), "null_cells", "distinct_rows",
                      score.alias("quality_score"))
