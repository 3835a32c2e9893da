"""Registered queries: one per operator, each with its SQL oracle when one exists.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables; its
oracle is ANSI/DuckDB SQL over the same tables (registered as views). Computed
floating-point columns are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6, cols: list[str] | None = None) -> DataFrame:
    """Round double/float columns (all, or ``cols``) to ``digits`` places."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (cols is None or f.name in cols):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def r6(expr: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def load_all() -> None:
    """Import every module that registers queries."""
    from . import queries_base  # noqa: F401
    from . import queries_features  # noqa: F401
    from . import queries_stats  # noqa: F401
    from . import queries_eval  # noqa: F401
    from . import queries_ml  # noqa: F401
