"""A seeded row hash that Spark and any ANSI SQL engine compute identically.

Sampling must be repeatable and independent of partitioning, and the result
must be checkable against a SQL oracle, so the hash is plain 64-bit integer
arithmetic modulo the prime 2**31 - 1 (every intermediate stays below 2**63).
The quadratic step makes it non-linear in the key. Keys must be integral; a null
key counts as a fixed number, so rows without a key have a hash like others.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (modulus and multipliers of the mixing steps).
MODULUS = 2147483647
MIX_A = 48271
MIX_B = 69621
NULL_KEY = 1099511627


def hash_sql(keys: list[str], seed: int = 42) -> str:
    """SQL text of the hash of integral ``keys`` (same text runs in Spark and DuckDB)."""
    p = MODULUS
    h = f"CAST({int(seed) % p} AS BIGINT)"
    for k in keys:
        x = f"((COALESCE(CAST({k} AS BIGINT), {NULL_KEY}) % {p}) + {p}) % {p}"
        h = f"(({h}) * 31 + {x}) % {p}"
        h = f"(({h}) * {MIX_A} + 11) % {p}"
        h = f"(({h}) * ({h}) + 7) % {p}"
    return f"((({h}) * {MIX_B} + 13) % {p})"


def row_hash(keys: list[str], seed: int = 42) -> Column:
    """The hash as a Spark column (BIGINT in [0, 2**31 - 1))."""
    return F.expr(hash_sql(keys, seed))
