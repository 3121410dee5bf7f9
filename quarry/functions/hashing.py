"""Portable hashing: the same bucket in Spark and in any SQL engine with md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(c, n: int) -> Column:
    """``int(first 8 hex digits of md5(string(c)), 16) % n`` as a bigint in [0, n)."""
    col = F.col(c) if isinstance(c, str) else c
    h = F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n).cast("bigint"))


def hash_bucket_sql(expr: str, n: int) -> str:
    """The DuckDB/ANSI twin of :func:`hash_bucket` for oracle queries."""
    return f"((('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT) % {n})"


def hash_fraction(c, seed: int, below: float) -> Column:
    """Whether the 32-bit hash of ``seed:value`` lies below the share ``below`` of its range."""
    return seeded_hash(c, seed) < F.lit(round(below * (1 << 32)))


def seeded_hash(c, seed: int) -> Column:
    """First 32 bits of md5("seed:value") as a bigint (a null value hashes as empty text)."""
    col = F.col(c) if isinstance(c, str) else c
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def seeded_hash_sql(expr: str, seed: int) -> str:
    """The DuckDB/ANSI twin of :func:`seeded_hash`."""
    return f"(('0x' || substr(md5('{seed}:' || coalesce(CAST({expr} AS VARCHAR), '')), 1, 8))::BIGINT)"
