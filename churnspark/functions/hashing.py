"""Deterministic pseudo-random draws from row keys.

A draw depends only on ``seed`` and the row's key, never on partitioning or
row order, so any cluster (and any SQL engine with md5) reproduces it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def hash_key(seed: int | str, *parts) -> Column:
    """md5 hex of ``seed:part1:part2...``; parts are columns or literals."""
    cols = [F.lit(str(seed))]
    for p in parts:
        cols.append(p.cast("string") if isinstance(p, Column) else F.lit(str(p)))
    return F.md5(F.concat_ws(":", *cols))


def uniform(seed: int | str, *parts) -> Column:
    """U[0, 1) from the first 32 bits of ``hash_key``."""
    h = hash_key(seed, *parts)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def uniform_sql(seed: int | str, *parts: str) -> str:
    """DuckDB twin of :func:`uniform` (parts are SQL expressions)."""
    inner = " || ':' || ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"(CAST(('0x' || substr(md5({inner}), 1, 8)) AS UBIGINT) / 4294967296.0)"


def hash_sql(seed: int | str, *parts: str) -> str:
    inner = " || ':' || ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"md5({inner})"
