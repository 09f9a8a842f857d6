"""Seeded, partition-independent random draws.

A sequential RNG stream cannot be split across tasks, and ``rand(seed)``
depends on how rows fall into partitions. Instead every draw is a hash of
``(seed, row key, axis)``: the same row gets the same number on one core or
a thousand, in any order, and DuckDB computes the identical value with
``('0x' || substr(md5(seed || ':' || id || ':' || axis), 1, 8))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296


def u32(seed: int | Column, key: str | Column, axis: str) -> Column:
    """Uniform integer in [0, 2^32) for this (seed, key, axis)."""
    seed_c = seed if isinstance(seed, Column) else F.lit(str(seed))
    key_c = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat_ws(":", seed_c.cast("string"), key_c.cast("string"), F.lit(axis)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def pick(seed, key, axis: str, k: int | Column) -> Column:
    """Uniform index in [0, k)."""
    kk = k if isinstance(k, Column) else F.lit(k)
    return F.pmod(u32(seed, key, axis), kk.cast("bigint"))


def below(seed, key, axis: str, p: float | Column) -> Column:
    """Bernoulli(p): true with probability p."""
    pc = p if isinstance(p, Column) else F.lit(float(p))
    return u32(seed, key, axis) < (pc * F.lit(TWO_32))


def sql_u32(seed: int | str, key_sql: str, axis: str) -> str:
    """The same draw as DuckDB SQL (used by the oracle)."""
    return f"(('0x' || substr(md5('{seed}' || ':' || CAST({key_sql} AS VARCHAR) || ':' || '{axis}'), 1, 8))::BIGINT)"
