"""Portable row hash: depends on the key only, never on partitioning or engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2**32


def hash32_sql(key: str, seed: int | None = None) -> str:
    """SQL text of the first 32 bits of the md5 of the key (and seed) as a bigint in [0, 2^32)."""
    text = f"string({key})" if seed is None else f"concat(string({key}), '|{seed}')"
    return f"bigint(conv(substring(md5({text}), 1, 8), 16, 10))"


def hash32(key: str, seed: int | None = None) -> Column:
    return F.expr(hash32_sql(key, seed))


def hash_fraction(key: str, seed: int) -> Column:
    """Uniform value in [0, 1) per key."""
    return hash32(key, seed) / F.lit(float(HASH_RANGE))
