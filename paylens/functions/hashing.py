"""Portable, reproducible hash splits (same value in any SQL engine with md5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash32(key: Column) -> Column:
    """First 32 bits of md5(key as text), as a non-negative bigint."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def holdout_flag(key: Column, buckets: int = 5) -> Column:
    """Deterministic 1/buckets holdout membership."""
    return (stable_hash32(key) % buckets) == 0
