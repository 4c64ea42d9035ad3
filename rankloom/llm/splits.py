"""Joins that are split by key only where counts show that a key is too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators import skew


def split_keys(counts: DataFrame, key: str, count: str, rows: int | None = None) -> DataFrame | None:
    """``(key, splits)`` of the keys with more than ``rows`` rows (``skew.HOT_ROWS`` if not given), or None without any."""
    rows = skew.HOT_ROWS if rows is None else rows
    if counts.where(F.col(count) > rows).isEmpty():
        return None
    return skew.hot_keys(counts, key, count, rows)


def split_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None, spread: list[str]) -> DataFrame:
    """Inner join on ``key``; rows of ``left`` with a hot key are dealt by the hash of ``spread``."""
    return left.join(right, key) if hot is None else skew.salted_join(left, right, key, hot, spread)
