"""Joins and cuts that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that one part of a key may have: keys above it are split into parts of this size.
HOT_ROWS = 5_000_000

# Hot keys there may be, so that their table can be broadcast.
HOT_KEYS = 500_000

# A side is broadcast only when it was counted and has at most this many rows and bytes of strings.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 100_000_000


def _measures(df: DataFrame) -> list[Column]:
    """Rows and bytes of strings; partial sums leave one row per task."""
    strings = [F.octet_length(f.name) for f in df.schema if f.dataType.simpleString() == "string"]
    length = sum((F.coalesce(s, F.lit(0)).cast("long") for s in strings), F.lit(0).cast("long"))
    return [F.count("*").alias("rows"), F.coalesce(F.sum(length), F.lit(0)).alias("bytes")]


def _fits(measured) -> bool:
    return measured.rows <= BROADCAST_ROWS and measured.bytes <= BROADCAST_BYTES


def fits_broadcast(df: DataFrame) -> bool:
    """Count all of ``df`` and tell whether it is within the broadcast bounds."""
    return _fits(df.agg(*_measures(df)).first())


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint where it was counted and is within the bounds."""
    return F.broadcast(df) if fits_broadcast(df) else df


def least_that_fits(counts: DataFrame, count: str) -> int | None:
    """The least bound on ``count`` for which the rows at or above it are within the broadcast bounds.

    1 where all rows are, otherwise a power of two, and None where not even the largest ones fit.
    """
    power = F.length(F.bin(count)) - 1
    sizes = counts.where(F.col(count) > 0).groupBy(power.alias("power")).agg(*_measures(counts)).collect()
    rows, length, least = 0, 0, None
    for size in sorted(sizes, key=lambda s: -s.power):
        rows, length = rows + size.rows, length + size.bytes
        if rows > BROADCAST_ROWS or length > BROADCAST_BYTES:
            return least
        least = 1 << size.power
    return 1


def batch_size(query_term_rows: DataFrame) -> tuple[bool, int]:
    """Whether the query terms fit a broadcast, and how many distinct terms there are."""
    size = query_term_rows.agg(*_measures(query_term_rows)).first()
    return _fits(size), query_term_rows.select("term").distinct().count()


def hot_keys(counts: DataFrame, key: str, count: str, min_rows: int | None = None) -> DataFrame:
    """``(key, splits)`` for the keys with more rows than one part may have, from rows per key.

    The size of a part is absolute, whatever the share of the key. Only where more than
    ``HOT_KEYS`` keys could be hot are the smallest of them left whole, so the table of hot keys always
    has a bounded number of rows.
    """
    target = max(HOT_ROWS if min_rows is None else min_rows, 1)
    over = counts.where(F.col(count) > target).select(key, F.col(count).alias("hot_rows"))
    # Counting once tells whether there are too many; as a rule there are hardly any.
    sizes = counts.agg(F.sum(count).alias("total"), F.count_if(F.col(count) > target).alias("over")).first()
    if not sizes.over:
        # A plan that is known to be empty, so the join with it goes away.
        return over.where(F.lit(False)).select(key, F.col("hot_rows").cast("int").alias("splits"))
    least = max((sizes.total or 0) / HOT_KEYS, target)
    return over.where(F.col("hot_rows") > least).withColumnRenamed("hot_rows", count).select(key, F.ceil(F.col(count) / target).cast("int").alias("splits"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot: DataFrame,
    spread: list[str],
    how: str = "inner",
) -> DataFrame:
    """Equi-join on ``key`` where the hot keys of ``left`` are split over several tasks.

    Each left row of a hot key takes one part by the hash of its ``spread`` columns; the right
    rows of that key are repeated once per part. All other keys have a single part.
    """
    hot = F.broadcast(hot)
    parts = F.coalesce(F.col("splits"), F.lit(1))
    left = left.join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64(*spread), parts).cast("int"))
    right = right.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.drop("splits").join(right.drop("splits"), [key, "salt"], how).drop("salt")


def top_k(df: DataFrame, group: str, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    The filter on ``row_number`` becomes a group limit before the shuffle: each task sends at most
    ``k`` rows per group, so a hot group does not reach one task whole.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
