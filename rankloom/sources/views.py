"""A store of page views per month: one folder per month, late views merged into theirs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.durable import Scratch
from rankloom.schemas import VIEW_COUNTS
from rankloom.sources.artifacts import load_or_empty


def add_views(spark: SparkSession, path: str, views: DataFrame, page_id: str = "id", at: str = "ts") -> list[str]:
    """Add the rows of ``views`` to the store and return the months ``yyyy-mm`` that changed.

    Only the folders of these months are read and replaced. The new counts are complete before the first
    folder is replaced, and Spark's writer moves them in at the end of its job. Views without a time or an id are left out.
    """
    month = F.date_format(at, "yyyy-MM")
    with Scratch(spark) as scratch:
        added = (
            views.where(F.col(at).isNotNull() & F.col(page_id).isNotNull())
            .groupBy(F.col(page_id).cast("long").alias("id"), month.alias("month"))
            .agg(F.count("*").alias("value"))
        )
        added = scratch.table(added, "added-views")
        # A row per month of the new views.
        months = sorted(row.month for row in added.select("month").distinct().collect())
        if not months:
            return []
        stored = load_or_empty(spark, path, VIEW_COUNTS).where(F.col("month").isin(months))
        merged = stored.unionByName(added.select("id", "value", "month")).groupBy("month", "id").agg(F.sum("value").alias("value"))
        merged = scratch.table(merged.select("id", "value", "month"), "merged-views")
        ordered = merged.repartitionByRange("month", "id").sortWithinPartitions("month", "id")
        ordered.write.option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path, mode="overwrite")
    return months


def month_views(spark: SparkSession, path: str, month: str) -> DataFrame:
    """``(id, value)``: views per page in a month ``yyyy-mm``; the scan reads that month's folder only."""
    return load_or_empty(spark, path, VIEW_COUNTS).where(F.col("month") == month).select("id", "value")
