"""Reading the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus(spark: SparkSession, *paths: str) -> DataFrame:
    """All Parquet files under the paths or globs; files of any other kind are skipped."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(*paths)


def texts(corpus: DataFrame) -> DataFrame:
    """``(doc_id, text)``: the only columns the scan reads."""
    return corpus.select(F.col("id").alias("doc_id"), "text")


def titles(corpus: DataFrame) -> DataFrame:
    """``(doc_id, title)`` of the pages that have a title."""
    return corpus.select(F.col("id").alias("doc_id"), "title").where("title is not null")


def links(corpus: DataFrame) -> DataFrame:
    """``(id, anchor_text)``: the only columns the scan reads."""
    return corpus.select("id", "anchor_text")


def page_count(corpus: DataFrame) -> DataFrame:
    """``(pages)``: one row; Parquet answers it from file footers."""
    return corpus.agg(F.count("*").alias("pages"))


# Bytes of files up to which a scan is small.
SMALL_SCAN_BYTES = 1 << 30


def spread_small(scan: DataFrame) -> DataFrame:
    """Spread a file scan of bounded size that has fewer splits than the cluster has cores.

    Costly work on it, like tokenizing, would leave cores idle: a file of one row group is read by
    one task. A scan above ``SMALL_SCAN_BYTES`` is left alone however many cores there are.
    """
    size = int(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = scan.sparkSession.sparkContext.defaultParallelism
    small = size <= SMALL_SCAN_BYTES and scan.rdd.getNumPartitions() < cores
    return scan.repartition(cores) if small else scan
