"""Saving and loading what the jobs compute."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.text import term_bucket
from rankloom.operators.graph import highest_first
from rankloom.operators.index import NUM_BUCKETS, longest_first, with_bucket
from rankloom.operators.skew import hot_keys, least_that_fits


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Gzip CSV without header. An ordered table keeps its order across the part files."""
    df.write.csv(
        path,
        mode=mode,
        compression="gzip",
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def save_lengths(lengths: DataFrame, path: str) -> None:
    """Document lengths, longest first, replacing what was there."""
    save_csv(longest_first(lengths), path)


def save_titles(titles: DataFrame, path: str) -> None:
    """Titles, replacing what was there."""
    save_csv(titles, path)


def save_pagerank(ranks: DataFrame, path: str) -> None:
    """PageRank, highest first; fails if the path exists."""
    save_csv(highest_first(ranks), path, mode="errorifexists")


def load_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back a table of :func:`save_csv`."""
    return spark.read.csv(path, schema=schema, escape='"', multiLine=True)


#: Least postings of a part of a bucket, where the statistics deal the postings to tasks.
PART_ROWS = 250_000

#: Postings of a term from which its bucket is looked up, not computed for each posting.
KNOWN_ROWS = 64


def save_postings(
    postings: DataFrame,
    path: str,
    buckets: int = NUM_BUCKETS,
    mode: str = "overwrite",
    term_stats: DataFrame | None = None,
    part_rows: int = PART_ROWS,
) -> None:
    """Postings in one folder per bucket of terms, sorted by term, block if there is one, and document.

    Ranges over bucket, term and document give tasks of even size: a term with very many postings
    is cut into several ranges, and a file covers few terms, so its statistics skip it for others. Ranges
    need a pass over all postings to find them; ``term_stats (term, df)`` saves it, see :func:`_dealt`.
    """
    rows = postings
    if "bucket" not in rows.columns:
        rows = with_bucket(rows, buckets) if term_stats is None else _looked_up(rows, term_stats, buckets)
    order = ["bucket", "term", *(["block"] if "block" in rows.columns else []), "doc_id"]
    columns = rows.columns
    rows = rows.repartitionByRange(*order) if term_stats is None else _dealt(rows, term_stats, buckets, part_rows)
    rows.sortWithinPartitions(*order).select(*columns).write.partitionBy("bucket").parquet(path, mode=mode)


def _looked_up(postings: DataFrame, term_stats: DataFrame, buckets: int, least: int = KNOWN_ROWS) -> DataFrame:
    """Postings with the bucket of their term, which the statistics bring for the terms that most postings have."""
    stats = term_stats if "bucket" in term_stats.columns else with_bucket(term_stats, buckets)
    fitting = least_that_fits(stats.select("term", "df").where(F.col("df") >= least), "df")
    if fitting is None:
        return with_bucket(postings, buckets)
    known = stats.where(F.col("df") >= max(least, fitting)).select("term", F.col("bucket").alias("known"))
    bucket = F.coalesce("known", term_bucket(F.col("term"), buckets))
    return postings.join(F.broadcast(known), "term", "left").withColumn("bucket", bucket).drop("known")


def _dealt(rows: DataFrame, term_stats: DataFrame, buckets: int, part_rows: int) -> DataFrame:
    """Postings dealt to tasks by parts of buckets, several to a task.

    A term lies in one part of its bucket; one with more than ``part_rows`` postings has parts of its own, by block or document.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = term_stats.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("total")).first().total
    part_rows = max(part_rows, total // (4 * tasks))
    parts = max(1, -(-total // (buckets * part_rows)))
    hot = hot_keys(term_stats, "term", "df", part_rows)
    of_hot = F.xxhash64("term", F.pmod(F.xxhash64("block" if "block" in rows.columns else "doc_id"), "splits"))
    part = F.when(F.col("splits").isNull(), F.pmod(F.xxhash64("term"), F.lit(parts))).otherwise(of_hot)
    return rows.join(F.broadcast(hot), "term", "left").withColumn("part", part).repartition("bucket", "part")


def load_if_saved(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A saved Parquet table, or None when the path does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A saved Parquet table, or an empty one when the path does not exist."""
    found = load_if_saved(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found
