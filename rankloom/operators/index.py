"""Index operators: postings, statistics, lengths, access and growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import term_bucket
from rankloom.operators.skew import fits_broadcast, hot_keys, salted_join

# Rare-term cut, number of buckets, document ids per posting-list block.
MIN_DF = 50
NUM_BUCKETS = 124
BLOCK_IDS = 333_333


def term_statistics(facts: DataFrame) -> DataFrame:
    """``(term, df, term_total)``; partial sums leave one row per term and task to shuffle."""
    return facts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("term_total"))


def frequent_terms(term_stats: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """Statistics of the terms found in more than ``min_df`` documents."""
    return term_stats.where(F.col("df") > min_df)


def keep_frequent(
    facts: DataFrame,
    term_stats: DataFrame,
    min_df: int = MIN_DF,
    buckets: int = NUM_BUCKETS,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """Facts of frequent terms only, with the ``bucket`` of their term.

    A vocabulary that was counted and is small goes to the facts. A larger one is joined by shuffle:
    the document frequencies already tell which terms are hot, so their rows are split without
    another counting pass. The bucket is computed once per term, not per fact.
    """
    frequent = frequent_terms(term_stats, min_df)
    if "bucket" not in term_stats.columns:
        frequent = with_bucket(frequent, buckets)
    vocabulary = frequent.select("term", "bucket")
    if fits_broadcast(vocabulary):
        return facts.join(F.broadcast(vocabulary), "term")
    return salted_join(facts, vocabulary, "term", hot_keys(frequent, "term", "df", min_hot_rows), ["doc_id"])


def above_cut(postings: DataFrame, frequent: DataFrame) -> DataFrame:
    """Stored postings, which have their bucket, of the terms in ``frequent``.

    No hint and no count, as the table may never be read; the optimizer broadcasts a small vocabulary.
    """
    return postings.join(frequent.select("term"), "term", "left_semi").select(*postings.columns)


def posting_lists(postings: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``(term, block, postings array<struct<doc_id, tf>>)``: posting lists in blocks.

    A block covers ``block_ids`` consecutive document ids, so no array outgrows that bound however
    frequent the term is; the blocks of a term in order are its list sorted by document.
    """
    return (
        postings.groupBy("term", F.floor(F.col("doc_id") / block_ids).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))
    )


def postings_of(postings: DataFrame, term: str, buckets: int | None = None) -> DataFrame:
    """``(doc_id, tf)`` of one term sorted by document; an unknown term has none.

    Both conditions reach the scan: the bucket prunes folders, the term prunes row groups.
    """
    rows = postings.where(F.col("term") == term)
    if buckets and "bucket" in postings.columns:
        rows = rows.where(F.col("bucket") == term_bucket(F.lit(term), buckets))
    return rows.select("doc_id", "tf").orderBy("doc_id", "tf")


def with_bucket(rows: DataFrame, buckets: int = NUM_BUCKETS) -> DataFrame:
    """Add the bucket of each term."""
    return rows.withColumn("bucket", term_bucket(F.col("term"), buckets))


def bucket_sizes(term_stats: DataFrame, buckets: int = NUM_BUCKETS) -> DataFrame:
    """``(bucket, terms, postings)``: load of each bucket."""
    return (
        with_bucket(term_stats, buckets)
        .groupBy("bucket")
        .agg(F.count("*").alias("terms"), F.sum("df").alias("postings"))
    )


def doc_lengths(facts: DataFrame) -> DataFrame:
    """``(doc_id, dl)``: kept tokens of each document, rare terms included."""
    return facts.groupBy("doc_id").agg(F.sum("tf").alias("dl"))


def longest_first(lengths: DataFrame) -> DataFrame:
    """Lengths in descending order, by a range shuffle over all tasks."""
    return lengths.orderBy(F.desc("dl"), "doc_id")


def corpus_statistics(lengths: DataFrame) -> DataFrame:
    """``(n, avgdl)``: one row; documents without tokens do not count."""
    return lengths.where("dl > 0").agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))


def merge_statistics(*parts: DataFrame) -> DataFrame:
    """Add up term statistics of several sets of documents; the bucket of a term stays if all have it."""
    named = ["bucket"] if all("bucket" in part.columns for part in parts) else []
    columns = ["term", "df", "term_total", *named]
    united = parts[0].select(*columns)
    for part in parts[1:]:
        united = united.unionByName(part.select(*columns))
    return united.groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("term_total").alias("term_total"), *[F.min(name).alias(name) for name in named]
    )
