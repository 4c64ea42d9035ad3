"""Documents to a training mixture: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.durable import materialize
from rankloom.llm import decontaminate, mixing, near_dup, pii, quality


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have too few words and go. Repeated rows share a verdict; an empty table stays empty.
    """
    return quality.keep_good(docs)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; see :func:`near_dup.keep_one`."""
    return near_dup.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; without a benchmark all stay."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data, under the session's key; nulls stay null."""
    return pii.pseudonymize(docs, pii.session_key(spark))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each time a document is taken, with its round and words; see :func:`mixing.mixed`."""
    return mixing.mixed(docs)


STAGES = [
    ("quality rules", good),
    ("near duplicates", unique),
    ("decontamination", clean),
    ("pseudonyms", private),
    ("mixture", mixture),
]

# Pseudonyms cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Extra columns go along, whatever their names; an empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
