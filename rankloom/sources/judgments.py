"""Reading and writing queries with relevance judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_judgments(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, query, doc_id)`` from files that hold one JSON object ``{query: [id, ...]}``.

    The query text is its own id. A query with an empty list stays, with a null document.
    """
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(F.from_json("value", "map<string, array<string>>")).alias("query", "ids"))
        .select(F.col("query").alias("query_id"), "query", F.explode_outer("ids").alias("doc_id"))
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )


def query_table(judged: DataFrame) -> DataFrame:
    """``(query_id, query)``: each query once."""
    return judged.select("query_id", "query").distinct()


def judgment_table(judged: DataFrame) -> DataFrame:
    """``(query_id, doc_id)``: the relevant documents."""
    return judged.select("query_id", "doc_id").where("doc_id is not null")


def save_judgments(judged: DataFrame, path: str, parts: int = 1) -> None:
    """Write ``(query, doc_id)`` as ``parts`` files of one JSON object ``{query: [id, ...]}`` each, replacing what was there.

    A query whose documents are all null has an empty list. A file holds its queries as one object, so choose
    as many parts as keep a file small; all rows of a query are in one.
    """
    ids = F.sort_array(F.collect_list(F.col("doc_id").cast("string")))
    lists = judged.groupBy("query").agg(ids.alias("ids"))
    part = F.pmod(F.xxhash64("query"), F.lit(parts))
    whole = lists.groupBy(part.alias("part")).agg(F.map_from_entries(F.collect_list(F.struct("query", "ids"))).alias("judged"))
    whole.select(F.to_json("judged").alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
