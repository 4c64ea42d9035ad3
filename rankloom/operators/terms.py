"""Text operators: tokens, term counts, query terms."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.text import STOP_WORDS, tokens
from rankloom.operators.skew import hot_keys, salted_join


def token_table(
    docs: DataFrame, stop_words: Iterable[str] = STOP_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, pos, term)``: every kept token in order, repeats included."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.posexplode_outer(tokens(F.col(text), stop_words)).alias("pos", "term")
    ).where("term is not null")


def stop_word_table(spark: SparkSession, *lists: Iterable[str] | DataFrame) -> DataFrame:
    """``(term)``: the union of stop-word lists or one-column tables, each word once."""
    result = spark.createDataFrame([], "term string")
    for words in lists:
        table = words if isinstance(words, DataFrame) else spark.createDataFrame([(w,) for w in words], "term string")
        result = result.union(table)
    return result.distinct()


def drop_stop_words(token_rows: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Token rows whose term is not in a stop-word table.

    No hint: the optimizer broadcasts the list when its size allows and shuffles it otherwise.
    """
    return token_rows.join(stop_words.select("term"), "term", "left_anti")


def doc_terms(
    docs: DataFrame, stop_words: Iterable[str] = STOP_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, dl, terms array<struct<term, tf>>)``: one row per document, no shuffle.

    A document is one row, so its terms are counted in place: sort its tokens, find where each run
    of equal tokens starts, and take the distance to the next start.
    """
    ordered = docs.select(
        F.col(doc_id).alias("doc_id"), F.sort_array(tokens(F.col(text), stop_words)).alias("sorted")
    )
    starts = ordered.withColumn("dl", F.size("sorted").cast("long")).withColumn(
        "starts",
        F.filter(
            F.when(F.col("dl") > 0, F.sequence(F.lit(0), F.size("sorted") - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: (i == 0) | (F.get("sorted", i) != F.get("sorted", i - 1)),
        ),
    )
    return starts.select(
        "doc_id",
        "dl",
        F.transform(
            "starts",
            lambda start, i: F.struct(
                F.get("sorted", start).alias("term"),
                (F.coalesce(F.get("starts", i + 1), F.size("sorted")) - start).cast("long").alias("tf"),
            ),
        ).alias("terms"),
    )


def term_facts(per_doc: DataFrame) -> DataFrame:
    """``(term, doc_id, tf, dl)`` from :func:`doc_terms`.

    The outer generator keeps the optimizer from inferring a size filter, which it would push below
    the counting and so run the counting twice.
    """
    return (
        per_doc.select("doc_id", "dl", F.inline_outer("terms"))
        .where("term is not null")
        .select("term", "doc_id", "tf", "dl")
    )


def term_counts(
    docs: DataFrame, stop_words: Iterable[str] = STOP_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(term, doc_id, tf, dl)``: word counts of each document, with the document's length."""
    return term_facts(doc_terms(docs, stop_words, doc_id, text))


def query_terms(queries: DataFrame, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """``(query_id, term, qtf, pos)`` from ``(query_id, query)``: repeats and first position."""
    positions = queries.select(
        "query_id", F.posexplode_outer(tokens(F.col("query"), stop_words)).alias("pos", "term")
    ).where("term is not null")
    return positions.groupBy("query_id", "term").agg(F.count("*").alias("qtf"), F.min("pos").alias("pos"))


def map_terms(query_term_rows: DataFrame, stems: DataFrame) -> DataFrame:
    """Replace query terms by their stem ``(term, stem)``; terms without one stay.

    Words that share a stem become one term whose repeats add up.
    """
    counts = query_term_rows.groupBy("term").agg(F.count("*").alias("rows"))
    hot = hot_keys(counts, "term", "rows")
    return (
        salted_join(query_term_rows, stems.select("term", "stem"), "term", hot, ["query_id"], "left")
        .withColumn("term", F.coalesce("stem", "term"))
        .groupBy("query_id", "term")
        .agg(F.sum("qtf").alias("qtf"), F.min("pos").alias("pos"))
    )
