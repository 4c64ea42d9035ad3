"""Ranking operators: idf, BM25, blending with PageRank, lookups by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.scoring import B, K1, bm25_term_score, idf, nine_places
from rankloom.operators.skew import fits_broadcast, hot_keys, salted_join, top_k

# Results and candidates of one search, weight of the text score, missing title.
TOP = 10
RERANK_CANDIDATES = 30
ALPHA = 0.8
NO_TITLE = "UNKNOWN TITLE"


def match_terms(
    facts: DataFrame,
    query_term_rows: DataFrame,
    term_rows: DataFrame | None = None,
    spread: str = "doc_id",
    small: bool | None = None,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """Join facts ``(term, ...)`` with query terms.

    A counted, bounded batch of queries is broadcast, so the facts are not shuffled. A larger one is
    joined by shuffle with the hot terms split; ``term_rows (term, df)`` saves counting them.
    ``small`` is the outcome of a count already made. Where both sides have the term's bucket, the
    broadcast also tells the scan which bucket folders to read.
    """
    if small is None:
        small = fits_broadcast(query_term_rows)
    bucketed = "bucket" in facts.columns and "bucket" in query_term_rows.columns
    if small:
        return facts.join(F.broadcast(query_term_rows), ["term", "bucket"] if bucketed else "term")
    if bucketed:
        query_term_rows = query_term_rows.drop("bucket")
    if term_rows is None:
        term_rows = facts.groupBy("term").agg(F.count("*").alias("df"))
    hot = hot_keys(term_rows, "term", "df", min_hot_rows)
    return salted_join(facts, query_term_rows, "term", hot, [spread])


def indexed_terms(query_term_rows: DataFrame, term_stats: DataFrame, small: bool | None = None) -> DataFrame:
    """Query terms of the index with their ``df``, and ``bucket`` if the index has one.

    The index has one row per term, so there are no more rows than query terms. Only the query side
    can be hot here: a word that a large part of the queries share.
    """
    if small is None:
        small = fits_broadcast(query_term_rows)
    stats = term_stats.drop("term_total")
    if small:
        return stats.join(F.broadcast(query_term_rows), "term")
    asked = query_term_rows.groupBy("term").agg(F.count("*").alias("n"))
    return salted_join(query_term_rows, stats, "term", hot_keys(asked, "term", "n"), ["query_id"])


def with_idf(
    query_term_rows: DataFrame, term_stats: DataFrame, corpus_stats: DataFrame, unknown_zero: bool = False
) -> DataFrame:
    """Query terms with ``df`` and ``idf``; a term outside the index has df 0.

    With ``unknown_zero`` such a term has idf 0.0 instead of the formula's largest value. The
    statistics are cut to the terms asked for before they are joined.
    """
    asked = term_stats.select("term", "df").join(query_term_rows.select("term").distinct(), "term", "left_semi")
    n = corpus_stats.select("n").scalar()
    formula = idf(n, F.coalesce("df", F.lit(0)))
    # A word that most queries share is hot on the query side.
    counts = query_term_rows.groupBy("term").agg(F.count("*").alias("rows"))
    joined = salted_join(query_term_rows, asked, "term", hot_keys(counts, "term", "rows"), ["query_id"], "left")
    return joined.select(
        *query_term_rows.columns,
        F.coalesce("df", F.lit(0)).alias("df"),
        (F.when(F.col("df").isNull(), F.lit(0.0)).otherwise(formula) if unknown_zero else formula).alias("idf"),
    )


def bm25_scores(
    postings: DataFrame,
    term_stats: DataFrame,
    corpus_stats: DataFrame,
    query_term_rows: DataFrame,
    lengths: DataFrame | None = None,
    k1: float = K1,
    b: float = B,
    small: bool | None = None,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """``(query_id, doc_id, score, pos)`` of all matching pairs.

    ``pos`` is where the document was first met. Repeated query words count each time; terms
    outside the index and documents without a length are skipped. Postings that carry ``dl`` need
    no length table, which leaves a single shuffle, on query and document, after partial sums.
    """
    if small is None:
        small = fits_broadcast(query_term_rows)
    n = corpus_stats.select("n").scalar()
    avgdl = corpus_stats.select("avgdl").scalar()
    # df > 0 always holds; it marks this side as selective, which bucket pruning asks for.
    weighted = (
        indexed_terms(query_term_rows, term_stats, small)
        .where("df > 0")
        .withColumn("weight", F.col("qtf") * idf(n, F.col("df")))
        .drop("qtf", "df")
    )
    facts = postings if lengths is None else postings.drop("dl")
    hits = match_terms(facts, weighted, term_stats, small=small, min_hot_rows=min_hot_rows)
    if lengths is not None:
        hits = hits.join(lengths.select("doc_id", "dl"), "doc_id")
    part = F.col("weight") * bm25_term_score(F.col("tf"), F.col("dl"), avgdl, k1, b)
    return hits.groupBy("query_id", "doc_id").agg(F.sum(part).alias("score"), F.min("pos").alias("pos"))


def best_first(scores: DataFrame, k: int = TOP) -> DataFrame:
    """Top ``k`` per query; equal scores keep the order in which documents were met.

    Comparing 9 places absorbs the order of summation.
    """
    order = [F.desc(nine_places("score")), F.asc("pos"), F.asc("doc_id")]
    return top_k(scores, "query_id", order, k).select("query_id", "rank", "doc_id", "score")


def rerank(
    candidates: DataFrame, ranks: DataFrame, k: int = TOP, alpha: float = ALPHA, small: bool | None = None
) -> DataFrame:
    """Blend text score and PageRank and keep the best ``k``; equal values keep the text order.

    ``candidates (query_id, rank, doc_id, score)``; a document without PageRank has 0.0. The ranks
    are cut to the candidates first, so the large table is not shuffled for a small batch.
    """
    known = ranks.select(F.col("id").alias("doc_id"), "pagerank")
    blended = attach(candidates, known, "doc_id", small=small).withColumn(
        "final", F.lit(alpha) * F.col("score") + F.lit(1 - alpha) * F.coalesce("pagerank", F.lit(0.0))
    )
    order = [F.desc(nine_places("final")), F.asc("rank")]
    return top_k(blended, "query_id", order, k, "place").select(
        "query_id", F.col("place").alias("rank"), "doc_id", F.col("final").alias("score")
    )


def attach(rows: DataFrame, values: DataFrame, key: str, keys: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """Left join with a table of one row per key.

    ``keys`` holds the keys of the rows, or more. Keys that were counted and are few go to the values, so the large table
    is cut without a shuffle; what is left of it, one row per key at most, is joined as its size at run time
    suggests. More of them are joined by shuffle with hot keys split. ``small`` is the outcome of a count already made.
    """
    keys = (rows if keys is None else keys).select(key).distinct()
    if small is None:
        small = fits_broadcast(keys)
    if small:
        return rows.join(values.join(F.broadcast(keys), key, "left_semi"), key, "left")
    needed = values.join(keys, key, "left_semi")
    counts = rows.groupBy(key).agg(F.count("*").alias("rows"))
    others = [name for name in rows.columns if name != key]
    return salted_join(rows, needed, key, hot_keys(counts, key, "rows"), others, "left")


def with_titles(
    results: DataFrame, titles: DataFrame, missing: str = NO_TITLE, keys: DataFrame | None = None, small: bool | None = None
) -> DataFrame:
    """Results with ``title``; ``keys`` and ``small`` as in :func:`attach`."""
    return attach(results, titles.select("doc_id", "title"), "doc_id", keys, small).withColumn(
        "title", F.coalesce("title", F.lit(missing))
    )


def lookup(requests: DataFrame, values: DataFrame, default: float | int, min_hot_rows: int | None = None) -> DataFrame:
    """``(request_id, pos, id, value)`` for ``requests (request_id, ids)`` and ``values (id, value)``.

    Order and repeats of the ids stay; an id without a value has the default. An id that many
    requests name is split over tasks.
    """
    asked = requests.select("request_id", F.posexplode("ids").alias("pos", "id"))
    counts = asked.groupBy("id").agg(F.count("*").alias("n"))
    found = salted_join(
        asked, values.select("id", "value"), "id", hot_keys(counts, "id", "n", min_hot_rows), ["request_id", "pos"], "left"
    )
    return found.select("request_id", "pos", "id", F.coalesce("value", F.lit(default)).alias("value"))


def pagerank_of(requests: DataFrame, ranks: DataFrame, min_hot_rows: int | None = None) -> DataFrame:
    """PageRank of each listed id, 0.0 when absent."""
    return lookup(requests, ranks.select("id", F.col("pagerank").alias("value")), 0.0, min_hot_rows)
