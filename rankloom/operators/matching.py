"""Body, title and anchor search, and page views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.scoring import nine_places
from rankloom.functions.text import STOP_WORDS, tokens
from rankloom.operators.ranking import indexed_terms, lookup, match_terms
from rankloom.operators.skew import fits_broadcast, hot_keys, least_that_fits, salted_join, top_k

# Fixed value: results of a body search.
BODY_TOP = 100


def document_norms(
    postings: DataFrame, term_stats: DataFrame, corpus_stats: DataFrame, min_hot_rows: int | None = None
) -> DataFrame:
    """``(doc_id, norm)``: length of each document's TF-IDF vector over the index vocabulary.

    A vocabulary that was counted and is small goes to the facts; with facts by document each task
    then has whole documents. Of a larger one its most frequent terms, which most facts have, go there, and only
    the facts of the others are joined by shuffle, with the hot terms split.
    """
    n = corpus_stats.select("n").scalar()
    facts, stats = postings.select("term", "doc_id", "tf"), term_stats.select("term", "df")
    weight = F.col("tf") * F.log(n / F.col("df"))

    def by_shuffle(facts: DataFrame, stats: DataFrame) -> DataFrame:
        return salted_join(facts, stats, "term", hot_keys(stats, "term", "df", min_hot_rows), ["doc_id"])

    least = least_that_fits(stats, "df")
    if least is None or least == 1:
        facts = facts.join(F.broadcast(stats), "term") if least else by_shuffle(facts, stats)
        return facts.groupBy("doc_id").agg(F.sqrt(F.sum(weight * weight)).alias("norm"))
    frequent, others = F.broadcast(stats.where(F.col("df") >= least)), stats.where(F.col("df") < least)
    known = facts.join(frequent, "term")
    rest = by_shuffle(facts.join(frequent, "term", "left_anti"), others)
    parts = [part.groupBy("doc_id").agg(F.sum(weight * weight).alias("squares")) for part in (known, rest)]
    return parts[0].unionByName(parts[1]).groupBy("doc_id").agg(F.sqrt(F.sum("squares")).alias("norm"))


def body_search(
    postings: DataFrame,
    term_stats: DataFrame,
    corpus_stats: DataFrame,
    query_term_rows: DataFrame,
    norms: DataFrame | None = None,
    k: int = BODY_TOP,
    small: bool | None = None,
    min_hot_rows: int | None = None,
    doc_parts: int | None = None,
) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: cosine of TF-IDF vectors, best ``k``, ties by document.

    Pairs that share only terms found in every document have no cosine and are left out. Facts and norms in
    the same buckets by document need no shuffle for sums and norms. Other hits are dealt by document
    to ``doc_parts``, if given, the buckets of the norms.
    """
    if norms is None:
        norms = document_norms(postings, term_stats, corpus_stats, min_hot_rows)
    n = corpus_stats.select("n").scalar()
    if small is None:
        small = fits_broadcast(query_term_rows)
    inverse = F.log(n / F.col("df"))
    known = (
        indexed_terms(query_term_rows, term_stats, small)
        .where("df > 0")
        .withColumns({"query_weight": F.col("qtf") * inverse, "idf": inverse})
        .drop("qtf", "df", "pos")
    )
    query_norms = known.groupBy("query_id").agg(F.sqrt(F.sum(F.pow("query_weight", F.lit(2)))).alias("query_norm"))
    hits = match_terms(postings, known, term_stats, small=small, min_hot_rows=min_hot_rows)
    if doc_parts:
        hits = hits.select("query_id", "doc_id", "tf", "idf", "query_weight").repartition(doc_parts, "doc_id")
    dots = (
        hits.groupBy("query_id", "doc_id")
        .agg(F.sum(F.col("tf") * F.col("idf") * F.col("query_weight")).alias("dot"))
        .where("dot > 0")
    )
    # A row per query; a batch that fits a broadcast has no more of them than terms.
    query_norms = F.broadcast(query_norms) if small else query_norms
    scored = dots.join(query_norms, "query_id").join(norms, "doc_id").select(
        "query_id", "doc_id", (F.col("dot") / (F.col("norm") * F.col("query_norm"))).alias("score")
    )
    order = [F.desc(nine_places("score")), F.asc("doc_id")]
    return top_k(scored, "query_id", order, k).select("query_id", "rank", "doc_id", "score")


def title_search(
    titles: DataFrame,
    query_term_rows: DataFrame,
    stop_words: Iterable[str] = STOP_WORDS,
    small: bool | None = None,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """``(query_id, doc_id, title, matches)``: all titles with a query word, by distinct words.

    The rows come in order of query, matches and document through a range shuffle, so a query that
    hits a large part of the titles is still sorted by many tasks.
    """
    words = titles.select(
        "doc_id", "title", F.explode_outer(F.array_distinct(tokens(F.col("title"), stop_words))).alias("term")
    ).where("term is not null")
    return (
        match_terms(words, query_term_rows.select("query_id", "term"),
                    small=small, min_hot_rows=min_hot_rows)
        .groupBy("query_id", "doc_id", "title")
        .agg(F.count("*").alias("matches"))
        .orderBy("query_id", F.desc("matches"), "doc_id")
    )


def anchor_rows(pages: DataFrame, links: str = "anchor_text") -> DataFrame:
    """``(doc_id, text)``: link target and link text of every link."""
    return (
        pages.select(F.explode(links).alias("link"))
        .select(F.col("link.id").alias("doc_id"), F.col("link.text").alias("text"))
        .where("doc_id is not null")
    )


def anchor_search(
    anchors: DataFrame,
    query_term_rows: DataFrame,
    stop_words: Iterable[str] = STOP_WORDS,
    small: bool | None = None,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """``(query_id, doc_id, matches)``: all link targets whose link texts have a query word.

    Many links to one target repeat its words; they fold into one row per task before a shuffle. A
    small batch is matched first, so only matching words are shuffled at all.
    """
    words = anchors.select(
        "doc_id", F.explode_outer(F.array_distinct(tokens(F.col("text"), stop_words))).alias("term")
    ).where("term is not null")
    wanted = query_term_rows.select("query_id", "term")
    if small is None:
        small = fits_broadcast(wanted)
    if small:
        hits = match_terms(words, wanted, small=True).select("query_id", "doc_id", "term").distinct()
    else:
        hits = match_terms(words.distinct(), wanted, small=False, min_hot_rows=min_hot_rows)
    return (
        hits.groupBy("query_id", "doc_id")
        .agg(F.count("*").alias("matches"))
        .orderBy("query_id", F.desc("matches"), "doc_id")
    )


def page_views(views: DataFrame, month: str, page_id: str = "id", at: str = "ts") -> DataFrame:
    """``(id, value)``: views per page in a month ``yyyy-mm``; the time range reaches the scan."""
    start = F.to_timestamp(F.lit(f"{month}-01"))
    end = F.to_timestamp(F.add_months(F.lit(f"{month}-01").cast("date"), 1))
    return (
        views.where((F.col(at) >= start) & (F.col(at) < end))
        .groupBy(F.col(page_id).alias("id"))
        .agg(F.count("*").alias("value"))
    )


def page_views_of(requests: DataFrame, monthly: DataFrame, min_hot_rows: int | None = None) -> DataFrame:
    """Page views of each listed id, 0 when absent."""
    return lookup(requests, monthly, 0, min_hot_rows)
