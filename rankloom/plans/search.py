"""Answering a table of queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.durable import Scratch, materialize
from rankloom.functions.scoring import B, B_CLASSIC, K1
from rankloom.functions.text import STOP_WORDS
from rankloom.operators import blocks
from rankloom.operators import ranking as rk
from rankloom.operators.evaluation import evaluate, summary
from rankloom.operators.index import NUM_BUCKETS
from rankloom.operators.matching import BODY_TOP, body_search, document_norms
from rankloom.operators.skew import batch_size, fits_broadcast
from rankloom.operators.terms import map_terms, query_terms, term_facts
from rankloom.plans.build_index import Index

# Fixed value: candidates of the full search.
SEARCH_CANDIDATES = 20

# Distinct query terms from which the facts by document are read.
MANY_TERMS = NUM_BUCKETS


def bm25(
    index: Index,
    queries: DataFrame,
    k: int = rk.TOP,
    k1: float = K1,
    b: float = B,
    stop_words: Iterable[str] = STOP_WORDS,
    stems: DataFrame | None = None,
    prune_rows: int = blocks.PRUNE_ROWS,
) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: BM25 top ``k`` of each query ``(query_id, query)``.

    A few terms with ``prune_rows`` postings or more are first looked up in the score bounds of blocks of documents.
    """
    terms = query_terms(queries, stop_words)
    if stems is not None:
        terms = map_terms(terms, stems)
    small, distinct = batch_size(terms)
    if small and distinct <= MANY_TERMS and index.impacts is not None:
        asked = [row.term for row in terms.select("term").distinct().collect()]
        found = index.term_stats.where(F.col("term").isin(asked)).agg(F.sum("df")).first()[0] or 0
        if found >= prune_rows:
            return _pruned(index, terms, asked, k, k1, b)
    facts = facts_for(index, distinct, terms)
    lengths = None if "dl" in facts.columns else index.doc_lengths
    scores = rk.bm25_scores(facts, index.term_stats, index.corpus_stats, terms, lengths, k1, b, small)
    return rk.best_first(scores, k)


def _pruned(index: Index, terms: DataFrame, asked: list[str], k: int, k1: float, b: float) -> DataFrame:
    """The same result from the blocks of documents that can reach it; written, as the bounds are not kept."""
    named = F.col("term").isin(asked)
    with Scratch(terms.sparkSession) as scratch:
        scores, _ = blocks.pruned_scores(
            index.impacts.where(named), index.by_term.where(named), index.term_stats, index.corpus_stats, terms, k, scratch, k1, b
        )
        return materialize(rk.best_first(scores, k), "best")


def facts_for(index: Index, distinct_terms: int, terms: DataFrame) -> DataFrame:
    """The postings for a few query terms, the facts by document for many.

    A few terms touch a few buckets, and the others are not read. With more terms than buckets nearly
    all are read anyway; then it pays that the facts lie in buckets by document, where the sum of a query and
    a document needs no shuffle at all.
    """
    if distinct_terms <= MANY_TERMS:
        # So few terms go into the plan, where they reach the scan and skip row groups.
        asked = [row.term for row in terms.select("term").distinct().collect()]
        return index.by_term.where(F.col("term").isin(asked))
    if index.doc_terms is None:
        return index.by_term
    return term_facts(index.doc_terms)


def body(index: Index, queries: DataFrame, norms: DataFrame | None = None, k: int = BODY_TOP) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: body search of each query ``(query_id, query)``.

    Norms lie in the buckets of the documents, so the sums are joined with them where they are made; for a
    few terms the hits go there in the one shuffle that sums them.
    """
    terms = query_terms(queries)
    small, distinct = batch_size(terms)
    facts = facts_for(index, distinct, terms)
    if norms is None:
        norms = index.norms
    if norms is None:
        by_doc = index.by_term if index.doc_terms is None else term_facts(index.doc_terms)
        norms = document_norms(by_doc, index.term_stats, index.corpus_stats)
    by_document = index.doc_terms is not None and distinct > MANY_TERMS
    parts = index.version.doc_buckets if index.version and not by_document else None
    return body_search(facts, index.term_stats, index.corpus_stats, terms, norms, k, small, doc_parts=parts)


def bm25_classic(index: Index, queries: DataFrame, stems: DataFrame | None = None, k: int = rk.TOP) -> DataFrame:
    """The older variant: ``b`` = 0.75 and stemmed query terms."""
    return bm25(index, queries, k, b=B_CLASSIC, stems=stems)


def bm25_with_pagerank(
    index: Index,
    queries: DataFrame,
    ranks: DataFrame,
    k: int = rk.TOP,
    alpha: float = rk.ALPHA,
    candidates: int = rk.RERANK_CANDIDATES,
) -> DataFrame:
    """BM25 candidates blended with PageRank: ``(query_id, rank, doc_id, score)``.

    The candidates are written out, at most ``candidates`` rows per query, so the joins after them
    are planned on their true size.
    """
    found = materialize(bm25(index, queries, candidates), "candidates")
    return rk.rerank(found, ranks, k, alpha)


def search(index: Index, queries: DataFrame, ranks: DataFrame, titles: DataFrame) -> DataFrame:
    """``(query_id, rank, doc_id, score, title)``: the full search.

    A query that is empty or has only stop words or unknown words has no rows.
    """
    found = materialize(bm25(index, queries, SEARCH_CANDIDATES), "candidates")
    keys = found.select("doc_id")
    small = fits_broadcast(keys)
    return rk.with_titles(rk.rerank(found, ranks, small=small), titles, keys=keys, small=small)


def evaluate_search(
    index: Index, queries: DataFrame, ranks: DataFrame, titles: DataFrame, judgments: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Run all queries as one batch: quality per query, and its summary."""
    results = materialize(search(index, queries, ranks, titles), "results")
    per_query = evaluate(queries, results, judgments)
    return per_query, summary(per_query)
