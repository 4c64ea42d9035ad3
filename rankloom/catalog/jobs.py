"""One Spark job per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import schemas
from rankloom.catalog import fixtures as fx
from rankloom.durable import scratch_path
from rankloom.functions.text import CORPUS_STOP_WORDS, ENGLISH_STOP_WORDS
from rankloom.operators import evaluation as ev
from rankloom.operators import graph as gr
from rankloom.operators import index as ix
from rankloom.operators import matching as mt
from rankloom.operators import ranking as rk
from rankloom.operators import terms as tx
from rankloom.operators.stems import stem_table
from rankloom.plans import search as sr
from rankloom.plans.build_index import Index, add_documents, bound_index, build_index, save_index
from rankloom.sources import artifacts, corpus, views
from rankloom.sources.judgments import judgment_table, query_table, read_judgments, save_judgments

Job = Callable[[SparkSession, str], DataFrame]

# A word that occurs in every size of the documents table.
SAMPLE_TERM = "eau"

# Results per query where the cuts of the metrics, 5, 30 and 40, are to show.
DEEP_RESULTS = 50

JOBS: dict[str, Job] = {}


def job(function: Job) -> Job:
    JOBS[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in columns})


# Sources and text


@job
def corpus_count(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.page_count(fx.table(spark, sf, "documents"))


@job
def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tx.token_table(fx.documents(spark, sf))


@job
def tokens_stop_table(spark: SparkSession, sf: str) -> DataFrame:
    nations = fx.table(spark, sf, "nation").select(F.lower("n_name").alias("term"))
    stops = tx.stop_word_table(spark, ENGLISH_STOP_WORDS, CORPUS_STOP_WORDS, nations)
    return tx.drop_stop_words(tx.token_table(fx.documents(spark, sf), ()), stops).select("doc_id", "pos", "term")


@job
def term_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tx.term_counts(fx.documents(spark, sf)).select("term", "doc_id", "tf")


@job
def query_terms(spark: SparkSession, sf: str) -> DataFrame:
    return tx.query_terms(fx.benchmark_queries(spark, sf))


def corpus_stems(spark: SparkSession, sf: str) -> DataFrame:
    """``(term, stem)``: words of the corpus that are another of its words with a regular ending."""
    return fx.shared(spark, sf, "stems", lambda: stem_table(fx.index(spark, sf, 0).term_stats))


@job
def stems(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_stems(spark, sf)


@job
def mapped_terms(spark: SparkSession, sf: str) -> DataFrame:
    return tx.map_terms(tx.query_terms(fx.benchmark_queries(spark, sf)), corpus_stems(spark, sf))


@job
def titles(spark: SparkSession, sf: str) -> DataFrame:
    return fx.page_titles(spark, sf)


# Index


@job
def term_df(spark: SparkSession, sf: str) -> DataFrame:
    return fx.index(spark, sf, 0).term_stats.select("term", "df")


@job
def term_totals(spark: SparkSession, sf: str) -> DataFrame:
    return fx.index(spark, sf, 0).term_stats.select("term", "term_total")


@job
def frequent_terms(spark: SparkSession, sf: str) -> DataFrame:
    return fx.index(spark, sf).term_stats.select("term", "df")


@job
def postings(spark: SparkSession, sf: str) -> DataFrame:
    return fx.index(spark, sf).postings.select("term", "doc_id", "tf")


@job
def posting_lists(spark: SparkSession, sf: str) -> DataFrame:
    lists = ix.posting_lists(fx.index(spark, sf).postings)
    as_text = F.transform("postings", lambda p: F.concat_ws(":", p["doc_id"].cast("string"), p["tf"].cast("string")))
    return lists.select("term", "block", F.array_join(as_text, " ").alias("postings"))


@job
def posting_of_term(spark: SparkSession, sf: str) -> DataFrame:
    return ix.postings_of(fx.index(spark, sf, 0).postings, SAMPLE_TERM, ix.NUM_BUCKETS)


@job
def bucket_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return ix.bucket_sizes(fx.index(spark, sf, 0).term_stats)


@job
def doc_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return ix.longest_first(ix.doc_lengths(tx.term_counts(fx.documents(spark, sf))))


@job
def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fx.index(spark, sf).corpus_stats, "avgdl")


def grown_index(spark: SparkSession, sf: str, min_df: int = 0) -> Index:
    """The English documents indexed first, the others added, published and loaded again."""

    def build() -> Index:
        docs = fx.table(spark, sf, "documents")
        first = build_index(docs.where("lang <=> 'en'").select("doc_id", "text"), min_df=min_df)
        grown = add_documents(first, docs.where("not lang <=> 'en'").select("doc_id", "text"))
        return save_index(grown)

    return fx.shared(spark, sf, f"grown-{min_df}", build)


@job
def index_after_add(spark: SparkSession, sf: str) -> DataFrame:
    return grown_index(spark, sf).term_stats.select("term", "df", "term_total")


@job
def bm25_after_add(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sr.bm25(grown_index(spark, sf), fx.benchmark_queries(spark, sf)), "score")


@job
def index_after_add_pruned(spark: SparkSession, sf: str) -> DataFrame:
    return grown_index(spark, sf, ix.MIN_DF).term_stats.select("term", "df", "term_total")


@job
def bm25_after_add_pruned(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sr.bm25(grown_index(spark, sf, ix.MIN_DF), fx.benchmark_queries(spark, sf)), "score")


@job
def saved_doc_lengths(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "dl")
    artifacts.save_lengths(fx.index(spark, sf).doc_lengths, path)
    return artifacts.load_csv(spark, path, schemas.DOC_LENGTHS)


@job
def saved_titles(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "titles")
    artifacts.save_titles(fx.page_titles(spark, sf), path)
    return artifacts.load_csv(spark, path, schemas.TITLES)


@job
def saved_pagerank(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "pr")
    artifacts.save_pagerank(fx.supplier_ranks(spark, sf), path)
    return rounded(artifacts.load_csv(spark, path, schemas.PAGERANK), "pagerank")


# Ranking


def _idf(spark: SparkSession, sf: str, unknown_zero: bool) -> DataFrame:
    index = fx.index(spark, sf)
    terms = tx.query_terms(fx.benchmark_queries(spark, sf))
    found = rk.with_idf(terms, index.term_stats, index.corpus_stats, unknown_zero)
    return rounded(found.select("query_id", "term", "df", "idf"), "idf")


@job
def query_idf(spark: SparkSession, sf: str) -> DataFrame:
    return _idf(spark, sf, False)


@job
def query_idf_zero(spark: SparkSession, sf: str) -> DataFrame:
    return _idf(spark, sf, True)


@job
def bm25_top10(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sr.bm25(fx.index(spark, sf), fx.benchmark_queries(spark, sf)), "score")


@job
def bm25_all_terms_top10(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sr.bm25(fx.index(spark, sf, 0), fx.benchmark_queries(spark, sf)), "score")


@job
def bm25_by_term_top10(spark: SparkSession, sf: str) -> DataFrame:
    index = fx.index(spark, sf)
    by_term = Index(index.postings, index.term_stats, index.doc_lengths, index.corpus_stats)
    return rounded(sr.bm25(by_term, fx.benchmark_queries(spark, sf)), "score")


@job
def bm25_frequent_terms_top10(spark: SparkSession, sf: str) -> DataFrame:
    """Few terms with many postings, by score bounds of blocks of documents."""
    bounded = fx.shared(spark, sf, "bounded", lambda: bound_index(fx.index(spark, sf, 0), 20))
    return rounded(sr.bm25(bounded, fx.frequent_queries(spark, sf), prune_rows=0), "score")


@job
def body_search_frequent_terms(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sr.body(fx.index(spark, sf, 0), fx.frequent_queries(spark, sf)), "score")


@job
def bm25_separate_lengths_top10(spark: SparkSession, sf: str) -> DataFrame:
    index = fx.index(spark, sf)
    bare = Index(index.postings.drop("dl"), index.term_stats, index.doc_lengths, index.corpus_stats)
    return rounded(sr.bm25(bare, fx.benchmark_queries(spark, sf)), "score")


@job
def bm25_classic_top10(spark: SparkSession, sf: str) -> DataFrame:
    found = sr.bm25_classic(fx.index(spark, sf), fx.benchmark_queries(spark, sf), corpus_stems(spark, sf))
    return rounded(found, "score")


@job
def bm25_edge_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Queries without words, with stop words only and with unknown words among the others."""
    return rounded(sr.bm25(fx.index(spark, sf), fx.edge_queries(spark, sf)), "score")


@job
def rerank(spark: SparkSession, sf: str) -> DataFrame:
    found = sr.bm25_with_pagerank(fx.index(spark, sf), fx.benchmark_queries(spark, sf), fx.blending_ranks(spark, sf))
    return rounded(found, "score")


@job
def search(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fx.search_results(spark, sf), "score")


@job
def search_without_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """No PageRank and no titles saved: both load as empty tables."""
    ranks = artifacts.load_or_empty(spark, scratch_path(spark, "no-ranks"), schemas.PAGERANK)
    names = artifacts.load_or_empty(spark, scratch_path(spark, "no-titles"), schemas.TITLES)
    return rounded(sr.search(fx.index(spark, sf), fx.benchmark_queries(spark, sf), ranks, names), "score")


@job
def body_search(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sr.body(fx.index(spark, sf), fx.benchmark_queries(spark, sf)), "score")


@job
def title_search(spark: SparkSession, sf: str) -> DataFrame:
    return mt.title_search(fx.page_titles(spark, sf), tx.query_terms(fx.benchmark_queries(spark, sf)))


@job
def anchor_search(spark: SparkSession, sf: str) -> DataFrame:
    anchors = mt.anchor_rows(fx.web_pages(spark, sf))
    return mt.anchor_search(anchors, tx.query_terms(fx.benchmark_queries(spark, sf)))


@job
def pageview_lookup(spark: SparkSession, sf: str) -> DataFrame:
    requests = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("request_id"),
        F.array("c_custkey", F.col("c_nationkey").cast("long"), "c_custkey").alias("ids"),
    )
    views = fx.table(spark, sf, "events").where("event_type = 'view'")
    return mt.page_views_of(requests, mt.page_views(views, fx.VIEW_MONTH, "user_id"))


@job
def monthly_page_views(spark: SparkSession, sf: str) -> DataFrame:
    views = fx.table(spark, sf, "events").where("event_type = 'view'")
    return mt.page_views(views, fx.VIEW_MONTH, "user_id")


def view_store(spark: SparkSession, sf: str) -> str:
    """A store of two months, filled in two goes; the second brings late views of both."""

    def fill() -> str:
        path, rows = scratch_path(spark, "views"), fx.two_months_of_views(spark, sf)
        for late in (False, True):
            views.add_views(spark, path, rows.where(F.lit(late) == (F.col("event_id") % 5 == 0)), "user_id")
        return path

    return fx.shared(spark, sf, "views", fill)


@job
def stored_page_views(spark: SparkSession, sf: str) -> DataFrame:
    return views.month_views(spark, view_store(spark, sf), fx.NEXT_MONTH)


@job
def stored_pageview_lookup(spark: SparkSession, sf: str) -> DataFrame:
    requests = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("request_id"), F.array("c_custkey", F.col("c_nationkey").cast("long")).alias("ids")
    )
    return mt.page_views_of(requests, views.month_views(spark, view_store(spark, sf), fx.VIEW_MONTH))


# Graph


@job
def edges(spark: SparkSession, sf: str) -> DataFrame:
    return gr.edges(fx.supplier_pages(spark, sf))


@job
def link_rows(spark: SparkSession, sf: str) -> DataFrame:
    return gr.link_rows(fx.web_pages(spark, sf))


@job
def vertices(spark: SparkSession, sf: str) -> DataFrame:
    return gr.vertices(gr.edges(fx.web_pages(spark, sf)))


@job
def pagerank(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gr.highest_first(fx.supplier_ranks(spark, sf)), "pagerank")


@job
def pagerank_sinks(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gr.highest_first(gr.pagerank(gr.edges(fx.web_pages(spark, sf)))), "pagerank")


@job
def pagerank_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gr.normalized(fx.supplier_ranks(spark, sf)), "pagerank")


@job
def pagerank_normalized_max(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gr.normalized(fx.supplier_ranks(spark, sf), "max"), "pagerank")


@job
def pagerank_normalized_sum(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gr.normalized(fx.supplier_ranks(spark, sf), "sum"), "pagerank")


@job
def pagerank_lookup(spark: SparkSession, sf: str) -> DataFrame:
    requests = fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.array("o_custkey", "o_orderkey", "o_custkey").alias("ids")
    )
    return rounded(rk.pagerank_of(requests, fx.supplier_ranks(spark, sf)), "value")


# Evaluation


@job
def judgments(spark: SparkSession, sf: str) -> DataFrame:
    return fx.judgments(spark, sf)


@job
def stored_judgments(spark: SparkSession, sf: str) -> DataFrame:
    """Judgments written as JSON objects by the text of the query and read again; queries without any stay."""
    path, queries = scratch_path(spark, "judged"), fx.benchmark_queries(spark, sf)
    judged = queries.join(fx.judgments(spark, sf), "query_id", "left").select("query", "doc_id").distinct()
    save_judgments(judged, path, 3)
    read = read_judgments(spark, path)
    return query_table(read).join(judgment_table(read), "query_id", "left").select("query", "doc_id")


def _judged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fx.benchmark_queries(spark, sf), fx.search_results(spark, sf), fx.judgments(spark, sf)


@job
def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    return ev.average_precision(*_judged(spark, sf))


@job
def precision_recall_f1(spark: SparkSession, sf: str) -> DataFrame:
    return ev.precision_recall_f1(*_judged(spark, sf), 5)


@job
def results_quality(spark: SparkSession, sf: str) -> DataFrame:
    return ev.results_quality(*_judged(spark, sf))


@job
def eval_per_query(spark: SparkSession, sf: str) -> DataFrame:
    return ev.evaluate(*_judged(spark, sf))


def _deep(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """More results than any metric looks at, and queries without results."""
    queries = fx.edge_queries(spark, sf)
    return queries, sr.bm25(fx.index(spark, sf), queries, DEEP_RESULTS), fx.judgments(spark, sf)


@job
def eval_edge_queries(spark: SparkSession, sf: str) -> DataFrame:
    return ev.evaluate(*_deep(spark, sf))


@job
def average_precision_edge_queries(spark: SparkSession, sf: str) -> DataFrame:
    return ev.average_precision(*_deep(spark, sf))


@job
def eval_summary(spark: SparkSession, sf: str) -> DataFrame:
    queries, ranks, names = fx.benchmark_queries(spark, sf), fx.blending_ranks(spark, sf), fx.page_titles(spark, sf)
    summary = sr.evaluate_search(fx.index(spark, sf), queries, ranks, names, fx.judgments(spark, sf))[1]
    return rounded(summary, "average_quality")
