"""Adapters from the given tables to the inputs of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.durable import materialize
from rankloom.operators.graph import edges, normalized, pagerank
from rankloom.operators.index import MIN_DF
from rankloom.operators.ranking import match_terms
from rankloom.operators.terms import query_terms, term_facts
from rankloom.plans.build_index import Index, build_index, cut_index
from rankloom.plans.search import search
from rankloom.sources.corpus import read_corpus, spread_small

# Fixed value: the month of page views in the events table.
VIEW_MONTH = "2024-01"
NEXT_MONTH = "2024-02"

_SHARED: dict[tuple, object] = {}


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]) -> object:
    """A derived input, built once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SHARED:
        _SHARED[key] = build()
    return _SHARED[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_corpus(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``."""
    return spread_small(table(spark, sf_dir, "documents").select("doc_id", "text"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, query)``: every benchmark passage is a query."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


# Queries that find nothing: no word, stop words only, a word of no document.
EDGE_QUERIES = ((-1, ""), (-2, "the and for"), (-3, "zzqxjvk"))


def edge_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, query)``: the benchmark queries and those that find nothing."""
    queries = benchmark_queries(spark, sf_dir)
    return queries.unionByName(spark.createDataFrame(EDGE_QUERIES, queries.schema))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, doc_id, title, anchor_text)`` from the HTML of the pages table."""
    anchor = r'<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>'
    found = F.regexp_extract_all("html", F.lit(anchor), F.lit(0))
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return spread_small(table(spark, sf_dir, "pages").select("page_id", "html")).select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.col("page_id").alias("doc_id"),
        F.when(title != "", title).alias("title"),
        F.transform(
            found,
            lambda link: F.struct(
                F.regexp_extract(link, anchor, 1).alias("id"), F.regexp_extract(link, anchor, 2).alias("text")
            ),
        ).alias("anchor_text"),
    )


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, title)``."""
    return web_pages(spark, sf_dir).select("doc_id", "title").where("title is not null")


def two_months_of_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, user_id, ts)``: the view events, a third of them a month later."""
    later = F.when(F.col("event_id") % 3 == 0, F.make_ym_interval(F.lit(0), F.lit(1))).otherwise(F.make_ym_interval(F.lit(0), F.lit(0)))
    views = table(spark, sf_dir, "events").where("event_type = 'view'")
    return views.select("event_id", "user_id", (F.col("ts") + later).alias("ts"))


# Ranks by frequency of the words that frequent_queries pairs, and how many pairs there are.
FREQUENT_QUERIES = 12


def frequent_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, query)``: queries of two of the most frequent words, few terms with many postings."""
    order = Window.orderBy(F.desc("df"), "term")
    words = index(spark, sf_dir, 0).term_stats.orderBy(F.desc("df"), "term").limit(2 * FREQUENT_QUERIES + 1)
    words = words.withColumn("place", F.row_number().over(order)).select("place", "term")
    second = words.select((F.col("place") - 1).alias("twice"), F.col("term").alias("other"))
    return words.join(second, 2 * F.col("place") == F.col("twice")).select(
        F.col("place").cast("long").alias("query_id"), F.concat_ws(" ", "term", "other").alias("query")
    )


def supplier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, anchor_text)``: a supplier links to the suppliers of the next line of its orders."""
    lines = table(spark, sf_dir, "lineitem")
    this = lines.select("l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("src"))
    following = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("line"), F.col("l_suppkey").alias("dst"))
    return this.join(following, ["l_orderkey", "line"]).select(
        F.col("src").alias("id"), F.array(F.struct(F.col("dst").alias("id"))).alias("anchor_text")
    )


def index(spark: SparkSession, sf_dir: str, min_df: int = MIN_DF) -> Index:
    """The documents are indexed once, under the usual cut; another cut reads the same tables."""
    built = shared(spark, sf_dir, "index", lambda: build_index(documents(spark, sf_dir)))
    return shared(spark, sf_dir, f"index-{min_df}", lambda: cut_index(built, min_df))


def supplier_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(
        spark, sf_dir, "ranks", lambda: materialize(pagerank(edges(supplier_pages(spark, sf_dir))), "pagerank")
    )


def blending_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(supplier_ranks(spark, sf_dir))


def documents_with_all(whole: Index, terms: DataFrame) -> DataFrame:
    """``(query_id, doc_id)``: documents that have all ``terms (query_id, term)`` of a query.

    The facts lie in buckets by document, so a small batch counts its terms in a document without a shuffle of hits.
    """
    asked = terms.join(terms.groupBy("query_id").agg(F.count("*").alias("needed")), "query_id")
    matched = match_terms(term_facts(whole.doc_terms).select("term", "doc_id"), asked, whole.term_stats)
    found = matched.groupBy("query_id", "doc_id").agg(F.count("*").alias("found"), F.min("needed").alias("needed"))
    return found.where("found = needed").select("query_id", "doc_id")


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, doc_id)``: a document is relevant to a passage when it has all its terms."""

    def build() -> DataFrame:
        terms = query_terms(benchmark_queries(spark, sf_dir)).select("query_id", "term")
        return materialize(documents_with_all(index(spark, sf_dir, 0), terms), "judgments")

    return shared(spark, sf_dir, "judgments", build)


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(
        spark,
        sf_dir,
        "results",
        lambda: materialize(
            search(
                index(spark, sf_dir),
                benchmark_queries(spark, sf_dir),
                blending_ranks(spark, sf_dir),
                page_titles(spark, sf_dir),
            ),
            "results",
        ),
    )
