"""What the plans must look like to hold at a much larger scale."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.operators import graph as gr
from rankloom.operators import index as ix
from rankloom.operators import matching as mt
from rankloom.operators import ranking as rk
from rankloom.operators import terms as tx
from rankloom.operators.skew import _measures, hot_keys
from rankloom.plans.search import bm25, body


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_counting_terms_needs_no_shuffle_and_two_columns(spark, sf_dir):
    text = plan(tx.term_counts(fx.table(spark, sf_dir, "documents")))
    assert "Exchange" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert text.count("regexp_extract_all") == 1


def test_a_small_batch_does_not_shuffle_postings(spark, sf_dir):
    index = fx.index(spark, sf_dir)
    few = spark.createDataFrame([(1, "eau inin tion")], "query_id long, query string")
    text = plan(bm25(index, few))
    assert "dynamicpruning" in text and "/postings" in text
    text = plan(bm25(index, fx.benchmark_queries(spark, sf_dir)))
    assert "/doc_terms" in text and "/postings" not in text
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_a_large_batch_is_joined_by_shuffle(spark, sf_dir):
    index = fx.index(spark, sf_dir, 0)
    terms = tx.query_terms(fx.benchmark_queries(spark, sf_dir))
    text = plan(rk.match_terms(index.postings, terms, index.term_stats, small=False))
    assert "xxhash64" in text and "salt" in text
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_one_term_reaches_the_scan(spark, sf_dir):
    text = plan(ix.postings_of(fx.index(spark, sf_dir, 0).postings, "eau", ix.NUM_BUCKETS))
    assert "EqualTo(term,eau)" in text
    assert "PartitionFilters: [isnotnull(bucket" in text


def test_month_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(mt.page_views(fx.table(spark, sf_dir, "events"), "2024-01", "user_id"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_hot_keys_are_few_and_split_by_rows(spark, monkeypatch):
    counts = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("n"))
    monkeypatch.setattr("rankloom.operators.skew.HOT_KEYS", 1000)
    assert hot_keys(counts, "key", "n", 0).count() <= 1000
    assert hot_keys(counts, "key", "n").count() == 0
    skewed = spark.createDataFrame([("a", 100_000)] + [(f"k{i}", 1) for i in range(50)], "key string, n long")
    assert [tuple(r) for r in hot_keys(skewed, "key", "n", 100).collect()] == [("a", 1000)]


def test_a_key_with_a_small_share_is_split(spark):
    counts = spark.createDataFrame([("a", 500_000_000), ("b", 10**12 - 500_000_000)], "key string, n long")
    assert dict(map(tuple, hot_keys(counts, "key", "n").collect()))["a"] == 100


def test_counting_a_batch_has_no_funnel(spark, sf_dir):
    terms = tx.query_terms(fx.benchmark_queries(spark, sf_dir))
    assert "Limit" not in plan(terms.agg(*_measures(terms)))


def test_few_terms_reach_the_posting_scan(spark, sf_dir):
    few = spark.createDataFrame([(1, "eau inin tion")], "query_id long, query string")
    assert "In(term" in plan(bm25(fx.index(spark, sf_dir), few))


@pytest.mark.parametrize("name", ["edges", "vertices", "link_rows"])
def test_graph_inputs_have_no_pairing_joins(spark, sf_dir, name):
    pages = fx.supplier_pages(spark, sf_dir)
    df = {"edges": gr.edges(pages), "vertices": gr.vertices(gr.edges(pages)), "link_rows": gr.link_rows(pages)}[name]
    assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)


def test_body_search_reads_stored_norms(spark, sf_dir):
    few = spark.createDataFrame([(1, "eau inin tion")], "query_id long, query string")
    text = plan(body(fx.index(spark, sf_dir), few))
    assert "/norms" in text and "/doc_terms" not in text
