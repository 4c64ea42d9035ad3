"""What building and reading an index may cost at a much larger scale, and that the results stay."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.operators import blocks as bl
from rankloom.operators import index as ix
from rankloom.operators import skew
from rankloom.operators import terms as tx
from rankloom.operators.matching import document_norms
from rankloom.plans import build_index as bi
from rankloom.plans.search import bm25
from rankloom.sources import artifacts


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, " ".join(["moon"] * (i % 3 + 1) + (["star"] if i % 2 else []) + [f"word{i}", f"pair{i // 2}"])) for i in range(64)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def indexed(texts):
    return bi.build_index(texts, min_df=0, buckets=5, doc_buckets=4, impact_rows=10)


def test_the_largest_rows_that_fit_a_broadcast(spark, monkeypatch):
    counts = spark.createDataFrame([(f"k{i}", n) for i, n in enumerate([1] * 9 + [2, 3, 4, 9, 8])], "term string, df long")
    assert skew.least_that_fits(counts, "df") == 1
    for rows, least in ((13, 2), (5, 2), (4, 4), (2, 8), (1, None)):
        monkeypatch.setattr(skew, "BROADCAST_ROWS", rows)
        assert skew.least_that_fits(counts, "df") == least
    assert skew.least_that_fits(counts.where("df < 0"), "df") == 1


def test_norms_of_a_large_vocabulary_shuffle_facts_of_rare_terms_only(indexed, monkeypatch):
    inputs = tx.term_facts(indexed.doc_terms), indexed.term_stats, indexed.corpus_stats
    norms = lambda: {r.doc_id: r.norm for r in document_norms(*inputs).collect()}
    whole = norms()
    for rows in (2, 40, 0):
        monkeypatch.setattr(skew, "BROADCAST_ROWS", rows)
        assert norms() == pytest.approx(whole)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 40)
    text = plan(document_norms(*inputs))
    assert "LeftAnti" in text and text.count("Join type: Inner") >= 2


def test_cuts_of_an_index_read_the_same_tables(spark, sf_dir):
    whole, cut = fx.index(spark, sf_dir, 0), fx.index(spark, sf_dir)
    assert whole.path == cut.path and cut.norms is not None
    built = bi.build_index(fx.documents(spark, sf_dir), min_df=0)
    rows = lambda df: sorted(map(tuple, df.collect()))
    for name in ("term_stats", "doc_lengths", "corpus_stats"):
        assert rows(getattr(whole, name)) == rows(getattr(built, name))
    assert rows(whole.postings.select("term", "doc_id", "tf")) == rows(built.postings.select("term", "doc_id", "tf"))
    assert rows(cut.term_stats) == rows(ix.frequent_terms(built.term_stats))


def test_statistics_deal_postings_without_a_pass_for_ranges(spark, tmp_path):
    hot = spark.range(6_000).selectExpr("'hot' as term", "id as doc_id", "1L as tf", "9L as dl", "id % 40 as block")
    others = spark.range(12_000).selectExpr("concat('t', id % 90) as term", "id as doc_id", "1L as tf", "9L as dl", "id % 40 as block")
    facts = hot.union(others)
    stats = ix.term_statistics(facts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = artifacts._dealt(ix.with_bucket(facts, 5), stats, 5, 300)
        assert "rangepartitioning" not in plan(dealt)
        artifacts.save_postings(facts, f"{tmp_path}/dealt", 5, term_stats=stats, part_rows=300)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    saved = spark.read.parquet(f"{tmp_path}/dealt")
    names = ["term", "doc_id", "tf", "dl", "block"]
    assert saved.count() == 18_000 and saved.select(names).exceptAll(facts.select(names)).isEmpty()
    placed = saved.withColumn("task", F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1))
    assert placed.groupBy("task").count().agg(F.max("count")).first()[0] < 3 * 18_000 / 8
    assert placed.where("term = 'hot'").select("task").distinct().count() >= 3
    assert placed.groupBy("term", "block").agg(F.count_distinct("task").alias("n")).where("n > 1").isEmpty()


def test_score_bounds_fold_without_a_shuffle_and_leave_rare_terms_to_the_postings(spark, indexed, monkeypatch):
    frequent = indexed.term_stats.where("df >= 10")
    bounds = bl.impacts(indexed.by_term, frequent)
    assert "Exchange hash" not in plan(bounds) and "Exchange range" not in plan(bounds)
    least = indexed.by_term.join(frequent.select("term"), "term").groupBy("term", "bucket", "block", "tf").agg(F.min("dl"))
    folded = bounds.groupBy("term", "bucket", "block", "tf").agg(F.min("dl"))
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, least.collect()))
    queries = spark.createDataFrame([(1, "moon star"), (2, "star word3"), (3, "pair9 moon")], "query_id long, query string")
    order = lambda df: [(r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in df.orderBy("query_id", "rank").collect()]
    wanted = order(bm25(indexed, queries))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 20)
    few = bi.bound_index(indexed, 1)
    assert few.impacts.select("term").distinct().count() == 2 and indexed.version.impact_rows == 10
    monkeypatch.undo()
    assert order(bm25(few, queries, prune_rows=0)) == wanted


def test_texts_move_to_their_buckets_before_they_are_counted(spark, texts):
    counted = bi._counted(texts, 4, ())
    text = plan(counted)
    details = text[text.index("\n\n"):]
    assert text.count("Exchange") and details.index("REPARTITION_BY_NUM") < details.index("regexp_extract_all")
    assert counted.rdd.getNumPartitions() == 4


def test_buckets_of_frequent_terms_are_looked_up(spark, monkeypatch):
    facts = spark.createDataFrame([(f"w{i % (i % 9 + 1)}", i, 1, 1) for i in range(300)], "term string, doc_id long, tf long, dl long")
    stats = ix.term_statistics(facts)
    rows = lambda df: sorted((r.term, r.doc_id, r.bucket) for r in df.collect())
    computed = rows(ix.with_bucket(facts, 5))
    for given in (stats, ix.with_bucket(stats, 5), stats.withColumn("df", -F.col("df"))):
        assert rows(artifacts._looked_up(facts, given, 5, 20)) == computed
    assert "BroadcastHashJoin" in plan(artifacts._looked_up(facts, stats, 5, 20))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    assert rows(artifacts._looked_up(facts, stats, 5, 20)) == computed


def test_no_hot_keys_cost_no_job_and_no_join(spark):
    counts = spark.range(5).select(F.col("id").cast("string").alias("term"), F.lit(3).cast("long").alias("df"))
    none = skew.hot_keys(counts, "term", "df")
    assert none.count() == 0 and "ExistingRDD" not in plan(none)
    joined = counts.join(F.broadcast(none), "term", "left")
    assert "Join" not in plan(joined) and joined.where("splits is null").count() == 5


def test_posting_lists_are_sorted_without_a_lambda(spark):
    rows = [("moon", i * 7 % 40, i + 1) for i in range(40)] + [("star", 3, 1)]
    lists = ix.posting_lists(spark.createDataFrame(rows, "term string, doc_id long, tf long"), block_ids=16)
    assert "lambda" not in plan(lists)
    found = {(r.term, r.block): [(p.doc_id, p.tf) for p in r.postings] for r in lists.collect()}
    blocks = {(t, d // 16) for t, d, _ in rows}
    assert found == {(t, b): sorted((d, f) for u, d, f in rows if u == t and d // 16 == b) for t, b in blocks}


def test_documents_with_all_terms_are_found_by_document(spark, indexed):
    terms = spark.createDataFrame([(1, "moon"), (1, "star"), (2, "word7"), (3, "moon"), (3, "nowhere")], "query_id long, term string")
    found = fx.documents_with_all(indexed, terms)
    text = plan(found)
    assert "/doc_terms" in text and "/postings" not in text
    assert not [line for line in text.splitlines() if "hashpartitioning(" in line and "doc_id" in line]
    assert sorted(map(tuple, found.collect())) == [(1, i) for i in range(1, 64, 2)] + [(2, 7)]
