"""An index of segments: growth, publishing, buckets by document and score bounds of blocks."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from rankloom.durable import Scratch
from rankloom.operators import blocks as bl
from rankloom.operators import index as ix
from rankloom.operators import terms as tx
from rankloom.plans import build_index as bi
from rankloom.plans.search import bm25, body
from rankloom.sources import segments as sg
from rankloom.streaming.ingest import add_batch, index_stream

FIELDS = ("term_stats", "postings", "doc_lengths", "corpus_stats")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same(one, other):
    for name in FIELDS:
        columns = [c for c in getattr(other, name).columns if c != "block"]
        assert rows(getattr(one, name).select(columns)) == rows(getattr(other, name).select(columns)), name


def files(folder):
    return {os.path.join(at, f) for at, _, names in os.walk(folder) for f in names}


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="segments-test-")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def indexed(documents):
    return bi.build_index(documents, min_df=0, buckets=8, impact_rows=10)


@pytest.fixture(scope="module")
def batch(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr("item_id as query_id", "text as query")


def exchanges(df):
    """Keys of the plan's shuffles."""
    return re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition)(\([^)]*\))?", plan(df))


def test_sums_by_query_and_document_need_no_shuffle(indexed, batch):
    keys = exchanges(bm25(indexed, batch))
    assert any("query_id" in k for _, k in keys) and not any("doc_id" in k for _, k in keys)
    keys = exchanges(body(indexed, batch))
    assert not any("doc_id" in k for _, k in keys)


def test_body_search_of_few_terms_has_one_shuffle_by_document(spark, indexed):
    few = spark.createDataFrame([(1, "eau inin tion")], "query_id long, query string")
    keys = [k for _, k in exchanges(body(indexed, few)) if "doc_id" in k]
    assert len(keys) == 1 and "query_id" not in keys[0]


def test_storing_postings_of_any_vocabulary_joins_nothing(indexed, monkeypatch):
    monkeypatch.setattr("rankloom.operators.skew.BROADCAST_ROWS", 0)
    text = plan(bl.with_block(tx.term_facts(indexed.doc_terms), 0, 200))
    assert "Exchange" not in text and "Join" not in text


def test_a_grown_index_writes_only_the_new_rows(spark, documents, folder, batch):
    first = bi.build_index(documents.where("doc_id % 4 <> 0"), folder, min_df=2, buckets=8)
    before = {f: os.path.getmtime(f) for f in files(folder)}
    grown = bi.add_documents(first, documents.where("doc_id % 4 = 0"))
    written = files(folder) - set(before)
    assert rows(bi.load_index(spark, folder).corpus_stats) == rows(first.corpus_stats)
    name = grown.version.segments[-1].name
    assert written and all(f"segment={name}" in f for f in written)
    published = bi.save_index(grown)
    new = files(folder) - set(before) - written
    assert new and all("/versions/" in f for f in new)
    assert all(os.path.getmtime(f) == at for f, at in before.items())
    whole = bi.build_index(documents, min_df=2, buckets=8)
    same(published, whole)
    assert rows(bm25(published, batch).select("query_id", "rank", "doc_id")) == rows(bm25(whole, batch).select("query_id", "rank", "doc_id"))
    assert published.norms is None and bi.save_norms(published).norms is not None
    for index in (published, bi.load_index(spark, folder)):
        got = rows(body(index, batch).select("query_id", "rank", "doc_id"))
        assert got == rows(body(whole, batch).select("query_id", "rank", "doc_id"))


def test_more_text_of_a_known_document_adds_to_it(spark, folder):
    parts = [[(1, "moon sun"), (2, "star")], [(1, "moon dust"), (3, "sun"), (1, "rock")], [(2, None), (4, "the of")], [(1, "sun sun"), (3, "sun")]]
    schema = "doc_id long, text string"
    index = bi.build_index(spark.createDataFrame(parts[0], schema), folder, min_df=0, buckets=3, doc_buckets=2)
    for part in parts[1:]:
        index = bi.save_index(bi.add_documents(index, spark.createDataFrame(part, schema)))
    whole = bi.build_index(spark.createDataFrame(sum(parts, []), schema), min_df=0, buckets=3, doc_buckets=2)
    same(index, whole)
    assert len(index.version.segments) == 4 and sum(s.gone for s in index.version.segments) == 4
    kept = bi.compact_index(index, keep=1)
    same(kept, whole)
    assert [s.name for s in kept.version.segments][0] == index.version.segments[0].name and len(kept.version.segments) == 2
    one = bi.compact_index(kept)
    same(one, whole)
    assert len(one.version.segments) == 1 and one.norms is not None
    sg.remove_unused(spark, folder)
    same(bi.load_index(spark, folder), whole)
    assert all(one.version.segments[0].name in f or "/versions/" in f or "/norms/" in f for f in files(folder))


@pytest.mark.parametrize("broken", ["save_postings", "_write_norms"])
def test_a_build_that_fails_leaves_the_old_index(spark, folder, monkeypatch, broken):
    schema = "doc_id long, text string"
    old = bi.build_index(spark.createDataFrame([(1, "moon sun")], schema), folder, min_df=0, buckets=3)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(bi, broken, fail)
        with pytest.raises(RuntimeError, match="lost"):
            bi.build_index(spark.createDataFrame([(1, "star"), (2, "dust")], schema), folder, min_df=0, buckets=3)
    same(bi.load_index(spark, folder), old)
    new = bi.build_index(spark.createDataFrame([(7, "dust")], schema), folder, min_df=0, buckets=3)
    assert rows(new.doc_lengths) == rows(bi.load_index(spark, folder).doc_lengths) == [(7, 1)]
    # A reader that loaded the old version still has it.
    assert rows(old.doc_lengths) == [(1, 2)] == rows(bi.load_index(spark, folder, old.version.number).doc_lengths)


def test_two_writers_cannot_publish_the_same_version(spark, folder):
    docs = spark.createDataFrame([(1, "moon")], "doc_id long, text string")
    index = bi.build_index(docs, folder, min_df=0, buckets=2)
    one, two = bi.add_documents(index, docs), bi.add_documents(index, docs)
    bi.save_index(one)
    with pytest.raises(Exception, match="already exists"):
        bi.save_index(two)


def test_stream_equals_one_build_for_repeated_ids(spark, folder):
    docs = [[(1, "moon sun"), (1, "moon"), (2, "star")], [(1, "dust star"), (3, None)], [(2, "star moon"), (4, "sun")]]
    for part in docs:
        spark.createDataFrame(part, "doc_id long, text string").coalesce(1).write.mode("append").parquet(f"{folder}/source")
    source = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/source")
    for _ in range(2):
        writer = index_stream(source, f"{folder}/index", buckets=3, doc_buckets=2, compact_segments=2)
        run = writer.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        run.awaitTermination(240)
    whole = bi.build_index(spark.createDataFrame(sum(docs, []), "doc_id long, text string"), min_df=0, buckets=3, doc_buckets=2)
    found = bi.load_index(spark, f"{folder}/index")
    same(found, whole)
    # Every version that was published holds documents with their statistics.
    for number in range(found.version.number + 1):
        index = bi.load_index(spark, f"{folder}/index", number)
        assert rows(ix.term_statistics(index.postings)) == rows(index.term_stats.select("term", "df", "term_total"))
        assert index.corpus_stats.first().n == index.doc_lengths.count()


def test_a_batch_that_runs_again_counts_once(spark, folder):
    docs = spark.createDataFrame([(1, "moon sun")], "doc_id long, text string")
    for _ in range(2):
        add_batch(docs, 0, folder, buckets=2, doc_buckets=1)
    found = bi.load_index(spark, folder)
    assert found.version.source == "batch 0" and rows(found.term_stats.select("term", "df")) == [("moon", 1), ("sun", 1)]
    add_batch(docs, 1, folder, buckets=2, doc_buckets=1)
    assert rows(bi.load_index(spark, folder).term_stats.select("term", "df", "term_total")) == [("moon", 1, 2), ("sun", 1, 2)]


def test_bounds_hold_and_spare_postings(spark, indexed):
    words = [r.term for r in indexed.term_stats.orderBy(F.desc("df"), "term").limit(9).collect()]
    queries = spark.createDataFrame([(i, f"{words[i]} {words[2 * i]}") for i in range(5)] + [(9, "nowhere")], "query_id long, query string")
    plain, pruned = bm25(indexed, queries, k=3), bm25(indexed, queries, k=3, prune_rows=0)
    order = lambda df: [(r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in df.orderBy("query_id", "rank").collect()]
    assert order(plain) == order(pruned) and len(order(plain)) == 15
    one = spark.createDataFrame([(1, words[0])], "query_id long, query string")
    terms = tx.query_terms(one)
    with Scratch(spark) as scratch:
        scores, able = bl.pruned_scores(
            indexed.impacts, indexed.by_term, indexed.term_stats, indexed.corpus_stats, terms, 3, scratch, first_blocks=4
        )
        df = indexed.term_stats.where(F.col("term") == words[0]).first().df
        read = indexed.by_term.where(F.col("term") == words[0]).join(able, "block", "left_semi").count()
        assert 3 <= scores.count() == read < df / 2


def test_bounds_of_a_grown_index(spark, documents, batch):
    grown = bi.add_documents(bi.build_index(documents.where("doc_id % 2 = 0"), min_df=0, buckets=8, impact_rows=10), documents.where("doc_id % 2 = 1"))
    words = [r.term for r in grown.term_stats.orderBy(F.desc("df"), "term").limit(4).collect()]
    queries = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "query_id long, query string")
    order = lambda df: [(r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in df.orderBy("query_id", "rank").collect()]
    assert order(bm25(grown, queries)) == order(bm25(grown, queries, prune_rows=0))


def test_ranges_hold_all_blocks(spark):
    blocks = [3 * i * i for i in range(100)]
    kept = spark.range(30_000).withColumnRenamed("id", "block").where(bl._block_ranges(blocks))
    found = {r.block for r in kept.collect()}
    assert set(blocks) <= found and len(found) < 30_000 * 0.9
