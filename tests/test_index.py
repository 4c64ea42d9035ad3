import tempfile

import pytest
from pyspark.sql import functions as F

from rankloom import schemas
from rankloom.operators import index as ix
from rankloom.operators import terms as tx
from rankloom.plans.build_index import add_documents, build_index, load_index, save_index
from rankloom.plans.search import bm25
from rankloom.sources import artifacts, corpus
from rankloom.sources.judgments import judgment_table, query_table, read_judgments

DOCS = [(1, "moon sun moon"), (2, "moon star"), (3, "sun"), (4, "the of"), (5, None)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


@pytest.fixture(scope="module")
def folder():
    return tempfile.mkdtemp(prefix="index-test-")


def test_build_save_and_load(spark, docs, folder):
    built = build_index(docs, f"{folder}/index", min_df=1, buckets=3)
    for index in (built, load_index(spark, f"{folder}/index")):
        assert rows(index.term_stats.select("term", "df", "term_total")) == [("moon", 2, 3), ("sun", 2, 2)]
        assert rows(index.postings.select("term", "doc_id", "tf", "dl")) == [
            ("moon", 1, 2, 3), ("moon", 2, 1, 2), ("sun", 1, 1, 3), ("sun", 3, 1, 1),
        ]
        assert rows(index.doc_lengths) == [(1, 3), (2, 2), (3, 1)]
        assert rows(index.corpus_stats) == [(3, 2.0)]
    assert rows(ix.postings_of(built.postings, "moon", 3)) == [(1, 2), (2, 1)]
    assert rows(ix.postings_of(built.postings, "nowhere", 3)) == []


def test_missing_index_is_empty(spark, folder):
    index = load_index(spark, f"{folder}/none")
    assert index.postings.count() == index.corpus_stats.count() == 0
    assert index.postings.columns == schemas.POSTINGS.names


def test_load_of_an_existing_table(spark, folder):
    spark.range(3).write.mode("overwrite").parquet(f"{folder}/table")
    assert artifacts.load_or_empty(spark, f"{folder}/table", spark.range(0).schema).count() == 3


def test_rare_term_cut_is_strict(spark):
    facts = spark.range(51).selectExpr("'often' as term", "id as doc_id", "1L as tf").union(
        spark.range(50).selectExpr("'rare' as term", "id as doc_id", "1L as tf")
    )
    stats = ix.term_statistics(facts)
    assert rows(ix.frequent_terms(stats).select("term")) == [("often",)]
    assert ix.keep_frequent(facts, stats).count() == 51


def test_hot_terms_are_split_without_loss(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    facts = tx.term_counts(docs)
    stats = ix.term_statistics(facts)
    plain = ix.keep_frequent(facts, stats, 3).select("term", "doc_id", "tf")
    monkeypatch.setattr("rankloom.operators.skew.BROADCAST_ROWS", 0)
    split = ix.keep_frequent(facts, stats, 3, min_hot_rows=0).select("term", "doc_id", "tf")
    assert plain.count() == split.count() > 0
    assert plain.exceptAll(split).count() == 0


def test_invariants(spark, sf_dir):
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), min_df=0)
    total = index.postings.agg(F.sum("tf")).first()[0]
    assert total == index.doc_lengths.agg(F.sum("dl")).first()[0] == index.term_stats.agg(F.sum("term_total")).first()[0]
    assert rows(ix.term_statistics(index.postings)) == rows(index.term_stats.select("term", "df", "term_total"))
    assert rows(ix.doc_lengths(index.postings)) == rows(index.doc_lengths)
    assert rows(ix.bucket_sizes(index.term_stats).agg(F.sum("terms"))) == [(index.term_stats.count(),)]


def test_posting_lists_come_in_sorted_blocks(spark):
    postings = spark.createDataFrame([("moon", d, 1) for d in (7, 3, 12, 25, 0)], "term string, doc_id long, tf long")
    lists = ix.posting_lists(postings, block_ids=10).orderBy("block").collect()
    assert [(r.block, [p.doc_id for p in r.postings]) for r in lists] == [(0, [0, 3, 7]), (1, [12]), (2, [25])]


def test_add_documents_equals_one_build(spark, docs):
    whole = build_index(docs, min_df=0)
    grown = add_documents(build_index(docs.where("doc_id <= 2"), min_df=0), docs.where("doc_id > 2"))
    assert rows(grown.term_stats.select("term", "df", "term_total")) == rows(whole.term_stats.select("term", "df", "term_total"))
    assert rows(grown.postings.select("term", "doc_id", "tf", "dl")) == rows(whole.postings.select("term", "doc_id", "tf", "dl"))
    assert rows(grown.doc_lengths) == rows(whole.doc_lengths)
    assert rows(grown.corpus_stats) == rows(whole.corpus_stats)


@pytest.mark.parametrize("min_df", [0, 1, 2, 5])
def test_a_grown_index_equals_one_build_at_every_cut(spark, sf_dir, folder, min_df):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    whole = build_index(docs, min_df=min_df, buckets=8)
    grown = save_index(
        add_documents(build_index(docs.where("doc_id % 3 = 0"), min_df=min_df, buckets=8), docs.where("doc_id % 3 <> 0")),
        f"{folder}/grown-{min_df}",
    )
    for name in ("term_stats", "postings", "doc_lengths", "corpus_stats"):
        of = getattr(whole, name)
        assert rows(getattr(grown, name).select(of.columns)) == rows(of)


def test_a_query_has_the_same_results_alone_and_in_a_batch(spark):
    old = spark.createDataFrame([(i, "rare moon" if i < 3 else f"moon filler{i}") for i in range(8)], "doc_id long, text string")
    new = spark.createDataFrame([(i, "rare sun") for i in range(8, 12)], "doc_id long, text string")
    grown = add_documents(build_index(old, min_df=5), new)
    alone = spark.createDataFrame([(1, "rare")], "query_id long, query string")
    batch = spark.createDataFrame([(1, "rare"), (2, " ".join(f"word{i}" for i in range(200)))], "query_id long, query string")
    found = rows(bm25(grown, alone))
    assert len(found) == 7 and rows(bm25(grown, batch).where("query_id = 1")) == found


def test_rows_of_one_id_are_one_document(spark):
    docs = spark.createDataFrame([(1, "moon moon sun"), (1, "moon star"), (2, "sun")], "doc_id long, text string")
    index = build_index(docs, min_df=0)
    assert rows(index.doc_lengths) == [(1, 5), (2, 1)]
    assert rows(index.postings.select("term", "doc_id", "tf", "dl")) == [
        ("moon", 1, 3, 5), ("star", 1, 1, 5), ("sun", 1, 1, 5), ("sun", 2, 1, 1)
    ]
    assert rows(index.corpus_stats) == [(2, 3.0)]


def test_lengths_longest_first(spark, docs):
    assert [r.dl for r in ix.longest_first(ix.doc_lengths(tx.term_counts(docs))).collect()] == [3, 2, 1]


def test_csv_sinks(spark, folder):
    titles = spark.createDataFrame([(1, 'a "quoted", title '), (2, "two\nlines")], schemas.TITLES)
    for _ in range(2):
        artifacts.save_titles(titles, f"{folder}/titles")
    assert rows(artifacts.load_csv(spark, f"{folder}/titles", schemas.TITLES)) == rows(titles)
    ranks = spark.createDataFrame([(1, 0.5), (2, 1.25)], schemas.PAGERANK)
    artifacts.save_pagerank(ranks, f"{folder}/pr")
    assert rows(artifacts.load_csv(spark, f"{folder}/pr", schemas.PAGERANK)) == rows(ranks)
    with pytest.raises(Exception, match="already exists"):
        artifacts.save_pagerank(ranks, f"{folder}/pr")
    lengths = spark.createDataFrame([(1, 5), (2, 9)], schemas.DOC_LENGTHS)
    artifacts.save_lengths(lengths, f"{folder}/dl")
    assert [r.doc_id for r in artifacts.load_csv(spark, f"{folder}/dl", schemas.DOC_LENGTHS).collect()] == [2, 1]


def test_corpus_source_skips_other_files(spark, folder):
    pages = spark.createDataFrame(
        [(1, "One", "moon", [(2, "two")]), (2, None, "sun", None)], schemas.CORPUS
    )
    pages.write.mode("overwrite").parquet(f"{folder}/corpus")
    with open(f"{folder}/corpus/setup.sh", "w") as script:
        script.write("not a table")
    read = corpus.read_corpus(spark, f"{folder}/corpus")
    assert corpus.page_count(read).first().pages == 2
    assert rows(corpus.texts(read)) == [(1, "moon"), (2, "sun")]
    assert rows(corpus.titles(read)) == [(1, "One")]
    assert corpus.links(read).columns == ["id", "anchor_text"]


def test_judgments_source(spark, folder):
    with open(f"{folder}/judged.json", "w") as file:
        file.write('{"moon rocks": ["12", "7"], "no answer": []}')
    judged = read_judgments(spark, f"{folder}/judged.json")
    assert rows(query_table(judged)) == [("moon rocks", "moon rocks"), ("no answer", "no answer")]
    assert rows(judgment_table(judged)) == [("moon rocks", 7), ("moon rocks", 12)]


def test_a_hot_term_is_stored_by_several_tasks(spark, folder):
    rows_of_hot = spark.range(60_000).selectExpr("'hot' as term", "id as doc_id", "1L as tf", "9L as dl")
    others = spark.range(120_000).selectExpr("concat('t', id % 900) as term", "id as doc_id", "1L as tf", "9L as dl")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        artifacts.save_postings(rows_of_hot.union(others), f"{folder}/skewed", 10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    saved = spark.read.parquet(f"{folder}/skewed")
    assert saved.count() == 180_000
    sizes = saved.groupBy(F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1).alias("task")).count()
    assert sizes.agg(F.max("count")).first()[0] < 2 * 180_000 / 8
    assert saved.where("term = 'hot'").select(F.input_file_name()).distinct().count() >= 3
