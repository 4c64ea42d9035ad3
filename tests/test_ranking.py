import random

import pytest
from model import bm25 as model_bm25

from rankloom import schemas
from rankloom.operators import ranking as rk
from rankloom.operators import terms as tx
from rankloom.plans import search as sr
from rankloom.plans.build_index import Index, build_index

random.seed(5)
VOCABULARY = [f"word{i}" for i in range(30)]
DOCS = {i: " ".join(random.choices(VOCABULARY, weights=range(30, 0, -1), k=random.randint(1, 60))) for i in range(80)}
DOCS |= {90: "twin pair", 91: "twin pair", 92: "pair twin", 93: None, 94: "the of"}
QUERIES = {
    1: "word1 word2 word29",
    2: "word3 word3 word7",
    3: "unknown words here",
    4: "",
    5: "the of and",
    6: "twin",
    7: "pair unknown twin",
    8: None,
}


@pytest.fixture(scope="module")
def index(spark):
    return build_index(spark.createDataFrame(list(DOCS.items()), "doc_id long, text string"), min_df=0, buckets=4)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(list(QUERIES.items()), "query_id long, query string")


def by_query(results):
    found = {}
    for row in results.orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row.doc_id, row.score))
        assert row["rank"] == len(found[row.query_id])
    return found


def same(got, wanted):
    assert [doc for doc, _ in got] == [doc for doc, _ in wanted]
    assert [s for _, s in got] == pytest.approx([s for _, s in wanted])


def test_bm25_equals_the_model(index, queries):
    found = by_query(sr.bm25(index, queries))
    for query_id, text in QUERIES.items():
        same(found.get(query_id, []), model_bm25(DOCS, text or "", 10))


def test_classic_variant_and_stems(spark, index, queries):
    stems = spark.createDataFrame([("word29", "word1")], "term string, stem string")
    found = by_query(sr.bm25_classic(index, queries, stems))
    same(found[1], model_bm25(DOCS, "word1 word2 word1", 10, b=0.75))
    assert by_query(sr.bm25_classic(index, queries)) == by_query(sr.bm25(index, queries, b=0.75))


def test_rare_terms_are_not_searched(spark, queries):
    cut = build_index(spark.createDataFrame(list(DOCS.items()), "doc_id long, text string"), min_df=20, buckets=4)
    found = by_query(sr.bm25(cut, queries))
    for query_id, text in QUERIES.items():
        same(found.get(query_id, []), model_bm25(DOCS, text or "", 10, min_df=20))


def test_shuffled_and_split_join_equals_broadcast(index, queries):
    terms = tx.query_terms(queries)
    parts = (index.postings, index.term_stats, index.corpus_stats, terms)
    small = by_query(rk.best_first(rk.bm25_scores(*parts, small=True)))
    large = by_query(rk.best_first(rk.bm25_scores(*parts, small=False, min_hot_rows=0)))
    assert small.keys() == large.keys()
    for query_id in small:
        same(large[query_id], small[query_id])


@pytest.mark.parametrize("many_terms, broadcast_rows", [(0, 500_000), (1000, 500_000), (0, 0)])
def test_every_path_of_a_batch_gives_the_same(index, queries, monkeypatch, many_terms, broadcast_rows):
    monkeypatch.setattr("rankloom.plans.search.MANY_TERMS", many_terms)
    monkeypatch.setattr("rankloom.operators.skew.BROADCAST_ROWS", broadcast_rows)
    found = by_query(sr.bm25(index, queries))
    for query_id, text in QUERIES.items():
        same(found.get(query_id, []), model_bm25(DOCS, text or "", 10))
    bodies = by_query(sr.body(index, queries))
    assert bodies.keys() == found.keys()


def test_separate_lengths_skip_documents_without_one(index, queries):
    bare = Index(index.postings.drop("dl"), index.term_stats, index.doc_lengths.where("doc_id <> 90"), index.corpus_stats)
    found = by_query(sr.bm25(bare, queries))
    assert [doc for doc, _ in found[6]] == [91, 92]


def test_idf_of_unknown_terms(index, queries):
    terms = tx.query_terms(queries)
    known = {r.term: r for r in rk.with_idf(terms, index.term_stats, index.corpus_stats).collect()}
    zero = {r.term: r for r in rk.with_idf(terms, index.term_stats, index.corpus_stats, True).collect()}
    assert known["unknown"].df == zero["unknown"].df == 0
    assert known["unknown"].idf > known["word1"].idf > 0 == zero["unknown"].idf
    assert known["word1"].idf == zero["word1"].idf


def test_rerank_blends_and_keeps_text_order_in_ties(spark):
    candidates = spark.createDataFrame(
        [(1, 1, 10, 2.0), (1, 2, 11, 2.0), (1, 3, 12, 1.0)], "query_id long, rank int, doc_id long, score double"
    )
    ranks = spark.createDataFrame([(12, 9.0), (99, 50.0)], schemas.PAGERANK)
    found = by_query(rk.rerank(candidates, ranks, 2))
    same(found[1], [(12, 0.8 * 1.0 + 0.2 * 9.0), (10, 1.6)])


def test_search_has_titles_and_a_default(spark, index, queries):
    ranks = spark.createDataFrame([(92, 100.0)], schemas.PAGERANK)
    titles = spark.createDataFrame([(92, "Pair")], schemas.TITLES)
    rows = sr.search(index, queries, ranks, titles).where("query_id = 6").orderBy("rank").collect()
    assert [(r.doc_id, r.title) for r in rows] == [(92, "Pair"), (90, "UNKNOWN TITLE"), (91, "UNKNOWN TITLE")]


def test_empty_index_gives_no_results(spark, queries):
    empty = build_index(spark.createDataFrame([], "doc_id long, text string"), min_df=0, buckets=2)
    assert sr.bm25(empty, queries).count() == 0


@pytest.mark.parametrize("min_hot_rows", [None, 0])
def test_lookup_keeps_order_and_repeats(spark, min_hot_rows):
    requests = spark.createDataFrame([("a", [5, 1, 5]), ("b", []), ("c", [7])], "request_id string, ids array<long>")
    ranks = spark.createDataFrame([(5, 2.5), (7, 1.0)], schemas.PAGERANK)
    rows = rk.pagerank_of(requests, ranks, min_hot_rows).orderBy("request_id", "pos").collect()
    assert [(r.request_id, r.pos, r.id, r.value) for r in rows] == [
        ("a", 0, 5, 2.5), ("a", 1, 1, 0.0), ("a", 2, 5, 2.5), ("c", 0, 7, 1.0),
    ]
