import math

import pytest
from model import kept
from collections import Counter

from rankloom import schemas
from rankloom.operators import matching as mt
from rankloom.operators import terms as tx
from rankloom.plans.build_index import build_index


def queries(spark, *texts):
    return tx.query_terms(spark.createDataFrame(list(enumerate(texts)), "query_id long, query string"))


@pytest.mark.parametrize("small", [True, False])
def test_body_search_is_a_cosine(spark, small, monkeypatch):
    if not small:
        monkeypatch.setattr("rankloom.operators.skew.BROADCAST_ROWS", 0)
    docs = {1: "moon sun moon", 2: "moon star", 3: "sun sun", 4: "star dust dust", 5: "all"}
    index = build_index(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), min_df=0, buckets=2)
    terms = queries(spark, "moon moon sun unknown", "nothing", "dust")
    counts = {d: Counter(kept(t)) for d, t in docs.items()}
    counts = {d: c for d, c in counts.items() if c}
    df = Counter(t for c in counts.values() for t in c)
    weigh = lambda c: {t: n * math.log(len(counts) / df[t]) for t, n in c.items() if t in df}
    norm = lambda w: math.sqrt(sum(x * x for x in w.values()))
    wanted = {}
    for q, text in ((0, "moon moon sun"), (2, "dust")):
        qw = weigh(Counter(kept(text)))
        for d, c in counts.items():
            dot = sum(x * weigh(c).get(t, 0) for t, x in qw.items())
            if dot:
                wanted[(q, d)] = dot / norm(qw) / norm(weigh(c))
    found = mt.body_search(
        index.postings, index.term_stats, index.corpus_stats, terms, small=small, min_hot_rows=None if small else 0
    ).collect()
    assert {(r.query_id, r.doc_id): r.score for r in found} == pytest.approx(wanted)
    best = [r for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 0]
    assert [r.score for r in best] == pytest.approx(sorted((s for (q, _), s in wanted.items() if q == 0), reverse=True))
    top = mt.body_search(index.postings, index.term_stats, index.corpus_stats, terms, k=1).collect()
    assert len(top) == 2


@pytest.mark.parametrize("small", [True, False])
def test_title_search_counts_distinct_words(spark, small):
    titles = spark.createDataFrame([(1, "Moon moon moon"), (2, "Sun and Moon"), (3, "Star")], schemas.TITLES)
    found = mt.title_search(titles, queries(spark, "moon sun sun", "planet"), small=small, min_hot_rows=0)
    assert [tuple(r) for r in found.collect()] == [(0, 2, "Sun and Moon", 2), (0, 1, "Moon moon moon", 1)]


@pytest.mark.parametrize("small", [True, False])
def test_anchor_search_ranks_targets(spark, small):
    pages = spark.createDataFrame(
        [(1, None, None, [(7, "bright moon"), (8, "moon"), (None, "moon")]), (2, None, None, [(7, "moon sun")]), (3, None, None, None)],
        schemas.CORPUS,
    )
    found = mt.anchor_search(mt.anchor_rows(pages), queries(spark, "sun moon"), small=small, min_hot_rows=0)
    assert [tuple(r) for r in found.collect()] == [(0, 7, 2), (0, 8, 1)]


def test_page_views_of_a_month(spark):
    views = spark.createDataFrame(
        [(1, "2021-08-01 00:00:00"), (1, "2021-08-31 23:59:59"), (1, "2021-09-01 00:00:00"), (2, "2021-07-31 23:59:59")],
        "id long, at string",
    ).selectExpr("id", "timestamp(at) as ts")
    monthly = mt.page_views(views, "2021-08")
    requests = spark.createDataFrame([(0, [2, 1, 1])], "request_id long, ids array<long>")
    assert [r.value for r in mt.page_views_of(requests, monthly).orderBy("pos").collect()] == [0, 2, 2]
    assert [r.value for r in mt.page_views_of(requests, mt.page_views(views, "2021-12")).collect()] == [0, 0, 0]
