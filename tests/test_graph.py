import random

import pytest
from model import pagerank as model_pagerank
from pyspark.sql import functions as F

from rankloom import schemas
from rankloom.operators import graph as gr

EDGES = [(1, 2), (1, 3), (2, 3), (3, 1), (3, 4), (5, 3), (5, 5), (6, 1)]
# Measured with Spark's own graph library.
RANKS = {1: 1.3543367459, 2: 0.8755255928, 3: 1.8928676100, 4: 1.1226087326, 5: 0.4820401265, 6: 0.2726211921}


def frame(spark, edges):
    return spark.createDataFrame(edges, "src long, dst long")


def ranks_of(df):
    return {r.id: r.pagerank for r in df.collect()}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(
        [
            (1, "a", "", [(2, "two"), (2, "again"), (1, "self"), (None, "lost")]),
            (2, "b", "", None),
            (3, "c", "", []),
            (4, "d", "", [(99, "outside")]),
        ],
        schemas.CORPUS,
    )


def test_edges_and_vertices(pages):
    found = gr.edges(pages)
    assert sorted(map(tuple, found.collect())) == [(1, 1), (1, 2), (4, 99)]
    assert sorted(r.id for r in gr.vertices(found).collect()) == [1, 2, 4, 99]
    assert gr.link_rows(pages).count() == 4


@pytest.mark.parametrize("min_hot_rows", [None, 0])
def test_pagerank_of_six_vertices(spark, min_hot_rows):
    got = ranks_of(gr.pagerank(frame(spark, EDGES), partitions=3, min_hot_rows=min_hot_rows))
    assert got == pytest.approx(RANKS, abs=1e-9)


def test_pagerank_with_some_hot_sources(spark, monkeypatch):
    random.seed(3)
    edges = {(random.randrange(60), random.randrange(60)) for _ in range(250)} | {(0, d) for d in range(60)} | {(d, 1) for d in range(60)}
    monkeypatch.setattr("rankloom.operators.skew.HOT_KEYS", 20)
    wanted = model_pagerank(list(edges))
    assert ranks_of(gr.pagerank(frame(spark, list(edges)), min_hot_rows=0)) == pytest.approx(wanted, abs=1e-9)
    assert ranks_of(gr.pagerank(frame(spark, list(edges)))) == pytest.approx(wanted, abs=1e-9)


def test_only_the_ranks_are_left_in_the_scratch_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("rankloom.durable.scratch_root", lambda _: str(tmp_path))
    ranks = gr.pagerank(frame(spark, EDGES), min_hot_rows=0)
    left = [p.name for app in tmp_path.iterdir() for p in app.iterdir()]
    assert len(left) == 1 and left[0].startswith("ranks-")
    assert ranks_of(ranks) == pytest.approx(RANKS, abs=1e-9)
    monkeypatch.setattr(gr, "_buckets_for", lambda links: 1 // 0)
    with pytest.raises(ZeroDivisionError):
        gr.pagerank(frame(spark, EDGES))
    assert [p.name for app in tmp_path.iterdir() for p in app.iterdir()] == left


def test_rounds_and_rescaling(spark):
    raw = gr.pagerank(frame(spark, EDGES), rounds=2, rescale=False)
    assert ranks_of(raw) == pytest.approx(model_pagerank(EDGES, 2, rescale=False))
    assert ranks_of(gr.pagerank(frame(spark, EDGES), rounds=0)) == dict.fromkeys(range(1, 7), 1.0)
    scaled = gr.pagerank(frame(spark, EDGES), rounds=1, reset=0.5)
    assert ranks_of(scaled) == pytest.approx(model_pagerank(EDGES, 1, 0.5))


def test_empty_graph(spark):
    assert gr.pagerank(frame(spark, [])).count() == 0


def test_order_and_normalization(spark):
    ranks = spark.createDataFrame([(1, 1.0), (2, 5.0), (3, 3.0)], schemas.PAGERANK)
    assert [r.id for r in gr.highest_first(ranks).collect()] == [2, 3, 1]
    assert ranks_of(gr.normalized(ranks)) == {1: 0.0, 2: 1.0, 3: 0.5}
    assert ranks_of(gr.normalized(ranks, "max")) == {1: 0.2, 2: 1.0, 3: 0.6}
    assert ranks_of(gr.normalized(ranks, "sum")) == pytest.approx({1: 1 / 9, 2: 5 / 9, 3: 3 / 9})
    assert ranks_of(gr.normalized(ranks, "none")) == {1: 1.0, 2: 5.0, 3: 3.0}
    assert ranks_of(gr.normalized(ranks.withColumn("pagerank", F.lit(2.0)))) == {1: 0.0, 2: 0.0, 3: 0.0}
    with pytest.raises(ValueError):
        gr.normalized(ranks, "other")
