"""Stems from the corpus, the store of page views, and judgments as JSON."""

import os

from rankloom.catalog import fixtures as fx
from rankloom.catalog import jobs
from rankloom.operators import terms as tx
from rankloom.operators.stems import stem_table
from rankloom.sources import views
from rankloom.sources.judgments import judgment_table, query_table, read_judgments, save_judgments


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_words_with_regular_endings_share_a_stem(spark):
    words = ["walk", "walks", "walked", "walker", "walkers", "talk", "talks", "talked", "bass", "thing", "things", "red", "reds", "xyzw"]
    table = spark.createDataFrame([(w,) for w in words], "term string")
    found = dict(rows(stem_table(table, min_pairs=2, min_share=0.5)))
    # -er is seen once, -s under a stem of three letters does not count.
    assert found == {"walks": "walk", "walked": "walk", "walkers": "walker", "talks": "talk", "talked": "talk", "things": "thing"}
    assert dict(rows(stem_table(table, min_pairs=1, min_share=0.5)))["walkers"] == "walk"
    assert stem_table(table.limit(0)).count() == 0


def test_stems_change_the_terms_of_the_queries(spark, sf_dir):
    terms = tx.query_terms(fx.benchmark_queries(spark, sf_dir))
    mapped = jobs.mapped_terms(spark, sf_dir)
    assert terms.select("query_id", "term").exceptAll(mapped.select("query_id", "term")).count() >= 100


def test_late_views_change_only_their_month(spark, tmp_path):
    path = f"{tmp_path}/views"

    def add(*found):
        table = spark.createDataFrame(list(found), "id long, at string").selectExpr("id", "timestamp(at) as ts")
        return views.add_views(spark, path, table)

    assert add((1, "2024-01-31 23:59:59"), (1, "2024-01-01 00:00:00"), (2, "2024-02-01 00:00:00"), (None, "2024-02-01 00:00:00"), (3, None)) == ["2024-01", "2024-02"]
    january = {f: os.path.getmtime(f"{path}/month=2024-01/{f}") for f in os.listdir(f"{path}/month=2024-01")}
    assert add((2, "2024-02-29 12:00:00"), (5, "2024-03-01 00:00:00")) == ["2024-02", "2024-03"]
    assert january == {f: os.path.getmtime(f"{path}/month=2024-01/{f}") for f in os.listdir(f"{path}/month=2024-01")}
    assert add() == []
    assert rows(views.month_views(spark, path, "2024-01")) == [(1, 2)]
    assert rows(views.month_views(spark, path, "2024-02")) == [(2, 2)]
    assert rows(views.month_views(spark, path, "2023-12")) == []
    scan = views.month_views(spark, path, "2024-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in scan


def test_judgments_round_trip(spark, tmp_path):
    judged = spark.createDataFrame(
        [('moon "rocks"\n', 12), ('moon "rocks"\n', 7), ("no answer", None), ("é", 3)], "query string, doc_id long"
    )
    for parts in (1, 4):
        save_judgments(judged, f"{tmp_path}/judged", parts)
        read = read_judgments(spark, f"{tmp_path}/judged")
        assert rows(query_table(read).select("query")) == [('moon "rocks"\n',), ("no answer",), ("é",)]
        assert rows(judgment_table(read)) == [('moon "rocks"\n', 7), ('moon "rocks"\n', 12), ("é", 3)]
