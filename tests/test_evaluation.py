import pytest
from pyspark.sql import functions as F

from rankloom.functions.scoring import round3
from rankloom.operators import evaluation as ev

UP_TO = lambda n: list(range(n))
CASES = [
    ("precision", UP_TO(10), [1, 2, 3], 2, 1.0),
    ("recall", UP_TO(10), [10, 5, 3], 2, 0.1),
    ("precision", UP_TO(10), [], 2, 0.0),
    ("precision", [], [1, 2, 3], 5, 0.0),
    ("recall", [], [10, 5, 3], 2, 1.0),
    ("recall", UP_TO(10), [], 2, 0.0),
    ("f1", [], [1, 2, 3], 5, 0.0),
    ("f1", UP_TO(10), [], 2, 0.0),
    ("f1", UP_TO(10), [0, 1, 2], 2, 0.333),
    ("f1", UP_TO(50), UP_TO(5), 30, 0.182),
    ("f1", UP_TO(50), UP_TO(10), 30, 0.333),
    ("f1", UP_TO(50), UP_TO(30), 30, 0.75),
    ("quality", UP_TO(50), UP_TO(5), None, 0.308),
    ("quality", UP_TO(50), UP_TO(10), None, 0.5),
    ("quality", UP_TO(50), UP_TO(30), None, 0.857),
    ("quality", UP_TO(50), [-1] * 5 + list(range(5, 30)), None, 0.0),
]


def tables(spark, lists):
    """Queries, predictions and judgments from ``{query_id: (true ids, predicted ids)}``."""
    queries = spark.createDataFrame([(q,) for q in lists], "query_id long")
    predictions = spark.createDataFrame(
        [(q, i + 1, d) for q, (_, shown) in lists.items() for i, d in enumerate(shown)], "query_id long, rank int, doc_id long"
    )
    judgments = spark.createDataFrame([(q, d) for q, (true, _) in lists.items() for d in true], "query_id long, doc_id long")
    return queries, predictions, judgments


@pytest.mark.parametrize("metric, k", sorted({(c[0], c[3]) for c in CASES}, key=str))
def test_metric_cases(spark, metric, k):
    cases = {i: c for i, c in enumerate(CASES) if (c[0], c[3]) == (metric, k)}
    inputs = tables(spark, {i: (c[1], c[2]) for i, c in cases.items()})
    run = {
        "precision": ev.precision_at_k, "recall": ev.recall_at_k, "f1": ev.f1_at_k,
        "quality": lambda *args: ev.results_quality(*args[:3]),
    }[metric]
    got = {r[0]: r[1] for r in run(*inputs, k).collect()}
    assert got == {i: c[4] for i, c in cases.items()}


def test_average_precision(spark):
    lists = {1: ([1, 2, 9], [1, 5, 2]), 2: ([1], [4, 5]), 3: ([], [1]), 4: ([1], []), 5: ([50], list(range(60)))}
    got = {r[0]: r[1] for r in ev.average_precision(*tables(spark, lists)).collect()}
    assert got == {1: round((1 + 2 / 3) / 2, 3), 2: 0.0, 3: 0.0, 4: 0.0, 5: 0.0}


def test_summary_leaves_out_queries_without_results(spark):
    lists = {1: (UP_TO(50), UP_TO(10)), 2: (UP_TO(50), []), 3: (UP_TO(50), UP_TO(5))}
    evaluated = ev.evaluate(*tables(spark, lists))
    assert {r.query_id: (r.results, r.quality) for r in evaluated.collect()} == {1: (10, 0.5), 2: (0, None), 3: (5, 0.308)}
    assert tuple(ev.summary(evaluated).first()) == (3, 2, pytest.approx(0.404))


def test_rounding_equals_python(spark):
    fractions = [a / b for b in range(1, 161) for a in range(b + 1)] + [2 / (1 / a + 1 / b) for a in (0.1, 0.333, 0.077) for b in (0.2, 0.667, 0.013)]
    df = spark.createDataFrame([(x,) for x in fractions], "x double").select("x", round3(F.col("x")).alias("y"))
    assert [r for r in df.collect() if r.y != round(r.x, 3)] == []
