"""Quality metrics of ranked results against relevance judgments.

Inputs: ``queries (query_id)``, ``predictions (query_id, rank, doc_id)`` with ranks from 1, and
``judgments (query_id, doc_id)``. Every metric has one row per query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.scoring import harmonic_mean, round3

# Cuts of average precision, of precision and of F1 in the quality figure.
AP_CUT = 40
PRECISION_CUT = 5
F1_CUT = 30


def _judged(predictions: DataFrame, judgments: DataFrame) -> DataFrame:
    relevant = judgments.select("query_id", "doc_id").distinct().withColumn("hit", F.lit(1))
    return predictions.select("query_id", "rank", "doc_id").join(relevant, ["query_id", "doc_id"], "left")


def _counts(queries: DataFrame, predictions: DataFrame, judgments: DataFrame, *cuts: int) -> DataFrame:
    """Per query: results and hits within each cut, number of results and of relevant documents."""
    sums = [F.count("*").alias("results")]
    for k in cuts:
        within = F.col("rank") <= k
        sums += [
            F.count_if(within).alias(f"shown_{k}"),
            F.count_if(within & F.col("hit").isNotNull()).alias(f"hits_{k}"),
        ]
    per_query = _judged(predictions, judgments).groupBy("query_id").agg(*sums)
    relevant = judgments.select("query_id", "doc_id").distinct().groupBy("query_id").agg(F.count("*").alias("relevant"))
    return (
        queries.select("query_id")
        .join(per_query, "query_id", "left")
        .join(relevant, "query_id", "left")
        .na.fill(0)
    )


def _precision(k: int) -> Column:
    shown = F.col(f"shown_{k}")
    return F.when(shown == 0, F.lit(0.0)).otherwise(round3(F.col(f"hits_{k}") / shown))


def _recall(k: int) -> Column:
    relevant = F.col("relevant")
    return F.when(relevant == 0, F.lit(1.0)).otherwise(round3(F.col(f"hits_{k}") / relevant))


def precision_at_k(queries: DataFrame, predictions: DataFrame, judgments: DataFrame, k: int) -> DataFrame:
    """Share of the first ``k`` results, or of those there are, that is relevant; none gives 0.0."""
    return _counts(queries, predictions, judgments, k).select("query_id", _precision(k).alias("precision"))


def recall_at_k(queries: DataFrame, predictions: DataFrame, judgments: DataFrame, k: int) -> DataFrame:
    """Share of the relevant documents among the first ``k``; nothing relevant gives 1.0."""
    return _counts(queries, predictions, judgments, k).select("query_id", _recall(k).alias("recall"))


def f1_at_k(queries: DataFrame, predictions: DataFrame, judgments: DataFrame, k: int) -> DataFrame:
    """Harmonic mean of the rounded precision and recall."""
    return (
        _counts(queries, predictions, judgments, k)
        .select("query_id", _precision(k).alias("precision"), _recall(k).alias("recall"))
        .select("query_id", harmonic_mean(F.col("precision"), F.col("recall")).alias("f1"))
    )


def precision_recall_f1(queries: DataFrame, predictions: DataFrame, judgments: DataFrame, k: int) -> DataFrame:
    """``(query_id, precision, recall, f1)``: the three metrics from one pass of counts."""
    return (
        _counts(queries, predictions, judgments, k)
        .select("query_id", _precision(k).alias("precision"), _recall(k).alias("recall"))
        .withColumn("f1", harmonic_mean(F.col("precision"), F.col("recall")))
    )


def average_precision(queries: DataFrame, predictions: DataFrame, judgments: DataFrame, k: int = AP_CUT) -> DataFrame:
    """Mean over the hits among the first ``k`` of the precision down to each; no hit gives 0.0."""
    so_far = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    hits = (
        _judged(predictions.where(F.col("rank") <= k), judgments)
        .withColumn("precision", F.count("hit").over(so_far) / F.col("rank"))
        .where("hit is not null")
        .groupBy("query_id")
        .agg(F.avg("precision").alias("mean"))
    )
    return queries.select("query_id").join(hits, "query_id", "left").select(
        "query_id", F.coalesce(round3(F.col("mean")), F.lit(0.0)).alias("average_precision")
    )


def results_quality(queries: DataFrame, predictions: DataFrame, judgments: DataFrame) -> DataFrame:
    """Harmonic mean of precision at 5 and F1 at 30, each rounded first."""
    return _quality(queries, predictions, judgments).select("query_id", "quality")


def evaluate(queries: DataFrame, predictions: DataFrame, judgments: DataFrame) -> DataFrame:
    """``(query_id, results, quality)``; a query without results has no quality."""
    return _quality(queries, predictions, judgments).select(
        "query_id", "results", F.when(F.col("results") > 0, F.col("quality")).alias("quality")
    )


def _quality(queries: DataFrame, predictions: DataFrame, judgments: DataFrame) -> DataFrame:
    return (
        _counts(queries, predictions, judgments, PRECISION_CUT, F1_CUT)
        .select(
            "query_id",
            "results",
            _precision(PRECISION_CUT).alias("at_5"),
            _precision(F1_CUT).alias("precision"),
            _recall(F1_CUT).alias("recall"),
        )
        .withColumn("f1", harmonic_mean(F.col("precision"), F.col("recall")))
        .select("query_id", "results", harmonic_mean(F.col("at_5"), F.col("f1")).alias("quality"))
    )


def summary(evaluated: DataFrame) -> DataFrame:
    """``(processed, successful, average_quality)``: one row, averaged over queries with results."""
    return evaluated.agg(
        F.count("*").alias("processed"),
        F.count("quality").alias("successful"),
        F.avg("quality").alias("average_quality"),
    )
