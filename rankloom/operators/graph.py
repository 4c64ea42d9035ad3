"""Link graph operators: edges, vertices, PageRank and its normalization."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.durable import Scratch, materialize
from rankloom.operators.skew import hot_keys

# Reset probability and number of rounds.
RESET = 0.15
ROUNDS = 6

# Bounds on the links of one bucket, where the session's number of partitions allows a choice.
FEWEST_LINKS = 50_000
MOST_LINKS = 10_000_000


def link_rows(pages: DataFrame, page_id: str = "id", links: str = "anchor_text") -> DataFrame:
    """``(src, dst)``: one row per link; pages with null links and links without id have none."""
    return (
        pages.select(F.col(page_id).alias("src"), F.explode(F.col(f"{links}.id")).alias("dst"))
        .where("src is not null and dst is not null")
    )


def edges(pages: DataFrame, page_id: str = "id", links: str = "anchor_text") -> DataFrame:
    """Distinct ``(src, dst)``; a page's links to itself stay.

    Repeats within a page are dropped before the shuffle.
    """
    own = pages.withColumn("_targets", F.array_distinct(F.col(f"{links}.id")))
    return (
        own.select(F.col(page_id).alias("src"), F.explode("_targets").alias("dst"))
        .where("src is not null and dst is not null")
        .distinct()
    )


def vertices(edge_rows: DataFrame) -> DataFrame:
    """``(id)``: every endpoint once, so link targets outside the corpus count too."""
    return edge_rows.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def pagerank(
    edge_rows: DataFrame,
    reset: float = RESET,
    rounds: int = ROUNDS,
    rescale: bool = True,
    partitions: int | None = None,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """``(id, pagerank)`` after a fixed number of rounds from rank 1.0 everywhere.

    A round is ``reset + (1 - reset) * sum of rank / out-degree over in-links``; vertices without
    out-links pass nothing on. With ``rescale`` the ranks sum to the number of vertices.

    Only in-link sums move. A vertex without in-links always has rank ``reset``, so a round needs
    no vertex table: the edges, bucketed by source once, look up their source's last sum and add
    up by target, with partial sums before that one shuffle. Edges of the few sources that hold
    more than their share of all edges would fill one bucket; they stay spread and look up their
    sums by a broadcast of those sources, whose number is bounded. Each round is written out, so
    neither the plan nor the loss of an executor grows with the rounds; only the ranks are left.
    """
    if rounds < 1:
        return vertices(edge_rows).withColumn("pagerank", F.lit(1.0))
    with Scratch(edge_rows.sparkSession) as scratch:
        ranks = _ranks(edge_rows, reset, rounds, partitions, min_hot_rows, scratch)
    if not rescale:
        return ranks
    scale = ranks.agg((F.count("*") / F.sum("pagerank")).alias("scale")).scalar()
    return ranks.select("id", (F.col("pagerank") * scale).alias("pagerank"))


def _ranks(
    edge_rows: DataFrame, reset: float, rounds: int, partitions: int | None, min_hot_rows: int | None, scratch: Scratch
) -> DataFrame:
    """Ranks before rescaling, written out."""
    spark = edge_rows.sparkSession
    links = scratch.table(edge_rows.select("src", "dst"), "edges")
    out_degree = scratch.table(links.groupBy("src").agg(F.count("*").alias("degree")), "out-degree")
    hot = scratch.table(hot_keys(out_degree, "src", "degree", min_hot_rows).select("src"), "hot-sources")
    spread = None
    cold, cold_degree = links, out_degree
    if not hot.isEmpty():
        hot_degree = out_degree.join(F.broadcast(hot), "src", "left_semi")
        spread = scratch.table(links.join(F.broadcast(hot_degree), "src"), "edges-hot")
        cold, cold_degree = (rows.join(F.broadcast(hot), "src", "left_anti") for rows in (links, out_degree))
    by_source = _bucketed_by_source(cold.join(cold_degree, "src"), partitions or _buckets_for(links), scratch)
    cold = spark.table(by_source)

    def rank_of(total: Column) -> Column:
        return F.lit(reset) + F.lit(1.0 - reset) * F.coalesce(total, F.lit(0.0))

    def next_sums(sums: DataFrame | None) -> DataFrame:
        """``(id, total)``: in-link sums after one more round; all ranks are 1.0 before the first."""
        if sums is None:
            share = (F.lit(1.0) / F.col("degree")).alias("share")
            shares = cold.select("dst", share)
            if spread is not None:
                shares = shares.unionByName(spread.select("dst", share))
        else:
            share = (rank_of(F.col("total")) / F.col("degree")).alias("share")
            sums = sums.withColumnRenamed("id", "src")
            shares = cold.join(sums, "src", "left").select("dst", share)
            if spread is not None:
                hot_sums = sums.join(F.broadcast(hot), "src", "left_semi")
                shares = shares.unionByName(spread.join(F.broadcast(hot_sums), "src", "left").select("dst", share))
        return shares.groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("total"))

    try:
        sums = None
        for turn in range(1, rounds + 1):
            sums = scratch.table(next_sums(sums), f"rank-{turn}")

        nodes = out_degree.select(F.col("src").alias("id"))
        # Every target has a sum, so sources without one complete the vertices.
        return materialize(
            nodes.join(sums, "id", "full").select("id", rank_of(F.col("total")).alias("pagerank")), "ranks"
        )
    finally:
        spark.sql(f"drop table {by_source}")


def _buckets_for(links: DataFrame) -> int:
    """Shuffle partitions of the session, but fewer for few links and more for very many."""
    rows = links.count()
    usual = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // MOST_LINKS), min(usual, -(-rows // FEWEST_LINKS)))


def _bucketed_by_source(links: DataFrame, buckets: int, scratch: Scratch) -> str:
    """Write links bucketed by source, so that no later round shuffles them; gives the table name.

    Dropping the table leaves its files, which go with the scratch.
    """
    table = f"rankloom_edges_{uuid.uuid4().hex}"
    (
        links.repartition(buckets, "src")
        .write.format("parquet")
        .bucketBy(buckets, "src")
        .sortBy("src")
        .option("path", scratch.path("edges-by-source"))
        .saveAsTable(table)
    )
    return table


def highest_first(ranks: DataFrame) -> DataFrame:
    """Ranks in descending order, by a range shuffle over all tasks."""
    return ranks.select("id", "pagerank").orderBy(F.desc("pagerank"), "id")


def normalized(ranks: DataFrame, method: str = "minmax") -> DataFrame:
    """PageRank brought to a scale fit for blending: ``minmax``, ``max``, ``sum`` or ``none``."""
    value = F.col("pagerank")
    if method == "none":
        return ranks.select("id", "pagerank")
    if method == "sum":
        scaled = value / ranks.agg(F.sum("pagerank").alias("total")).scalar()
    elif method == "max":
        scaled = value / ranks.agg(F.max("pagerank").alias("top")).scalar()
    elif method == "minmax":
        top = ranks.agg(F.max("pagerank").alias("top")).scalar()
        low = ranks.agg(F.min("pagerank").alias("low")).scalar()
        scaled = F.when(top > low, (value - low) / (top - low)).otherwise(F.lit(0.0))
    else:
        raise ValueError(f"unknown normalization: {method}")
    return ranks.select("id", scaled.alias("pagerank"))
