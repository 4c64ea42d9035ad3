"""Connected components of a link table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.durable import Scratch, materialize
from rankloom.llm.splits import split_join, split_keys
from rankloom.operators.skew import fits_broadcast


def connected_components(links: DataFrame, kept: Scratch | None = None) -> DataFrame:
    """``(node, component)`` for the nodes of ``links (a, b)``; component is the smallest node.

    The result is a written table, in ``kept`` if given.

    A round hangs every neighbour of a node under the smallest one, first the larger neighbours, then
    the smaller. The number of links never grows, and the rounds needed grow with the logarithm of
    the longest path. Every round is written, so a lost executor costs part of one round. The links of a
    node with very many of them stay spread over the tasks: all they need is the smallest neighbour, which is found by
    partial aggregation, and broadcast or joined by split keys. Links of a node with itself and
    repeated links do no harm; no links give no rows.
    """
    with Scratch(links.sparkSession) as scratch:
        edges = scratch.table(_ordered(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
        while not _all_stars(edges):
            edges = scratch.table(_small_star(_large_star(edges, scratch), scratch), "links")
        roots = edges.select(F.col("v").alias("node")).distinct()
        found = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
            roots.select("node", F.col("node").alias("component"))
        )
        return kept.table(found, "components") if kept else materialize(found, "components")


def _ordered(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node hangs under a single one, which itself hangs under none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    by_node = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return by_node.where("hangs > 1 or hangs + holds > 1").isEmpty()


def _with_smallest(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """Add ``m``, the smallest neighbour of ``u``, from a written table ``(u, m, n)`` with the number of links."""
    if fits_broadcast(smallest):
        return edges.join(F.broadcast(smallest.drop("n")), "u")
    return split_join(edges, smallest.drop("n"), "u", split_keys(smallest, "u", "n"), ["v"])


def _large_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
    hung = _with_smallest(both, scratch.table(smallest, "smallest"))
    return scratch.table(hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")


def _small_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Links come from the larger to the smaller node; repeated ones fold into the result."""
    smallest = scratch.table(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "smallest")
    moved = _with_smallest(edges, smallest).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _ordered(moved.unionByName(smallest.select("u", F.col("m").alias("v"))))
