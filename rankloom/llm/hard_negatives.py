"""Hard negatives for anchor vectors, with bounds along a spanning tree of the anchors.

Anchors go through in blocks of a fixed number. A task ties the anchors of a block into a spanning
tree whose edges are short. The block is sent to all tasks, and each candidate is scored at the root; at
every other anchor its score lies within edge length times candidate norm of that at the parent. Only
candidates whose bounds overlap what is looked for are scored again: those that can reach the best positives of
an anchor, and after that those that can fall into a score window of one of them and be among its first
negatives. The others hand their bounds on to the next anchors.

Tasks keep the best few per anchor, so a label or a vector that a third of all rows have adds no rows
to the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.durable import materialize, scratch_path
from rankloom.llm.vectors import matrix, whole_vectors
from rankloom.operators.skew import top_k

# An entry c is taken as floor(256 * c); positives of an anchor, negatives of a positive,
# and the window of a negative's score in hundredths of the positive's.
FACTOR = 256
POSITIVES, NEGATIVES = 5, 10
LEAST, MOST = 30, 90

#: Entries are whole numbers below this after scaling, so products of up to 2048 entries fit 64 bits.
LIMIT = 1 << 26

#: Anchors that go through together, a vector and two numbers each.
BLOCK_ANCHORS = 1024

#: Candidates whose bounds for a block are held at a time.
BATCH = 1024


def _scores(x: np.ndarray, y: np.ndarray, exact_doubles: bool) -> np.ndarray:
    """Inner products of whole numbers: doubles where these are exact, else 64-bit integers."""
    if exact_doubles:
        return x.astype(float) @ y.T.astype(float)
    return x.astype(np.int64) @ y.T.astype(np.int64)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of visit, parent and edge length of a minimum spanning tree of the rows of ``x``.

    The first vector is the root; a parent comes before its children.
    """
    n = len(x)
    x = x.astype(float)
    squares = (x * x).sum(axis=1)

    def distances(i: int) -> np.ndarray:
        return np.sqrt(np.maximum(squares + squares[i] - 2 * (x @ x[i]), 0.0))

    order, parent, edge = [0], np.zeros(n, dtype=np.int64), distances(0)
    outside = np.ones(n, dtype=bool)
    outside[0] = False
    while outside.any():
        i = int(np.flatnonzero(outside)[edge[outside].argmin()])
        outside[i] = False
        order.append(i)
        away = distances(i)
        closer = outside & (away < edge)
        parent[closer], edge[closer] = i, away[closer]
    edge[0] = 0.0
    # Straight differences, without the cancellation of the products above.
    edge = np.linalg.norm(x - x[parent], axis=1)
    return np.array(order, dtype=np.int64), parent, edge


class Block:
    """Anchors of a block with their tree, and the bounds of a batch of candidates."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, order: np.ndarray, parent: np.ndarray, edge: np.ndarray):
        self.ids, self.labels, self.x, self.order, self.parent, self.edge = ids, labels, x, order, parent, edge

    def visit(self, x: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Anchor, candidates scored and their scores, for each anchor from the root on.

        ``wanted(anchor, low, high)`` tells which candidates can matter, from bounds of their scores.
        """
        most = max(int(np.abs(x).max(initial=0)), int(np.abs(self.x).max(initial=0)))
        doubles = most * most * x.shape[1] < 1 << 53
        plain = x.astype(float)
        # A little more than the norm covers the rounding of bounds.
        norms = np.sqrt((plain * plain).sum(axis=1)) * (1 + 1e-9)
        slack = 1e-9 * (norms.max(initial=0) + 1) * (np.abs(self.x).max(initial=0) + 1) * x.shape[1] + 1e-6
        low = np.empty((len(self.x), len(x)))
        high = np.empty((len(self.x), len(x)))
        for step, a in enumerate(self.order):
            if step:
                reach = self.edge[a] * norms + slack
                np.subtract(low[self.parent[a]], reach, out=low[a])
                np.add(high[self.parent[a]], reach, out=high[a])
                chosen = np.flatnonzero(wanted(a, low[a], high[a]))
            else:
                chosen = np.arange(len(x))
            if len(chosen):
                scores = _scores(x[chosen], self.x[a : a + 1], doubles)[:, 0]
                low[a, chosen] = high[a, chosen] = scores
                if not step:
                    keep = np.flatnonzero(wanted(a, low[a], high[a]))
                    chosen, scores = chosen[keep], scores[keep]
                yield a, chosen, scores.astype(np.int64)


class _Best:
    """The first ``k`` candidates by score and id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> float:
        """Score that a further candidate must reach."""
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of some ``BATCH`` candidates at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            part = batch.slice(start, BATCH)
            yield part.column("vec_id").to_numpy(), part.column("label").to_numpy(), matrix(part.column("x"))


def _positives(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """``(anchor, positive_id, positive_score)``: each task's best of the anchor's label."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in block.ids]
        for ids, labels, x in _parts(batches):

            def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                return (high >= best[a].least()) & (labels == block.labels[a]) & (ids != block.ids[a])

            for a, chosen, scores in block.visit(x, wanted):
                best[a].add(scores, ids[chosen])
        counts = [len(b.ids) for b in best]
        if sum(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(best), dtype=np.int32), counts)),
                 pa.array(np.concatenate([b.ids for b in best])), pa.array(np.concatenate([b.scores for b in best]))],
                ["anchor", "positive_id", "positive_score"],
            )

    return rows.mapInArrow(search, "anchor int, positive_id long, positive_score long")


def _negatives(rows: DataFrame, block: Block, positives: list[list[int]], k: int, least: int, most: int) -> DataFrame:
    """``(anchor, place, negative_id, negative_score)``: each task's first in the window of each positive."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[_Best(k) for _ in scores] for scores in positives]
        for ids, labels, x in _parts(batches):

            def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                found = np.zeros(len(ids), dtype=bool)
                for p, first in zip(positives[a], best[a]):
                    found |= (100 * low <= most * p) & (100 * high >= least * p) & (high >= first.least())
                return found & (labels != block.labels[a])

            for a, chosen, scores in block.visit(x, wanted):
                for p, first in zip(positives[a], best[a]):
                    inside = (least * p <= 100 * scores) & (100 * scores <= most * p)
                    first.add(scores[inside], ids[chosen[inside]])
        flat = [(a, place, b) for a, of in enumerate(best) for place, b in enumerate(of) if len(b.ids)]
        if flat:
            counts = [len(b.ids) for _, _, b in flat]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([a for a, _, _ in flat], dtype=np.int32), counts)),
                 pa.array(np.repeat(np.array([p for _, p, _ in flat], dtype=np.int32), counts)),
                 pa.array(np.concatenate([b.ids for _, _, b in flat])),
                 pa.array(np.concatenate([b.scores for _, _, b in flat]))],
                ["anchor", "place", "negative_id", "negative_score"],
            )

    return rows.mapInArrow(search, "anchor int, place int, negative_id long, negative_score long")


def _anchor_blocks(rows: DataFrame, anchors: str, block_anchors: int) -> tuple[DataFrame, int]:
    """Anchors with their block and the tree of the block, written once, and how many blocks there may be.

    A hash over an anchor and its place deals the anchors to blocks, repeated ones too, so that a block has some
    ``block_anchors`` of them whatever the number of partitions. A task makes the trees of its blocks one after the other.
    """
    chosen = rows.where(anchors).select("*", F.monotonically_increasing_id().alias("at"))
    blocks = max(1, -(-chosen.count() // block_anchors))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(table: pa.Table) -> pa.RecordBatch:
            block, ids, labels, x = (table.column(n).combine_chunks() for n in ("block", "vec_id", "label", "x"))
            order, parent, edge = spanning_tree(matrix(x))
            visited = np.empty(len(order), dtype=np.int64)
            visited[order] = np.arange(len(order))
            return pa.RecordBatch.from_arrays(
                [block, pa.array(np.arange(len(order))), ids, labels, x, pa.array(visited), pa.array(parent), pa.array(edge)],
                ["block", "anchor", "vec_id", "label", "x", "visit", "parent", "edge"],
            )

        held = None
        for batch in batches:
            own = pa.Table.from_batches([batch])
            held = own if held is None else pa.concat_tables([held, own])
            ends = np.flatnonzero(np.diff(held.column("block").to_numpy())) + 1
            for start, end in zip([0, *ends[:-1]], ends):
                yield done(held.slice(start, end - start))
            held = held.slice(ends[-1]) if len(ends) else held
        if held is not None and held.num_rows:
            yield done(held)

    block = F.pmod(F.xxhash64("vec_id", "at"), F.lit(blocks)).cast("long")
    dealt = chosen.withColumn("block", block).repartition(blocks, "block").sortWithinPartitions("block", "vec_id", "at")
    schema = "block long, anchor long, vec_id long, label long, x array<long>, visit long, parent long, edge double"
    return materialize(dealt.drop("at").mapInArrow(trees, schema), "anchors"), blocks


def hard_negatives(
    rows: DataFrame,
    anchors: str = "vec_id % 100 = 0",
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = (LEAST, MOST),
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` is a condition on ``vec_id`` and ``label``. Scores are whole inner products of the scaled
    vectors; the first come highest, ties by smaller id. An anchor's positives are its first rows of equal
    label and another id; the negatives of a positive are the first rows of other labels whose score lies in the window
    of ``window`` hundredths of the positive's. Anchors without positives and positives without negatives have no rows.

    Rows with a null id, label or vector, a null or non-finite entry, an entry of 2^26 or more after scaling, or a
    vector of another length than most take no part. Repeated rows count as many times as they are there; rows
    with the anchor's id are never its positives. Empty tables give no rows; other columns are ignored.

    All rows are read twice for every block of some ``block_anchors`` anchors. The driver holds one block, its
    trees and its positives at a time.
    """
    spark = rows.sparkSession
    chosen = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector")
    ).where("vec_id is not null and label is not null")
    all_rows = materialize(whole_vectors(chosen, "vector", FACTOR, 0, LIMIT), "candidates")
    trees, blocks = _anchor_blocks(all_rows, anchors, block_anchors)
    out = scratch_path(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(f"{out}/part=none")
    for number in range(blocks):
        one = trees.where(F.col("block") == number).toArrow().sort_by("anchor")
        if not one.num_rows:
            continue
        order = np.argsort(one.column("visit").to_numpy())
        plain = {n: one.column(n).to_numpy() for n in ("vec_id", "label", "parent", "edge")}
        block = Block(plain["vec_id"], plain["label"], matrix(one.column("x").combine_chunks()), order, plain["parent"], plain["edge"])
        first = [F.desc("positive_score"), F.asc("positive_id")]
        found = top_k(_positives(all_rows, block, positives), "anchor", first, positives, "place").toArrow().to_pylist()
        own: list[list[dict]] = [[] for _ in block.ids]
        for row in sorted(found, key=lambda r: (r["anchor"], r["place"])):
            own[row["anchor"]].append(row)
        scores = [[row["positive_score"] for row in of] for of in own]
        if not any(scores):
            continue
        # A row per anchor and positive of the block.
        named = spark.createDataFrame(
            [(a, place, int(block.ids[a]), row["positive_id"], row["positive_score"])
             for a, of in enumerate(own) for place, row in enumerate(of)],
            "anchor int, place int, anchor_id long, positive_id long, positive_score long",
        )
        hits = _negatives(all_rows, block, scores, negatives, *window)
        by_pair = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
        ranked = hits.withColumn("rank", F.row_number().over(by_pair)).where(F.col("rank") <= negatives)
        result = ranked.join(F.broadcast(named), ["anchor", "place"])
        result.select(*[name.split()[0] for name in schema.split(", ")]).write.parquet(f"{out}/part={number}")
    return spark.read.schema(schema).parquet(f"{out}/part=*")
