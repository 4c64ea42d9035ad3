"""Blocks of documents and score bounds, so that a search reads only blocks that can reach its top k.

The documents of a segment are dealt to blocks of similar length. For each frequent term, ``impacts`` keep the
smallest length per term frequency in a block. A term's score in a document grows with its frequency and falls with the
length, whatever the statistics of the corpus and the parameters of the formula, so the largest
score of these rows is the largest in the block, also after the index has grown.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.durable import Scratch
from rankloom.functions.scoring import B, K1, bm25_term_score, idf
from rankloom.operators.ranking import indexed_terms
from rankloom.operators.skew import broadcast_if_small, top_k
from rankloom.sources.segments import BLOCK_BITS

#: Documents of a block, about; blocks of a query that are read first, to learn a score that the others must reach.
BLOCK_DOCS = 128
FIRST_BLOCKS = 16

#: Postings of a term in a segment from which its score bounds are stored.
IMPACT_ROWS = 20_000

#: Rows of a batch's terms in all documents from which bounds are used; fewer are read at once.
PRUNE_ROWS = 2_000_000

#: Blocks that are told to the scan as ranges, and how many ranges.
TOLD_BLOCKS, TOLD_RANGES = 20_000, 24

#: More than the rounding of scores, which are compared to 9 places.
_SLACK = 2e-9


def with_block(postings: DataFrame, segment: int, documents: int) -> DataFrame:
    """Add the ``block`` of each posting's document: documents of similar length, at random.

    A band has lengths up to some 1.4 times its least. A segment has no number of blocks in common with another one.
    """
    parts = max(1, documents // (BLOCK_DOCS * 8))
    band = F.floor(2 * F.log2(F.greatest(F.col("dl"), F.lit(1)).cast("double")))
    own = band * F.lit(parts) + F.pmod(F.xxhash64("doc_id"), F.lit(parts))
    return postings.withColumn("block", (F.lit(segment << BLOCK_BITS) + own).cast("long"))


def impacts(postings: DataFrame, frequent: DataFrame) -> DataFrame:
    """``(term, bucket, block, tf, dl)``: least length per frequency in each block, of the terms in ``frequent (term)``.

    Stored postings are sorted by term and block, so they fold where they are read, without a shuffle. A block that
    two batches of rows share has a row from each, which bounds it as well.
    """
    chosen = postings.join(broadcast_if_small(frequent.select("term")), "term", "left_semi")
    return chosen.select(*_IMPACT_COLUMNS).mapInArrow(_least_lengths, chosen.select(*_IMPACT_COLUMNS).schema)


_IMPACT_COLUMNS = ["term", "bucket", "block", "tf", "dl"]


def _least_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grouped = pa.Table.from_batches([batch]).group_by(_IMPACT_COLUMNS[:-1], use_threads=False)
        folded = grouped.aggregate([("dl", "min")]).select([*_IMPACT_COLUMNS[:-1], "dl_min"])
        yield from folded.rename_columns(_IMPACT_COLUMNS).to_batches()


def block_bounds(
    stored: DataFrame, postings: DataFrame, weighted: DataFrame, avgdl: Column, k1: float = K1, b: float = B
) -> DataFrame:
    """``(query_id, block, bound)``: the most that a document of the block can score for a query.

    ``weighted (query_id, term, bucket, weight)``. Terms without stored bounds in a segment bring their
    postings there, which are few.
    """
    segment = F.shiftright("block", BLOCK_BITS)
    asked = F.broadcast(weighted.select("term", "bucket").distinct())
    known = stored.join(asked, ["term", "bucket"]).select("term", "block", "tf", "dl")
    has = known.select("term", segment.alias("of")).distinct()
    rest = postings.join(asked, ["term", "bucket"]).withColumn("of", segment)
    rest = rest.join(F.broadcast(has), ["term", "of"], "left_anti").select("term", "block", "tf", "dl")
    most = (
        known.unionByName(rest)
        .groupBy("term", "block")
        .agg(F.max(bm25_term_score(F.col("tf"), F.col("dl"), avgdl, k1, b)).alias("most"))
    )
    return (
        most.join(F.broadcast(weighted.select("query_id", "term", "weight")), "term")
        .groupBy("query_id", "block")
        .agg(F.sum(F.col("weight") * F.col("most")).alias("bound"))
    )


def _block_ranges(blocks: list[int]) -> Column:
    """A condition on ``block`` of a few ranges that hold all the blocks, for the scan to skip the others."""
    blocks = sorted(blocks)
    gaps = sorted(range(1, len(blocks)), key=lambda i: blocks[i - 1] - blocks[i])[: TOLD_RANGES - 1]
    condition, start = F.lit(False), 0
    for end in [*sorted(gaps), len(blocks)]:
        condition |= F.col("block").between(blocks[start], blocks[end - 1])
        start = end
    return condition


def postings_in(postings: DataFrame, blocks: DataFrame, weighted: DataFrame) -> DataFrame:
    """Postings of the query terms in the chosen blocks of their query: ``(query_id, doc_id, tf, dl, weight, pos)``."""
    few = blocks.select("block").distinct().limit(TOLD_BLOCKS + 1).collect()
    if not few:
        postings = postings.where(F.lit(False))
    elif len(few) <= TOLD_BLOCKS:
        postings = postings.where(_block_ranges([row.block for row in few]))
    hits = postings.join(F.broadcast(weighted), ["term", "bucket"])
    chosen = blocks.select("query_id", "block")
    return hits.join(broadcast_if_small(chosen), ["query_id", "block"], "left_semi")


def _scores(hits: DataFrame, avgdl: Column, k1: float, b: float) -> DataFrame:
    part = F.col("weight") * bm25_term_score(F.col("tf"), F.col("dl"), avgdl, k1, b)
    return hits.groupBy("query_id", "doc_id").agg(F.sum(part).alias("score"), F.min("pos").alias("pos"))


def pruned_scores(
    stored: DataFrame,
    postings: DataFrame,
    term_stats: DataFrame,
    corpus_stats: DataFrame,
    query_term_rows: DataFrame,
    k: int,
    scratch: Scratch,
    k1: float = K1,
    b: float = B,
    first_blocks: int = FIRST_BLOCKS,
) -> tuple[DataFrame, DataFrame]:
    """Scores ``(query_id, doc_id, score, pos)`` that hold every query's best ``k``, and the blocks read for them.

    The blocks with the highest bounds are read first. The ``k``-th best score in them is one that the result
    reaches at least, so blocks whose bound is below it are left unread. For a batch of terms that fits a broadcast.
    """
    n, avgdl = corpus_stats.select("n").scalar(), corpus_stats.select("avgdl").scalar()
    weighted = (
        indexed_terms(query_term_rows, term_stats, True)
        .where("df > 0")
        .select("query_id", "term", "bucket", "pos", (F.col("qtf") * idf(n, F.col("df"))).alias("weight"))
    )
    weighted = scratch.table(weighted, "weights")
    bounds = scratch.table(block_bounds(stored, postings, weighted, avgdl, k1, b), "bounds")
    first = top_k(bounds, "query_id", [F.desc("bound"), F.asc("block")], first_blocks)
    seen = _scores(postings_in(postings, first, weighted), avgdl, k1, b)
    reached = (
        top_k(seen, "query_id", [F.desc("score"), F.asc("doc_id")], k)
        .where(F.col("rank") == k)
        .select("query_id", F.col("score").alias("least"))
    )
    reached = scratch.table(reached, "reached")
    # A query has one row there at most, and there are no more queries than terms.
    able = bounds.join(F.broadcast(reached), "query_id", "left").where(
        F.col("least").isNull() | (F.col("bound") * (1 + 1e-12) + _SLACK >= F.col("least"))
    )
    able = scratch.table(able.select("query_id", "block", "bound"), "blocks")
    return _scores(postings_in(postings, able, weighted), avgdl, k1, b), able
