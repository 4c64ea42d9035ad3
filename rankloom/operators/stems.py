"""A stem table from the corpus itself: words that differ by a regular ending share a stem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.durable import Scratch, materialize

# Least characters of a stem, most characters of an ending, words in which an ending must be seen, and the share
# of the words with that ending that are words without it too.
MIN_STEM, MAX_ENDING = 4, 3
MIN_PAIRS, MIN_SHARE = 20, 0.5


def endings(terms: DataFrame, min_stem: int = MIN_STEM, max_ending: int = MAX_ENDING) -> DataFrame:
    """``(term, stem, ending)``: each word cut before its last one to ``max_ending`` characters."""
    cut = F.explode(F.sequence(F.lit(1), F.lit(max_ending))).alias("cut")
    return (
        terms.select("term", cut)
        .where(F.length("term") - F.col("cut") >= min_stem)
        .select("term", F.expr("left(term, length(term) - cut)").alias("stem"), F.expr("right(term, cut)").alias("ending"))
    )


def stem_table(
    term_stats: DataFrame,
    min_stem: int = MIN_STEM,
    max_ending: int = MAX_ENDING,
    min_pairs: int = MIN_PAIRS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """``(term, stem)`` for the words of ``term_stats (term)`` that are another word with a regular ending.

    An ending is regular when it is seen on ``min_pairs`` words that are words without it too, and these are
    at least ``min_share`` of all words that end so. A word hangs under the longest word that it extends
    regularly, and the root of such a chain is the stem of all in it, so the words of a stem are a connected component of
    the pairs. Chains are followed by doubling, so rounds grow with the logarithm of the longest one. Words are joined
    by themselves, which are unique, so no key is hot.
    """
    spark = term_stats.sparkSession
    terms = term_stats.select("term")
    with Scratch(spark) as scratch:
        cuts = endings(terms, min_stem, max_ending)
        known = terms.select(F.col("term").alias("stem"), F.lit(True).alias("known"))
        cuts = scratch.table(cuts.join(known, "stem", "left"), "endings")
        seen = cuts.groupBy("ending").agg(F.count("*").alias("words"), F.count("known").alias("pairs"))
        regular = seen.where((F.col("pairs") >= min_pairs) & (F.col("pairs") >= min_share * F.col("words")))
        pairs = cuts.where("known").join(regular.select("ending"), "ending")
        parents = scratch.table(pairs.groupBy("term").agg(F.max("stem").alias("stem")), "parents")
        while True:
            above = parents.select(F.col("term").alias("stem"), F.col("stem").alias("higher"))
            joined = parents.join(above, "stem", "left").select(
                "term", F.coalesce("higher", "stem").alias("stem"), F.col("higher").isNotNull().alias("moved")
            )
            moved = scratch.table(joined, "parents")
            if moved.where("moved").isEmpty():
                return materialize(moved.select("term", "stem"), "stems")
            parents = moved.select("term", "stem")
