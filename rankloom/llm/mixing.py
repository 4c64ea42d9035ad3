"""Mixing sources to target weights by distributed prefix sums over hash-random keys.

Every document has a hash key, which is a random but repeatable order. The key space is cut into
ranges; as keys are even, so are the ranges, without sampling. Sizes are summed per source and
range, and prefix sums over the ranges of a source tell in which range its budget ends. That makes one
row per source: a document in an earlier range is taken, one in a later range is not, and only rows of
the range itself are sorted, one range per source. So a source with a third of all rows is as wide as its
ranges, and the texts themselves are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.durable import materialize
from rankloom.operators.skew import fits_broadcast, hot_keys, salted_join

# Words, weights by the order of the sources, share of all words to take, and how
# often a document may be taken.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2

#: Key ranges of a source: the first three hexadecimal digits of the key.
RANGE_DIGITS = 3


def _size() -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    """Add the hash ``key``, its ``part``, and ``of``, the source as a name that is never null."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    of = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    return docs.withColumn("key", key).withColumn("part", F.substring("key", 1, RANGE_DIGITS)).withColumn("of", of)


def _placed(sources: DataFrame) -> DataFrame:
    """Add ``place``, the number of each source from 0 in the order of names, null last; written.

    Names are sorted in ranges, so a table of very many sources (hosts, say) goes through no single task; what
    the driver adds up is the number of names in each range.
    """
    by_name = F.col("source").asc_nulls_last()
    ranged = sources.repartitionByRange(by_name).sortWithinPartitions(by_name)
    found = materialize(ranged.withColumn("at", F.monotonically_increasing_id()), "sources")
    # The number of the range stands above the lower 33 bits, the place in the range in them.
    ranges = found.groupBy(F.shiftrightunsigned("at", 33).alias("range")).count().collect()
    before, total = {}, 0
    for row in sorted(ranges):
        before[row["range"]], total = total, total + row["count"]
    if not before:
        return found.withColumn("place", F.col("at")).drop("at")
    ahead = F.element_at(F.create_map(*[F.lit(v).cast("long") for pair in before.items() for v in pair]), F.shiftrightunsigned("at", 33))
    return found.withColumn("place", ahead + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at")


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """``(source, source_size, target)`` from one row ``(source, source_size)`` per source.

    Weights go by the order of the sources, null last. A target stops at ``epochs`` times its source;
    what is over goes to the others by weight. The level of the others, a target per weight, rises with every source
    that stops, so it is raised until no further one stops; each time is one sum over the sources.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rated = _placed(sources).withColumn("weight", weight).withColumn("most", F.lit(float(epochs)) * F.col("source_size"))
    level = 0.0
    while True:
        stops = F.col("most") <= F.col("weight") * F.lit(level)
        sums = rated.agg(
            F.sum("source_size").alias("size"),
            F.sum(F.when(stops, F.col("most")).otherwise(0.0)).alias("stopped"),
            F.sum(F.when(stops, 0.0).otherwise(F.col("weight"))).alias("others"),
        ).first()
        if not sums.others:
            break
        above = (share * sums.size - sums.stopped) / sums.others
        if above <= level:
            break
        level = above
    target = F.when(stops, F.col("most")).otherwise(F.col("weight") * F.lit(level))
    return rated.select("source", "source_size", target.alias("target"))


def _decisions(sizes: DataFrame, **mix) -> DataFrame:
    """``(of, source_size, target, rounds, rest, cut, before, n)``: one row for each source, written.

    ``rounds`` is how often the whole source is taken, ``rest`` how many words of a last round, ``cut``
    the range in which these end (null where they take all), ``before`` how many words lie in earlier ranges,
    and ``n`` how many rows the source has.
    """
    ranges = materialize(
        sizes.groupBy("of", "source", "part").agg(F.sum("size").alias("here"), F.count("*").alias("rows")), "ranges"
    )
    targets = source_targets(ranges.groupBy("source").agg(F.sum("here").alias("source_size")), **mix)
    targets = targets.select(F.col("source").alias("name"), "source_size", "target")
    in_order = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.round("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    placed = (
        ranges.withColumn("before", F.coalesce(F.sum("here").over(in_order), F.lit(0)))
        .join(targets, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("rounds", rounds)
        .withColumn("rest", budget - F.col("rounds") * F.col("source_size"))
    )
    # The first range that is not taken whole; all before it are, none behind it.
    end = F.min(F.when(F.col("before") + F.col("here") > F.col("rest"), F.struct("part", "before")))
    by_source = placed.groupBy("of", "source_size", "target", "rounds", "rest").agg(end.alias("end"), F.sum("rows").alias("n"))
    return materialize(
        by_source.select("of", "source_size", "target", "rounds", "rest", F.col("end.part").alias("cut"), "end.before", "n"),
        "decisions",
    )


def _taken(rows: DataFrame, decisions: DataFrame, size: Column) -> DataFrame:
    """Add the row of each source, ``size``, and ``extra``, the words of the last round."""
    told = decisions.drop("n")
    if fits_broadcast(told):
        found = rows.join(F.broadcast(told), "of")
    else:
        found = salted_join(rows, told, "of", hot_keys(decisions, "of", "n"), ["key"])
    across = F.coalesce(F.col("part") == F.col("cut"), F.lit(False))
    earlier = F.coalesce(F.col("part") < F.col("cut"), F.lit(True))
    settled = found.where(~across).withColumn("size", size).withColumn(
        "extra", F.when(earlier, F.col("size")).otherwise(F.lit(0)).cast("long")
    )
    in_range = Window.partitionBy("of").orderBy("key", F.col("doc_id"), "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(in_range), F.lit(0))
    last = found.where(across).withColumn("size", size)
    return settled.unionByName(last.withColumn("extra", F.least(F.greatest(left, F.lit(0)), F.col("size"))))


def mixture(docs: DataFrame, **mix) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs (doc_id, text, source)``.

    ``taken`` counts words, repeats included. The taken words of a source are its target rounded to
    a whole word: the document across the budget gives its first words only, and no document is
    taken more than ``epochs`` times.

    A null or blank text has size 0 and is never taken; a source without words has target 0. A null
    source is a source of its own, a null doc_id an id like others. Repeated rows are rows of their own: which of
    two that agree in id and size is cut does not show. Empty tables give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string"))
    sizes = materialize(_keyed(rows).withColumn("size", _size()).drop("text"), "sizes")
    taken = F.col("rounds") * F.col("size") + F.col("extra")
    return _taken(sizes, _decisions(sizes, **mix), F.col("size")).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed(docs: DataFrame, **mix) -> DataFrame:
    """The mixture itself: all columns of ``docs``, one row for each time a document is taken.

    Adds ``round`` (from 1) and ``words``, the words taken in that round; where ``docs`` has a column of that name, the
    added one gets a number behind its name. The text of a document that the budget cuts ends with its last taken word.
    Documents that are not taken, null and blank texts among them, are left out. Repeated rows are taken each on its
    own; empty tables give no rows.
    """
    names = docs.columns
    added = [_free_name(name, names) for name in ("round", "words")]
    at = {name: f"c{names.index(name)}" for name in ("doc_id", "text", "source")}
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumns(
        {name: F.col(column) for name, column in at.items()}
    )
    rows = _keyed(rows)
    # Sizes are counted again behind the join, where each row is in one of two parts only.
    sizes = rows.select("of", "source", "part", _size().alias("size"))
    found = _taken(rows, _decisions(sizes, **mix), _size())
    again = F.col("rounds").cast("int") + F.when(F.col("extra") > 0, 1).otherwise(0)
    found = found.where((F.col("size") > 0) & (again > 0)).withColumn("round", F.explode(F.sequence(F.lit(1), again)))
    whole = (F.col("round") <= F.col("rounds")) | (F.col("extra") == F.col("size"))
    words = F.when(whole, F.col("size")).otherwise(F.col("extra"))
    text = F.when(whole, F.col("text")).otherwise(_first_words(F.col("text"), F.col("extra")))
    return found.withColumn("words", words).withColumn(at["text"], text).select(
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(names)],
        *[F.col(name).alias(free) for name, free in zip(("round", "words"), added)],
    )


def _free_name(name: str, names: list[str]) -> str:
    """``name``, or the first of ``name_2``, ``name_3``, ... that no column has; case does not tell columns apart."""
    taken, free, number = {n.lower() for n in names}, name, 1
    while free in taken:
        number += 1
        free = f"{name}_{number}"
    return free


def _first_words(text: Column, count: Column) -> Column:
    """A text up to its ``count``-th word."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), count.cast("int")), "")
