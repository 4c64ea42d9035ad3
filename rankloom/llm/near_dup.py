"""Near-duplicate groups from an inverted join on MinHash signature coordinates.

A document is its set of distinct 5-word shingles. Documents with equal sets are one class, and only
classes go on. A class has one signature of ``COORDINATES`` minima and is posted under its
coordinate-value pairs. Two classes with at least ``MATCHES`` equal coordinates are found by

* prefix: with the pairs of a class ordered from rare to common over the whole corpus, two classes
  with enough matches must share a pair among their first ``COORDINATES - MATCHES + 1``; only these
  are posted, so pairs that half the corpus shares are seldom posted at all;
* merge: the collisions of a candidate pair are counted on the signatures packed to 4 bits per
  coordinate, inside the join (a packed count is never below the true one);
* skip: in turns each posting list is compared with one member only, its head, and a class
  is confirmed with its best heads, until a turn links hardly any classes. Classes that are connected by then
  need no further comparison, so the last pass compares across components only, with a prefix filter on the full
  sets that is exact. A group of copies costs its size, not its square, and no link is lost.

Pairs, shingles, heads and components that very many classes have are split over tasks by their known counts.

A class is named by a 64-bit hash of its set, its node. Candidates above the threshold are confirmed
on their full shingle sets. At a similarity of 0.75 a pair has 48 matches of 64 on average with a
deviation of 3.5; below 30 is beyond 5 deviations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rankloom.durable import Scratch, materialize
from rankloom.llm.components import connected_components
from rankloom.llm.splits import split_join, split_keys
from rankloom.llm.wordhash import BY_SPACE, mixed, word_groups

# Words in a shingle, and the similarity (in hundredths) from which texts are linked.
SHINGLE = 5
SIMILAR = 75

#: Signature coordinates, and equal coordinates from which a pair is a candidate.
COORDINATES = 64
MATCHES = 30
PREFIX = COORDINATES - MATCHES + 1

#: Turns of comparing with the heads of lists go on while a turn links more than one in FEW of the posted classes.
#: They decide only how much is left to the last pass, which is exact after any number of them.
FEW = 200
#: Heads that a class is confirmed with in a turn.
HEADS = 3

#: Pairs of one class from which on they are confirmed in several tasks, as each carries two full sets.
HOT_PAIRS = 20_000
#: Classes open to the last pass that may share a shingle in one task, as they are compared with each other there.
HOT_OPEN = 20_000

#: Bytes of text hashed together.
GROUP_BYTES = 1 << 20

_LANES = [f"s{i}" for i in range(COORDINATES // 16)]
_LANE_TYPES = ", ".join(f"{lane} long" for lane in _LANES)
FEATURES = f"doc_id long, node long, n_shingles long, tokens array<long>, {_LANE_TYPES}"

#: Ids of rows to drop that may be broadcast: 16 bytes each.
BROADCAST_IDS = 4_000_000
_SEEDS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def _shingle_hashes(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and where each text's begin and end.

    A text of fewer words has one shingle, the whole of it.
    """
    step = np.uint64(0x9FB21C651E98DF25)
    count = max(len(words) - SHINGLE + 1, 0)
    rolled = np.zeros(count, dtype=np.uint64)
    for k in range(SHINGLE):
        rolled = mixed(rolled * step + words[k : k + count])
    sets = []
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end - start >= SHINGLE:
            sets.append(np.unique(rolled[start : end - SHINGLE + 1]))
        else:
            whole = np.full(min(end - start, 1), (end - start) * 0x51ED2701, dtype=np.uint64)
            for word in words[start:end]:
                whole = mixed(whole * step + word)
            sets.append(whole)
    sizes = [len(s) for s in sets]
    return np.concatenate(sets), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def _sums(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The node of each set: a hash of its members and size, the same in any order; 0 if empty."""
    totals = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mixed(shingles), dtype=np.uint64)))
    sizes = np.diff(bounds).astype(np.uint64)
    return np.where(sizes > 0, mixed(totals[bounds[1:]] - totals[bounds[:-1]] + sizes), 0).astype(np.uint64)


def _signatures(shingles: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over each set, 32 bits each; the sets must not be empty."""
    found = np.empty((len(begins), COORDINATES), dtype=np.uint32)
    for k, seed in enumerate(_SEEDS):
        hashed = (((shingles ^ seed) * seed) >> np.uint64(32)).astype(np.uint32)
        found[:, k] = np.minimum.reduceat(hashed, begins)
    return found


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for first, words, bounds in word_groups(batch.column("text"), BY_SPACE, GROUP_BYTES):
        yield first, *_shingle_hashes(words, bounds)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: its class, and the class's signature as pairs and packed."""
    for batch in batches:
        for first, shingles, bounds in _sets_of(batch):
            docs = len(bounds) - 1
            full = np.flatnonzero(np.diff(bounds))
            lanes = np.zeros((docs, len(_LANES)), dtype=np.uint64)
            sizes = np.zeros(docs, dtype=np.int64)
            posted = np.zeros(0, dtype=np.uint64)
            if len(full):
                signature = _signatures(shingles, bounds[full])
                places = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)
                posted = mixed(signature.astype(np.uint64) | places).ravel()
                nibbles = (signature & np.uint32(15)).astype(np.uint64)
                shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
                for lane in range(len(_LANES)):
                    lanes[full, lane] = np.bitwise_or.reduce(nibbles[:, lane * 16 : lane * 16 + 16] << shifts, axis=1)
                sizes[full] = COORDINATES
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, docs),
                    _signed(_sums(shingles, bounds)),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.ListArray.from_arrays(offsets, _signed(posted)),
                    *[_signed(lanes[:, lane]) for lane in range(len(_LANES))],
                ],
                ["doc_id", "node", "n_shingles", "tokens", *_LANES],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, shingles, bounds in _sets_of(batch):
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), _signed(shingles))
            yield pa.RecordBatch.from_arrays([_signed(_sums(shingles, bounds)), lists], ["node", "shingles"])


def _matches() -> Column:
    """Equal 4-bit coordinates of a class's packed signature and its head's: the zero nibbles of their difference."""
    unequal = []
    for lane in _LANES:
        x = F.col(lane).bitwiseXOR(F.col(f"head_{lane}"))
        folded = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        folded = folded.bitwiseOR(F.shiftrightunsigned(folded, 2))
        unequal.append(F.bit_count(folded.bitwiseAND(F.lit(0x1111111111111111))))
    return F.lit(COORDINATES) - sum(unequal[1:], unequal[0])


def _may_link() -> Column:
    """Set sizes of a class and its head that allow the similarity, and enough collisions."""
    a, b = F.col("n_shingles"), F.col("head_n_shingles")
    return (F.least(a, b) * 100 >= F.greatest(a, b) * SIMILAR) & (_matches() >= MATCHES)


def _postings(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(token, node, n_shingles, lanes)``: classes under the rare prefix of their pairs.

    Pairs of a single class take their place in the order, and are dropped then.
    """
    tokens = classes.select("node", F.explode("tokens").alias("token"))
    shared = scratch.table(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    by_class = (
        split_join(tokens, shared, "token", split_keys(shared, "token", "n"), ["node"])
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("common"))  # at most 64
    )
    # Of the 64 pairs those not in ``common`` are unique, so they are the rarest and come first.
    room = F.lit(PREFIX - COORDINATES) + F.size("common")
    prefix = by_class.where(room > 0).select("node", F.explode(F.slice("common", F.lit(1), room)).alias("pair"))
    return prefix.select("node", "pair.token").join(classes.select("node", "n_shingles", *_LANES), "node")


def _with_labels(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``label``, the component of each posted class, and ``weight``, how many linked classes it has."""
    sizes = labels.groupBy("component").agg(F.count("*").alias("weight"))
    known = split_join(labels, sizes, "component", split_keys(sizes, "component", "weight"), ["node"])
    known = known.select("node", F.col("component").alias("label"), "weight")
    return postings.join(known, "node", "left").withColumns(
        {"label": F.coalesce("label", "node"), "weight": F.coalesce("weight", F.lit(1))}
    )


def _star_pairs(labelled: DataFrame, hot: DataFrame | None, turn: int) -> DataFrame:
    """``(a, b)``: classes with heads of their posting lists, those of most collisions first.

    The head of a list is a member of its largest component, drawn anew each turn. Members of
    other components are compared with it, and each class keeps its ``HEADS`` best. ``hot (token, splits)`` are the
    lists that are split.
    """
    member = F.struct("weight", F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "n_shingles", "label", *_LANES)
    firsts = labelled.groupBy("token").agg(F.max(member).alias("head"), F.count("*").alias("n")).where("n > 1")
    heads = firsts.select(
        "token", *[F.col(f"head.{name}").alias(f"head_{name}") for name in ("node", "n_shingles", "label", *_LANES)]
    )
    found = split_join(labelled.drop("weight"), heads, "token", hot, ["node"])
    found = found.where((F.col("head_label") != F.col("label")) & _may_link())
    pairs = found.select(F.col("head_node").alias("a"), F.col("node").alias("b"), _matches().alias("matches")).distinct()
    best = Window.partitionBy("b").orderBy(F.desc("matches"), "a")  # at most PREFIX heads of a class
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= HEADS).select("a", "b")


def _cross_pairs(labelled: DataFrame, docs: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(a, b)``: classes of different components that may be similar, by their full sets.

    Only classes in posting lists of several components are open still. Their sets are filtered
    exactly: with shingles from rare to common, two similar sets share one among the first of both, and early enough
    that what follows can make up the rest of the overlap.
    """
    lists = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    open_ = scratch.table(labelled.join(lists, "token").select("node", "label").distinct(), "open")
    rows = _sets(open_, docs, classes, scratch).select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    shared = scratch.table(rows.groupBy("shingle").agg(F.count("*").alias("m")).where("m > 1"), "shared")
    hot = split_keys(shared, "shingle", "m", HOT_OPEN)
    by_class = (
        split_join(rows, shared, "shingle", hot, ["node"])
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("m", "shingle"))).alias("common"))
        .withColumn("alone", F.col("n") - F.size("common"))  # shingles of one class come first
    )
    first = F.floor(F.col("n") * (100 - SIMILAR) / 100).cast("int") + 1
    posted = (
        by_class.withColumn("room", first - F.col("alone"))
        .where("room > 0")
        .select("node", "n", "alone", F.posexplode(F.slice("common", F.lit(1), F.col("room"))).alias("at", "pair"))
        .select("node", "n", "pair.shingle", (F.col("alone") + F.col("at") + 1).alias("place"))
        .join(open_, "node")
    )
    posted = scratch.table(posted, "posted")
    # The smaller set of a pair needs fewer of its first shingles.
    fewer = F.floor(F.col("n") * (100 - SIMILAR) / (100 + SIMILAR)).cast("int") + 1
    small = posted.where(F.col("place") <= fewer).drop("alone")
    large = posted.select("shingle", *[F.col(name).alias(f"large_{name}") for name in ("node", "n", "label", "place")])
    size_p, size_q = F.col("n"), F.col("large_n")
    overlap = F.least(size_p - F.col("place"), size_q - F.col("large_place")) + 1
    found = split_join(small, large, "shingle", hot, ["node"]).where(
        (F.col("label") != F.col("large_label"))
        & ((size_p < size_q) | ((size_p == size_q) & (F.col("node") < F.col("large_node"))))
        & (size_p * 100 >= size_q * SIMILAR)
        & (overlap * (100 + SIMILAR) >= (size_p + size_q) * SIMILAR)
    )
    return found.select(F.col("node").alias("a"), F.col("large_node").alias("b")).distinct()


def _bounded_broadcast(ids: DataFrame) -> DataFrame:
    """Broadcast the written ids if they were counted and are few; else leave the join a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, shingles)``: the full sets of classes, made again from one document of each."""
    wanted = scratch.table(classes.select("node", "doc_id").join(nodes.select("node"), "node"), "wanted")
    ids = _bounded_broadcast(wanted.select(F.col("doc_id").alias("wanted_id")).distinct())
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    sets = texts.mapInArrow(_full_sets, "node long, shingles array<long>")
    # A row that shares the id but not the text has another node.
    sets = sets.join(wanted.select("node"), "node").groupBy("node").agg(F.first("shingles").alias("shingles"))
    return scratch.table(sets, "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """The written pairs ``(a, b)`` whose full shingle sets are similar enough."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets(nodes, docs, classes, scratch)
    both = pairs
    for side, name in (("a", "x"), ("b", "y")):
        of_side = sets.select(F.col("node").alias(side), F.col("shingles").alias(name))
        hot = split_keys(pairs.groupBy(side).agg(F.count("*").alias("n")), side, "n", HOT_PAIRS)
        both = split_join(both, of_side, side, hot, ["a", "b"])
    shared = both.select("a", "b", (F.size("x") + F.size("y")).alias("total"),
                         F.size(F.array_intersect("x", "y")).alias("shared"))
    # Equal to 100 * intersection >= 75 * union.
    return shared.where(F.col("shared") * (100 + SIMILAR) >= F.col("total") * SIMILAR).select("a", "b")


def _joined(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components of what was joined before and the new links."""
    known = labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(known.unionByName(links), scratch)


def _components(postings: DataFrame, docs: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` of the linked classes."""
    lengths = postings.groupBy("token").agg(F.count("*").alias("n"))
    hot = split_keys(lengths, "token", "n")
    posted = postings.select("node").distinct().count()
    labels = postings.select("node", F.col("node").alias("component")).limit(0)
    turn, linked = 0, posted
    while linked * FEW > posted:
        with Scratch(docs.sparkSession) as own:
            pairs = own.table(_star_pairs(_with_labels(postings, labels), hot, turn), "pairs")
            links = own.table(_confirmed(pairs, docs, classes, own), "confirmed")
            linked = links.select("b").distinct().count()
            labels = _joined(labels, links, scratch)
        turn += 1
    with Scratch(docs.sparkSession) as own:
        crossing = own.table(_cross_pairs(_with_labels(postings, labels), docs, classes, own), "pairs")
        return _joined(labels, _confirmed(crossing, docs, classes, own), scratch)


def grouped(docs: DataFrame) -> DataFrame:
    """``(doc_id, node, n_shingles, component_id, root)`` for every row of ``docs (doc_id, text)``, written."""
    with Scratch(docs.sparkSession) as scratch:
        return materialize(_grouped(docs, scratch), "groups")


def _grouped(docs: DataFrame, scratch: Scratch) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    features = scratch.table(docs.mapInArrow(_features, FEATURES), "features")
    one = [F.first(c).alias(c) for c in ("n_shingles", "tokens", *_LANES)]
    classes = scratch.table(
        features.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), *one),
        "classes",
    )
    postings = scratch.table(_postings(classes, scratch), "postings")
    labels = _components(postings, docs, classes, scratch)

    named = classes.select("node", "doc_id", "n").join(labels, "node", "left")
    named = named.select("node", "doc_id", "n", F.coalesce("component", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = split_join(named, smallest, "root", split_keys(named.groupBy("root").agg(F.count("*").alias("m")), "root", "m"), ["node"])
    named = scratch.table(named, "named")
    full = split_join(
        features.where("n_shingles > 0").select("doc_id", "node", "n_shingles"),
        named.select("node", "component_id", "root"), "node", split_keys(named, "node", "n"), ["doc_id"],
    ).select("doc_id", "node", "n_shingles", "component_id", "root")
    empty = features.where("n_shingles = 0").select(
        "doc_id", "node", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root")
    )
    return full.unionByName(empty)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs (doc_id, text)``.

    Words are runs of other than space and the characters 9 to 13, with A-Z lower-cased. Documents
    are linked when 100 times the intersection of their shingle sets is at least 75 times the
    union; ``component_id`` is the smallest doc_id of the linked documents, and that one is kept.

    A null, empty or blank text has no shingles and is linked with nothing. Equal texts are linked.
    Rows that repeat a doc_id are separate documents; those of the smallest id of a component are
    all kept here. A null doc_id takes part but names no component unless it is alone with nulls.
    Other columns are ignored; an empty table gives an empty result.
    """
    return grouped(docs).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _with_node(docs: DataFrame) -> DataFrame:
    """All columns by position, and the node of each row's text."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            nodes = [_sums(shingles, bounds) for _, shingles, bounds in _sets_of(text)]
            nodes = np.concatenate(nodes) if nodes else np.zeros(0, dtype=np.uint64)
            yield batch.append_column("node", _signed(nodes))

    schema = StructType([StructField(f.name, f.dataType, True) for f in plain.schema]).add("node", "long")
    return plain.mapInArrow(add, schema)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` less all but one document of each group, with all their columns.

    The document with the smallest id stays; of rows that repeat it, one. Documents without
    shingles stay.
    """
    names = docs.columns
    found = grouped(docs)
    key = f"c{names.index('doc_id')}"
    same = F.col(key).cast("long").eqNullSafe(F.col("gone_id")) & (F.col("node") == F.col("gone_node"))
    dropped = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = found.where("root is not null").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Groups of which several rows have the kept id: all of them go, and one comes back.
    several = kept.groupBy("root").agg(F.count("*").alias("m"), F.min("doc_id").alias("doc_id")).where("m > 1")
    several = materialize(several.select("root", "doc_id"), "several")
    repeats = kept.select("doc_id", "node", "root").join(several.select("root"), "root")
    gone = materialize(
        dropped.select("doc_id", "node").unionByName(repeats.select("doc_id", "node")).distinct()
        .toDF("gone_id", "gone_node"),
        "dropped",
    )
    rows = _with_node(docs)
    rest = rows.join(_bounded_broadcast(gone), same, "left_anti")
    if not several.isEmpty():
        nodes = repeats.groupBy("root").agg(F.min("node").alias("gone_node"), F.min("doc_id").alias("gone_id"))
        again = rows.join(_bounded_broadcast(materialize(nodes, "repeats")), same, "left_semi")
        rest = rest.unionByName(again.dropDuplicates([key, "node"]))
    return rest.drop("node").toDF(*names)
