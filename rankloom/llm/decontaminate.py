"""Benchmark decontamination with suffix arrays over the training texts.

Each task turns its documents into shards of a few megabytes and builds a suffix array over the
word hashes of a shard, sorted by prefix doubling to at least the window length. Every suffix of
every benchmark item is then looked up by binary search in every shard, word by word, all suffixes
at once. Only suffixes that still match go on, so a clean shard costs little more than its sort.
There is no shuffle: the benchmark comes to the documents.

The benchmark is a stated query set. It is cut into blocks of at most ``BLOCK_WORDS`` words; each
block is one broadcast of bounded size, and a shard is searched for one block after another. A worker holds one
block at a time: with several blocks it reads each again, from its machine's copy, for every shard. Windows that
several items share are searched once, and their items are named per document, not per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rankloom.llm.wordhash import BY_LETTER, mixed, word_groups

# Words in a window; a document is contaminated from one hit word in so many.
WINDOW = 13
HIT_SHARE = 20

#: Bytes of text in a shard (a longer document is a shard of its own).
SHARD_BYTES = 4 << 20
#: Words of benchmark items in one broadcast block, of some 30 bytes each.
BLOCK_WORDS = 500_000
#: Pairs of a document and an item that are put together at a time.
PAIRS = 1_000_000

VERDICTS = "doc_id long, n_words long, n_hit long, items array<string>"
MATCHES = "doc_id long, item_id long, doc_word long, item_word long, n_words long"


class Block:
    """Benchmark items as one array of word hashes, each item followed by a 0."""

    def __init__(self, items: list[tuple[int, np.ndarray]], window: int):
        self.ids = np.array([item for item, _ in items], dtype=np.int64)
        sizes = np.array([len(words) for _, words in items], dtype=np.int64)
        gap = np.zeros(1, dtype=np.uint64)
        self.words = np.concatenate([part for _, words in items for part in (words, gap)])
        begins = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        # A window starts at each word that has enough words after it; a short item is one window.
        lengths = np.minimum(window, sizes)
        counts = np.where(sizes > 0, sizes - lengths + 1, 0)
        item = np.repeat(np.arange(len(items)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start, length = np.repeat(begins, counts) + within, np.repeat(lengths, counts)
        order, heads = _equal_windows(self.words, start, length, window)
        #: All windows, equal ones next to each other, with their items and first words; where each distinct one begins.
        self.item, self.within = item[order].astype(np.int32), within[order].astype(np.int32)
        self.offsets = np.append(heads, len(order)).astype(np.int64)
        #: The distinct windows.
        self.start, self.length = start[order[heads]], length[order[heads]]

    def expanded(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among all windows of some distinct ones, and of which one each is."""
        counts = self.offsets[windows + 1] - self.offsets[windows]
        which = np.repeat(np.arange(len(windows)), counts)
        steps = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.offsets[windows[which]] + steps, which


def _equal_windows(words: np.ndarray, start: np.ndarray, length: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of windows in which equal ones are neighbours, and the places where another one begins."""
    hashes = length.astype(np.uint64)
    for step in range(window):
        inside = length > step
        hashes[inside] = mixed(hashes[inside] * np.uint64(0x9E3779B97F4A7C15) + words[start[inside] + step])
    order = np.argsort(hashes, kind="stable")
    # Equal hashes are compared word by word, so different windows are never one.
    other = np.ones(len(order), dtype=bool)
    one, two = order[:-1], order[1:]
    other[1:] = length[one] != length[two]
    for step in range(window):
        near = np.flatnonzero(~other[1:] & (length[one] > step))
        other[1 + near] = words[start[one[near]] + step] != words[start[two[near]] + step]
    return order, np.flatnonzero(other)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the ``depth`` or more words that follow, 0 words first.

    Doubling: knowing the order by h words, the order by 2h words is one sort of pairs of ranks.
    """

    def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)
        ordered = keys[order]
        ranks = np.empty(len(keys), dtype=np.int64)
        ranks[order] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
        return order, ranks

    order, ranks = ranked(words)
    covered = 1
    while covered < depth and ranks[order[-1]] < len(words):
        following = np.zeros(len(words), dtype=np.int64)
        following[:-covered] = ranks[covered:]
        order, ranks = ranked(ranks * (len(words) + 1) + following)
        covered *= 2
    return order


def _bound(text: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, word: np.ndarray, at: int, after: bool):
    """Binary search in many ranges of the suffix array at once, on the word at distance ``at``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        middle = (lo[open_] + hi[open_]) >> 1
        found = text[order[middle] + at]
        right = found <= word[open_] if after else found < word[open_]
        lo[open_[right]] = middle[right] + 1
        hi[open_[~right]] = middle[~right]


class Shard:
    """Documents as one array of word hashes, each followed by a 0, with its suffix array."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray, depth: int):
        docs = len(bounds) - 1
        self.begins = bounds[:-1] + np.arange(docs)
        self.sizes = np.diff(bounds)
        text = np.zeros(len(words) + docs, dtype=np.uint64)
        text[np.arange(len(words)) + np.repeat(np.arange(docs), self.sizes)] = words
        self.size = len(text)
        self.order = suffix_array(text, depth)
        self.text = np.concatenate((text, np.zeros(depth, dtype=np.uint64)))
        self.first = text[self.order]

    def search(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """``(window, position)`` of every occurrence of a distinct window of the block."""
        word = block.words[block.start]
        lo = np.searchsorted(self.first, word, "left")
        hi = np.searchsorted(self.first, word, "right")
        live = np.flatnonzero(hi > lo)
        lo, hi, windows, positions = lo[live], hi[live], [], []
        depth = 1
        while len(live):
            full = block.length[live] == depth
            if full.any():
                counts = hi[full] - lo[full]
                windows.append(np.repeat(live[full], counts))
                steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                positions.append(self.order[np.repeat(lo[full], counts) + steps])
            more = ~full
            live, lo, hi = live[more], lo[more], hi[more]
            word = block.words[block.start[live] + depth]
            low = _bound(self.text, self.order, lo, hi, word, depth, False)
            hi = _bound(self.text, self.order, low, hi, word, depth, True)
            lo = low
            kept = hi > lo
            live, lo, hi = live[kept], lo[kept], hi[kept]
            depth += 1
        if not windows:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(windows), np.concatenate(positions)

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, positions, "right") - 1


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[Broadcast]:
    """Broadcasts of at most ``block_words`` words each (a longer item is a block of its own).

    Rows with a null id are no items, and repeated rows count once. The items are read one
    partition at a time.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, bounds in word_groups(batch.column("text"), BY_LETTER, SHARD_BYTES):
                values = [words[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                ids = batch.column("item_id").slice(first, len(values))
                yield pa.RecordBatch.from_arrays([ids, pa.array(values, pa.binary())], ["item_id", "words"])

    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null")
    context = benchmark.sparkSession.sparkContext
    blocks, held, size = [], [], 0
    for row in items.distinct().mapInArrow(hashed, "item_id long, words binary").toLocalIterator():
        words = np.frombuffer(row.words, dtype=np.uint64)
        if held and size + len(words) > block_words:
            blocks.append(context.broadcast(Block(held, window)))
            held, size = [], 0
        held.append((row.item_id, words))
        size += len(words)
    if held:
        blocks.append(context.broadcast(Block(held, window)))
    return blocks


def _shards(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, Shard]]:
    for first, words, bounds in word_groups(batch.column("text"), BY_LETTER, SHARD_BYTES):
        yield first, Shard(words, bounds, window)


def _each(blocks: list[Broadcast]) -> Iterator[Block]:
    """One block after the other; where there are several, a worker keeps none of them."""
    for broadcast in blocks:
        yield broadcast.value
        if len(blocks) > 1:
            vars(broadcast).pop("_value", None)


def _judged(shard: Shard, blocks: list[Broadcast]) -> tuple[np.ndarray, list[tuple[np.ndarray, list[np.ndarray]]]]:
    """Hit words of each document of a shard; for each block documents and the items of a window in them."""
    change = np.zeros(shard.size + 1, dtype=np.int64)
    found = []
    for block in _each(blocks):
        windows, positions = shard.search(block)
        if len(windows):
            np.add.at(change, positions, 1)
            np.add.at(change, positions + block.length[windows], -1)
            pairs = np.unique(shard.document(positions) * len(block.start) + windows)
            found.append((pairs // len(block.start), _items(block, pairs % len(block.start))))
        del block
    hits = np.concatenate(([0], np.cumsum(np.cumsum(change[:-1]) > 0)))
    return hits[shard.begins + shard.sizes] - hits[shard.begins], found


def _items(block: Block, windows: np.ndarray) -> list[np.ndarray]:
    """The item ids of some distinct windows; an array per distinct one, shared by its occurrences."""
    distinct, back = np.unique(windows, return_inverse=True)
    ids = [np.unique(block.ids[block.item[block.offsets[w] : block.offsets[w + 1]]]) for w in distinct]
    return [ids[i] for i in back]


def _item_lists(docs: int, found: list[tuple[np.ndarray, list[np.ndarray]]]) -> Iterator[pa.Array]:
    """Sorted distinct item ids as strings of document after document, some ``PAIRS`` at a time."""
    of: list[list[np.ndarray]] = [[] for _ in range(docs)]
    for documents, items in found:
        for doc, ids in zip(documents, items):
            of[doc].append(ids)
    lists, held = [], 0
    known: dict[tuple[int, ...], list[str]] = {}  # documents with the same windows have the same items
    for own in of:
        which = tuple(map(id, own))
        if which not in known:
            known = known if len(known) < 1000 else {}
            ids = np.unique(np.concatenate(own)) if own else np.zeros(0, dtype=np.int64)
            known[which] = sorted(map(str, ids))
        lists.append(known[which])
        held += len(lists[-1])
        if held >= PAIRS:
            yield pa.array(lists, pa.list_(pa.string()))
            lists, held = [], 0
    if lists:
        yield pa.array(lists, pa.list_(pa.string()))


def verdicts(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_hit, items)`` for every row of ``docs (doc_id, text)``.

    A word is hit when it lies inside an occurrence of a window of any item of ``benchmark
    (item_id, text)``; ``items`` has the ids of the items with an occurring window, sorted as
    strings. An empty or null text has no words and no hits; an item without words has no window;
    without items nothing is hit. Repeated documents are judged each, repeated items once; a null
    doc_id stays. Other columns are ignored.
    """
    blocks = benchmark_blocks(benchmark, window)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, shard in _shards(batch, window):
                n_hit, found = _judged(shard, blocks)
                at = 0
                for items in _item_lists(len(n_hit), found):
                    end = at + len(items)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(first + at, len(items)),
                            pa.array(shard.sizes[at:end], pa.int64()),
                            pa.array(n_hit[at:end], pa.int64()),
                            items,
                        ],
                        ["doc_id", "n_words", "n_hit", "items"],
                    )
                    at = end

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(judge, VERDICTS)


def with_verdict(rows: DataFrame) -> DataFrame:
    """Add ``n_items``, ``items_sha256`` and ``contaminated`` to :func:`verdicts`."""
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, item_id, doc_word, item_word, n_words)``: maximal verbatim matches of at least a
    window, with their first word in the document and in the item.

    Windows that follow each other in both make up one match, so its length is not bounded by the
    depth of the suffix array.
    """
    blocks = benchmark_blocks(benchmark, window)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, shard in _shards(batch, window):
                for block in _each(blocks):
                    windows, positions = shard.search(block)
                    if not len(windows):
                        continue
                    places, which = block.expanded(windows)
                    windows, positions = windows[which], positions[which]
                    doc, item, within = shard.document(positions), block.item[places], block.within[places].astype(np.int64)
                    order = np.lexsort((positions, positions - within, item, doc))
                    doc, item, within = doc[order], item[order], within[order]
                    at, length = positions[order] - shard.begins[doc], block.length[windows[order]]
                    follows = np.zeros(len(at), dtype=bool)
                    follows[1:] = (
                        (doc[1:] == doc[:-1]) & (item[1:] == item[:-1]) & (at[1:] == at[:-1] + 1)
                        & (within[1:] == within[:-1] + 1)
                    )
                    heads = np.flatnonzero(~follows)
                    runs = np.diff(np.concatenate((heads, [len(at)])))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(first + doc[heads])),
                            pa.array(block.ids[item[heads]]),
                            pa.array(at[heads]),
                            pa.array(within[heads]),
                            pa.array(length[heads] + runs - 1),
                        ],
                        ["doc_id", "item_id", "doc_word", "item_word", "n_words"],
                    )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(locate, MATCHES)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Rows pass through the search whole, so nothing is joined back and repeated or null ids do no harm.
    """
    blocks = benchmark_blocks(benchmark, window)
    names = docs.columns
    # Columns travel by position, so names that clash do no harm.
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = [i for i, name in enumerate(names) if name == "text"][0]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for first, words, bounds in word_groups(batch.column(at), BY_LETTER, SHARD_BYTES):
                shard = Shard(words, bounds, window)
                n_hit, _ = _judged(shard, blocks)
                keep[first : first + len(n_hit)] = ~((n_hit > 0) & (n_hit * HIT_SHARE >= shard.sizes))
            yield batch.filter(pa.array(keep))

    schema = StructType([StructField(f.name, f.dataType, True) for f in plain.schema])
    return plain.mapInArrow(clean, schema).toDF(*names)
