"""Lines that many documents share: hashes in ranges, streamed in order, answered by keep bitmaps.

A line's key is its text without white space at both ends and with A-Z lower-cased. Each document
sends one row per distinct key, with the hash of the key and the lines that have it, and no text. The rows are
range-partitioned and sorted by hash, document and first line, so the rows of a key follow each
other from its first occurrence on, and a key of a third of all documents is cut into as many ranges as
it needs. A task streams its range: a key that begins and ends in it is settled there with at most
``min_docs`` rows in memory. Only the first and the last key of a range can go on in another one; their
counts, two rows per task, are added up afterwards.

The result is one compressed bitmap for each document that loses lines.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.durable import materialize

# Documents that a line must be found in, and the least code points of its key.
MIN_DOCS = 10
MIN_CHARS = 1

_ROW = "doc_id long, text_hash long, n_lines int, lines array<int>"
#: What a task says about its range: lines to drop, lines that depend on other ranges, counts of the keys at its ends.
_SETTLED, _OPEN, _EDGE = 0, 1, 2


def _documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, text)``: rows that agree in id and text are one document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(high, low, doc_id, text_hash, n_lines, lines)``: each distinct key of a document once.

    ``high`` and ``low`` are the halves of a 128-bit hash of the key, ``lines`` its places from 0.
    Keys of fewer than ``min_chars`` code points have no row.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, digests, of, lines, n_lines = batch.column("text"), [], [], [], []
            for row in range(batch.num_rows):
                text = texts[row].as_py()
                places: dict[bytes, list[int]] = {}
                split = (text or "").encode().split(b"\n")
                for at, line in enumerate(split):
                    key = line.strip(b" \t\n\v\f\r").lower()
                    if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        places.setdefault(xxhash.xxh3_128_digest(key), []).append(at)
                digests += places.keys()
                lines += places.values()
                of += [row] * len(places)
                n_lines += [len(split)] * len(places)
            if not of:
                continue
            halves = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            of = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column("doc_id").take(of),
                 batch.column("text_hash").take(of), pa.array(n_lines, pa.int32()), pa.array(lines, pa.list_(pa.int32()))],
                ["high", "low", "doc_id", "text_hash", "n_lines", "lines"],
            )

    return _documents(docs).mapInArrow(keys, f"high long, low long, {_ROW}")


class _Range:
    """One task's rows in order of key, document and first line; see :func:`_stream`."""

    def __init__(self, min_docs: int, keep_first: bool, part: int):
        self.min_docs, self.keep_first, self.part = min_docs, keep_first, part
        self.key: tuple[int, int] | None = None
        self.last_doc: tuple = ()
        self.docs = 0  # of the key so far
        self.first_run = True  # the range begins with this key
        self.held: list[pa.RecordBatch] = []  # rows of the key while it has too few documents to be settled

    def rows(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        high, low = batch.column("high").to_numpy(), batch.column("low").to_numpy()
        ids, hashes = batch.column("doc_id"), batch.column("text_hash").to_numpy()
        plain, no_id = ids.fill_null(0).to_numpy(), np.asarray(ids.is_null())
        new_key = np.ones(len(high), dtype=bool)
        new_key[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        new_key[0] = self.key != (high[0], low[0])
        new_doc = new_key.copy()
        new_doc[1:] |= (plain[1:] != plain[:-1]) | (no_id[1:] != no_id[:-1]) | (hashes[1:] != hashes[:-1])
        new_doc[0] |= self.last_doc != (ids[0].as_py(), hashes[0])
        self.last_doc = (ids[-1].as_py(), hashes[-1])
        # Repeated rows of a document say nothing new.
        keep = np.flatnonzero(new_doc)
        if not len(keep):
            return
        batch, starts = batch.take(pa.array(keep)), np.flatnonzero(new_key[keep])
        bounds = [0, *starts[starts > 0], len(keep)]
        if new_key[0]:
            yield from self.end(last=False)
            self.begin(batch)
        yield from self.more(batch.slice(0, bounds[1]))
        if len(bounds) == 2:
            return
        yield from self.end(last=False)
        # Keys that begin and end inside the batch.
        sizes = np.diff(bounds)[1:-1]
        inside = np.repeat(sizes >= self.min_docs, sizes)
        heads = np.zeros(len(inside), dtype=bool)
        heads[np.array(bounds[1:-2], dtype=np.int64) - bounds[1]] = True
        chosen = np.flatnonzero(inside)
        if len(chosen):
            yield self.said(batch.slice(bounds[1]).take(pa.array(chosen)), _SETTLED, heads[chosen])
        tail = batch.slice(bounds[-2])
        self.begin(tail)
        yield from self.more(tail)

    def begin(self, batch: pa.RecordBatch) -> None:
        self.first_run = self.key is None
        self.key, self.docs, self.held = (batch.column("high")[0].as_py(), batch.column("low")[0].as_py()), 0, []

    def more(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Further documents of the key."""
        head = self.docs == 0
        self.docs += batch.num_rows
        heads = np.zeros(batch.num_rows, dtype=bool)
        heads[:1] = head
        if self.first_run:
            yield self.said(batch, _OPEN, heads)
        elif self.docs < self.min_docs:
            self.held.append(batch)
        else:
            yield from self.release(_SETTLED)
            yield self.said(batch, _SETTLED, heads)

    def release(self, kind: int) -> Iterator[pa.RecordBatch]:
        for i, held in enumerate(self.held):
            heads = np.zeros(held.num_rows, dtype=bool)
            heads[:1] = i == 0
            yield self.said(held, kind, heads)
        self.held = []

    def end(self, last: bool) -> Iterator[pa.RecordBatch]:
        """The key has no more rows; the last key of a range may go on in the next one."""
        if self.key is None:
            return
        if last:
            yield from self.release(_OPEN)
        if last or self.first_run:
            longs = [pa.array([v], pa.int64()) for v in (*self.key, None, None)]
            yield self._batch([*longs, pa.array([None], pa.int32()), pa.array([None], pa.list_(pa.int32())),
                               pa.array([False]), pa.array([self.docs], pa.int64())], _EDGE)

    def said(self, batch: pa.RecordBatch, kind: int, heads: np.ndarray) -> pa.RecordBatch:
        columns = [batch.column(name) for name in ("high", "low", "doc_id", "text_hash", "n_lines", "lines")]
        if kind == _SETTLED and self.keep_first and heads.any():
            lines = columns[-1].to_pylist()
            columns[-1] = pa.array([x[1:] if h else x for x, h in zip(lines, heads)], pa.list_(pa.int32()))
        return self._batch([*columns, pa.array(heads), pa.nulls(len(heads), pa.int64())], kind)

    def _batch(self, columns: list[pa.Array], kind: int) -> pa.RecordBatch:
        rows = len(columns[0])
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(np.full(rows, self.part, np.int32)), pa.array(np.full(rows, kind, np.int32))],
            ["high", "low", "doc_id", "text_hash", "n_lines", "lines", "head", "docs", "part", "kind"],
        )


def _stream(ordered: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """What each task says about its range of ordered keys."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _Range(min_docs, keep_first, TaskContext.get().partitionId())
        for batch in batches:
            if batch.num_rows:
                yield from task.rows(batch)
        yield from task.end(last=True)

    return ordered.mapInArrow(settle, f"high long, low long, {_ROW}, head boolean, docs long, part int, kind int")


def _packed(dropped: np.ndarray, n_lines: int) -> bytes:
    keep = np.ones(n_lines, dtype=bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpacked(bitmap: bytes, n_lines: int) -> np.ndarray:
    """The keep flags of a document's lines."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """``(doc_id, text_hash, n_lines, n_dropped, keep)``: a row for each document that loses lines.

    Lines whose key is found in at least ``min_docs`` documents go, all of them, or with
    ``keep_first`` all but the first by document and position. ``keep`` is a zlib-compressed bitmap, a bit per
    line from the highest bit of the first byte. Rows that agree in doc_id and text are one document,
    with one row here; a null doc_id is an id like others. Null and empty texts have one empty line, whose
    key is too short to be dropped. Texts go through whole whatever their length. An empty table gives no rows.
    """
    keys = materialize(line_keys(docs, min_chars), "line-keys")
    order = ["high", "low", "doc_id", "text_hash"]
    ordered = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    said = materialize(_stream(ordered, min_docs, keep_first), "line-ranges")
    # Two rows per task at most.
    edges = said.where(F.col("kind") == _EDGE).groupBy("high", "low").agg(
        F.sum("docs").alias("total"), F.min("part").alias("first_part")
    )
    edges = edges.where(F.col("total") >= min_docs)
    lines = F.col("lines")
    if keep_first:
        first = F.col("head") & (F.col("part") == F.col("first_part"))
        lines = F.when(first, F.slice("lines", F.lit(2), F.size("lines"))).otherwise(lines)
    crossing = said.where(F.col("kind") == _OPEN).join(F.broadcast(edges), ["high", "low"]).withColumn("lines", lines)
    names = ["doc_id", "text_hash", "n_lines", "lines"]
    drops = said.where(F.col("kind") == _SETTLED).select(*names).unionByName(crossing.select(*names))
    whole = drops.groupBy("doc_id", "text_hash").agg(
        F.max("n_lines").alias("n_lines"), F.flatten(F.collect_list("lines")).alias("dropped")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dropped = [np.asarray(x.values) for x in batch.column("dropped")]
            bitmaps = [_packed(x, n) for x, n in zip(dropped, batch.column("n_lines").to_pylist())]
            columns = [*batch.columns[:3], pa.array([len(x) for x in dropped], pa.int32()), pa.array(bitmaps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_lines", "n_dropped", "keep"])

    schema = "doc_id long, text_hash long, n_lines int, n_dropped int, keep binary"
    return whole.where(F.size("dropped") > 0).mapInArrow(pack, schema)


def _kept_texts(rows: DataFrame, bitmaps: DataFrame, names: list[str]) -> DataFrame:
    """``names`` of ``rows (doc_id, text_hash, text, ...)`` with the text that is left, ``n_lines`` and ``n_dropped``."""
    of = bitmaps.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "keep")
    joined = rows.join(of, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left")
    joined = joined.select(*names, "keep")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, keep in zip(batch.column("text"), batch.column("keep")):
                text, keep = text.as_py(), keep.as_py()
                n_lines.append((text or "").count("\n") + 1)
                n_dropped.append(0)
                if keep is not None:
                    flags = unpacked(keep, n_lines[-1])
                    n_dropped[-1] = n_lines[-1] - int(flags.sum())
                    text = "\n".join(line for line, stays in zip(text.split("\n"), flags) if stays)
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in names]
            columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_dropped"])

    return joined.mapInArrow(apply, f"{schema}, n_lines long, n_dropped long")


def without_shared_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """``docs (doc_id, text, ...)`` with all their columns and the text that is left.

    A null text stays null; a text that loses all its lines is empty.
    """
    bitmaps = materialize(keep_bitmaps(docs, min_docs, min_chars, keep_first), "bitmaps")
    names = docs.columns
    rest = F.struct(*[F.col(f"`{name}`") for name in names]).alias("row")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
        rest,
    )
    found = _kept_texts(rows, bitmaps, ["text", "row"])
    return found.select(
        *[F.col("text").alias(name) if name == "text" else F.col("row")[name].alias(name) for name in names]
    )


def line_digest(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` for every row of ``docs (doc_id, text)``.

    See :func:`keep_bitmaps` for nulls, repeated rows and empty tables; other columns are ignored.
    """
    bitmaps = materialize(keep_bitmaps(docs, min_docs, min_chars), "bitmaps")
    kept = _kept_texts(_documents(docs), bitmaps, ["doc_id", "text"])
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))
