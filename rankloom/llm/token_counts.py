"""Exact token counts of every prefix of a text, by dynamic programming.

The pieces of the vocabulary never hold a space behind another character, so no merge crosses from
a word into the space before the next. A text is therefore a row of chunks (spaces and the word
behind them) that are encoded on their own, and the count of a prefix is the count of the prefix up to the last
chunk, plus the count of the piece of that chunk: ``count[i] = count[i - 1] + tokens(chunk i)``.
Inside a chunk the last token of each prefix follows from those of shorter prefixes: of the pieces
that end there, it is the one that the tokenizer leaves next to the last token before it.

With the table, the question how much of a text fits a budget is a binary search; nothing is encoded
again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The vocabulary, and the count above which a text is over the limit.
MODEL = "piece_bpe_32k.model"
LIMIT = 4096

#: Bytes of text whose chunks are counted together (a longer text is counted alone).
SLICE_BYTES = 16 << 20

_SPACE = "▁"
_CHUNK = re.compile(" *[^ ]+| +$")


class PrefixCounter:
    """Token counts of chunks and of their prefixes for one sentencepiece BPE model."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        special = [i for i in range(size) if self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)]
        self.pieces = {self.model.id_to_piece(i) for i in range(size)} - {self.model.id_to_piece(i) for i in special}
        if any(_SPACE in piece.lstrip(_SPACE) for piece in self.pieces):
            raise ValueError("a piece holds a space behind another character: chunks would not be independent")
        self.longest = max(map(len, self.pieces))
        self.adjacent: dict[tuple[str, str], bool] = {}

    def chunks(self, text: str) -> list[str]:
        """Spaces and word, one after another, each without its first space: the tokenizer adds that."""
        if not text:
            return []
        text = text.replace(_SPACE, " ")
        if "  " not in text and text[-1] != " " and text[0] != " ":
            return text.split(" ")
        return [chunk[1:] for chunk in _CHUNK.findall(" " + text)]

    def table(self, text: str) -> tuple[list[str], np.ndarray]:
        """The chunks of a text, and the token count of the prefix before and behind each."""
        _, chunks, _, table = next(self.column_tables(pa.array([text])))
        return chunks.to_pylist(), table

    def _fit(self, left: str, right: str) -> bool:
        """Whether the tokenizer leaves two tokens side by side as they are."""
        found = self.adjacent.get((left, right))
        if found is None:
            found = self.adjacent[left, right] = self._pieces(left + right) == [left, right]
        return found

    def _pieces(self, text: str) -> list[str]:
        """Merge from single characters by score: what the model does, for a few characters."""
        parts = list(text)
        while True:
            scored = [
                (-self.model.get_score(self.model.piece_to_id(a + b)), i)
                for i, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in self.pieces
            ]
            if not scored:
                return parts
            at = min(scored)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def inside(self, chunk: str) -> list[int]:
        """Token count of every prefix of a chunk and its first space, from the empty one."""
        text = (" " + chunk).replace(" ", _SPACE)
        counts, last = [0], [""]
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - self.longest), end):
                token = text[start:end]
                if token not in self.pieces:
                    if end - start > 1:
                        continue
                    counts.append(counts[start] + len(token.encode()))  # bytes stand for an unknown character
                    last.append(token)
                    break
                if start == 0 or self._fit(last[start], token):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts

    def fitting(self, chunks: list[str], table: np.ndarray, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens, from the table of its text.

        Counts at chunk ends only grow, so it ends in the first chunk that does not fit whole, and
        only that chunk is looked into."""
        whole = int(np.searchsorted(table, budget, "right")) - 1
        done = sum(map(len, chunks[:whole])) + whole - 1  # the first space is not in the text
        if whole == len(chunks):
            return max(done, 0)
        room = budget - int(table[whole])
        within = self.inside(chunks[whole])
        return max(done + max(i for i, n in enumerate(within) if n <= room), 0)

    def column_tables(self, column: pa.Array) -> Iterator[tuple[int, list]]:
        """For slices of a column: first row, chunks of all rows, bounds of each row's, prefix sums.

        Equal chunks of a slice are encoded once. Rows with runs of spaces are split one by one.
        """
        column = pc.replace_substring(column.fill_null(""), _SPACE, " ")
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(column):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
            part = column.slice(first, last - first)
            lists = pc.split_pattern(part, " ")
            uneven = pc.match_substring_regex(part, "^ |  | $|^$").to_numpy(zero_copy_only=False)
            if uneven.any():
                rows = lists.to_pylist()
                for i in np.flatnonzero(uneven):
                    rows[i] = self.chunks(part[int(i)].as_py())
                lists = pa.array(rows, pa.list_(pa.string()))
            chunks = lists.flatten()
            coded = chunks.dictionary_encode()
            each = self.lengths(coded.dictionary)[coded.indices.to_numpy()]
            bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy().astype(np.int64))))
            yield first, chunks, bounds, np.concatenate(([0], np.cumsum(each, dtype=np.int64)))
            first = last

    def lengths(self, distinct: pa.Array) -> np.ndarray:
        """Tokens of each distinct chunk."""
        found = []
        for at in range(0, len(distinct), 20_000):
            texts = distinct.slice(at, 20_000).to_pylist()
            found += [len(ids) if text else 1 for text, ids in zip(texts, self.model.encode(texts, num_threads=1))]
        return np.array(found, dtype=np.int64)


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The counter of this worker process."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit, fits_chars)`` for every row of ``docs (doc_id, text)``.

    Counts are those of the library without begin or end tokens; special strings in a text are
    ordinary text. ``fits_chars`` is the length of the longest prefix within ``limit`` tokens. A null
    or empty text has no bytes and no tokens. A text goes through in one piece whatever its length;
    repeated rows and null ids are rows like others, and other columns are ignored. ``model`` is a path that
    executors can read, by default that of the installed vocabulary.
    """
    path = model or public_tokenizers.path(MODEL)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = counter(path)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for first, chunks, bounds, table in prefix.column_tables(texts):
                part = texts.slice(first, len(bounds) - 1)
                n_tokens = table[bounds[1:]] - table[bounds[:-1]]
                fits = pc.utf8_length(part).to_numpy().astype(np.int64)
                for i in np.flatnonzero(n_tokens > limit):
                    start, end = int(bounds[i]), int(bounds[i + 1])
                    own = chunks.slice(start, end - start).to_pylist()
                    fits[i] = prefix.fitting(own, table[start : end + 1] - table[start], limit)
                columns = [batch.column("doc_id").slice(first, len(part)), pc.binary_length(part).cast(pa.int64()),
                           pa.array(n_tokens), pa.array(n_tokens > limit), pa.array(fits)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fits_chars long")


def prefix_tables(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``(doc_id, ends array<long>, counts array<long>)``: the stored tables, from which any budget is
    answered by a search: prefix of ``ends[i]`` characters has ``counts[i]`` tokens. Every prefix is in it
    but the empty one."""
    path = model or public_tokenizers.path(MODEL)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = counter(path)
        for batch in batches:
            for first, chunks, bounds, table in prefix.column_tables(batch.column("text")):
                longs = pa.list_(pa.int64())
                inside: dict[str, np.ndarray] = {}
                counts = []
                for a, b in zip(bounds[:-1], bounds[1:]):
                    parts = [np.zeros(0, dtype=np.int64)]
                    for chunk, before in zip(chunks.slice(a, b - a).to_pylist(), table[a:b] - table[a]):
                        if chunk not in inside:
                            inside[chunk] = np.asarray(prefix.inside(chunk), dtype=np.int64)[1:]
                        parts.append(before + inside[chunk])
                    counts.append(np.concatenate(parts)[1:])  # the first is that of the space before the text
                columns = [
                    batch.column("doc_id").slice(first, len(counts)),
                    pa.array([np.arange(1, len(found) + 1) for found in counts], longs),
                    pa.array(counts, longs),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ends", "counts"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(tables, "doc_id long, ends array<long>, counts array<long>")
