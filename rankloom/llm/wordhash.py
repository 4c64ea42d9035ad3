"""Words of many texts as 64-bit hashes, read straight from the UTF-8 buffers of an Arrow batch.

All separators used here are ASCII, so a text is split on bytes. A word's hash is a polynomial over
its bytes, taken from running sums, so no Python object is made per word. Equal words have equal
hashes; different words differ but for the chance of a 64-bit collision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes hashed at a time: bounds the temporary arrays whatever the length of a text.
SLICE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_U64 = np.uint64
_tables: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, size: int) -> np.ndarray:
    table = _tables.get(name)
    if table is None or len(table) < size:
        table = np.full(max(size, SLICE + 1), base, dtype=_U64)
        table[0] = 1
        table = _tables[name] = np.cumprod(table, dtype=_U64)
    return table


class Splitter:
    """Which bytes belong to words; A-Z are lower-cased."""

    def __init__(self, word_bytes: np.ndarray):
        self.is_word = word_bytes
        fold = np.arange(256, dtype=np.uint8)
        fold[65:91] += 32
        self.value = fold.astype(_U64) + _U64(1)

    def hashes(self, data: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first byte of every word; a word also ends where a text starts."""
        size = len(data)
        inside = self.is_word[data]
        joined = np.zeros(size + 1, dtype=bool)
        joined[1:-1] = inside[:-1] & inside[1:]
        joined[text_starts] = False
        starts = np.flatnonzero(inside & ~joined[:-1])
        ends = np.flatnonzero(inside & ~joined[1:]) + 1
        sums = np.zeros(size + 1, dtype=_U64)
        np.cumsum(self.value[data] * _powers("up", _BASE, size)[:size], out=sums[1:])
        found = (sums[ends] - sums[starts]) * _powers("down", pow(_BASE, -1, 1 << 64), size)[starts]
        return mixed(found), starts

    def long_text(self, data: np.ndarray) -> np.ndarray:
        """Word hashes of one text in pieces that end between words."""
        parts, at = [], 0
        while at < len(data):
            end = at + SLICE
            if end < len(data):
                gaps = np.flatnonzero(~self.is_word[data[at:end]])
                while not len(gaps) and end < len(data):
                    more = np.flatnonzero(~self.is_word[data[end : end + SLICE]])
                    end = min(end + SLICE, len(data)) if not len(more) else end + int(more[0]) + 1
                    gaps = [end - at - 1] if len(more) else gaps
                end = at + int(gaps[-1]) + 1 if len(gaps) else end
            piece = data[at:end]
            parts.append(self.hashes(piece, np.zeros(1, dtype=np.int64))[0])
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, dtype=_U64)


def separated_by(separators: list[int]) -> Splitter:
    word = np.ones(256, dtype=bool)
    word[separators] = False
    return Splitter(word)


#: Words are runs of anything but space and the control characters 9 to 13.
BY_SPACE = separated_by([0x20, *range(0x09, 0x0E)])
#: Words are runs of ASCII letters, digits and all characters beyond ASCII.
BY_LETTER = separated_by([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of splitmix64)."""
    values = (values ^ (values >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U64(27))) * _U64(0x94D049BB133111EB)
    return values ^ (values >> _U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return (
        np.frombuffer(data, dtype=np.uint8),
        np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1, offset=8 * column.offset),
    )


def word_groups(column: pa.Array, splitter: Splitter, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of up to ``limit`` bytes together, or one longer text.

    Yields the index of the first text, the word hashes of all, and where each text's words begin
    and end in them.
    """
    data, offsets = text_buffer(column)
    first, total = 0, len(column)
    while first < total:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, total)
        words, bounds, at = [], [np.zeros(1, dtype=np.int64)], first
        while at < last:
            end = max(at + 1, min(last, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1))
            piece = data[offsets[at] : offsets[end]]
            done = bounds[-1][-1]
            if end == at + 1 and len(piece) > SLICE:
                found = splitter.long_text(piece)
                bounds.append(np.array([done + len(found)]))
            else:
                begins = offsets[at : end + 1] - offsets[at]
                found, starts = splitter.hashes(piece, begins)
                bounds.append(done + np.searchsorted(starts, begins[1:]))
            words.append(found)
            at = end
        yield first, np.concatenate(words), np.concatenate(bounds)
        first = last
