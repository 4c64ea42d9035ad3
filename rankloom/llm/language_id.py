"""Language identification with string kernels.

The kernel of two texts is the number of different character n-grams (n = 1 to 3) that both have,
divided by the root of the numbers each has: a blended-spectrum presence kernel. Texts are mapped
to their kernel values with landmark texts (Nyström), and one ridge regression per language, one
against the rest, is fitted on those. Scoring a batch of documents is two matrix products: presence
of the landmarks' n-grams times the landmarks, times the weights.

Symbols are letters by their lower-case code points, of all scripts, and everything else is one gap. An n-gram is
hashed to one of ``FEATURES`` places, so a text of any length is read whole into a table of presence bits;
of a few thousand n-grams that a text has, one in some hundreds shares its place with another.

The classifier knows all languages of the labelled rows. It is fitted on a sample with a bounded number of
rows per language, chosen by a hash of the id; the features of the sample, not its texts, come to the driver. Where
many languages or very long texts would make the sample or the landmarks large, kernels are taken over the n-grams in the first
places only, which are a random part of all, so that both stay within ``SAMPLE_BYTES`` and ``MODEL_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.durable import materialize
from rankloom.operators.skew import broadcast_if_small

UNKNOWN = "und"

#: Labelled rows to learn from: an equal share of SAMPLE_ROWS for each language, MIN_ROWS at least.
SAMPLE_ROWS = 1200
MIN_ROWS = 20
#: Landmark texts, likewise, and the strength of the ridge.
LANDMARKS = 96
MIN_LANDMARKS = 4
RIDGE = 0.05
#: Steepness of the score of the regression outputs.
SHARPNESS = 6.0

#: Most bytes of the sample's features on the driver, and of the landmarks' matrix, which is broadcast.
SAMPLE_BYTES = 128 << 20
MODEL_BYTES = 64 << 20

#: Symbols read at a time, and most rows and bytes of rows scored in one product.
SLICE = 1 << 20
ROWS = 256
ROW_BYTES = 64 << 20

#: Places of n-grams.
FEATURE_BITS = 20
FEATURES = 1 << FEATURE_BITS


def _symbol_table() -> np.ndarray:
    """Symbol of each code point: a letter's lower-case code point, else 0, a gap."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


_symbols: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """Symbols of a text between two gaps, runs of gaps as one."""
    if not _symbols:
        _symbols.append(_symbol_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    gap = np.zeros(1, dtype=np.uint32)
    found = np.concatenate((gap, _symbols[0][points], gap))
    keep = np.ones(len(found), dtype=bool)
    keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
    return found[keep]


def _places(grams: np.ndarray) -> np.ndarray:
    """Places of n-grams from their 32-bit sums, well mixed."""
    mixed = (grams ^ (grams >> np.uint32(16))) * np.uint32(0x7FEB352D)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x846CA68B)
    return (mixed ^ (mixed >> np.uint32(16))) >> np.uint32(32 - FEATURE_BITS)


def presence(text: str, flags: np.ndarray) -> bool:
    """Set the flags of all n-grams of a text; whether it has a letter. A gap alone is no n-gram."""
    flags[:] = False
    found = symbols(text)
    if len(found) < 2:
        return False
    for at in range(0, len(found), SLICE):
        one = found[at : at + SLICE + 2]
        two = one[:-1] * np.uint32(0x9E3779B1) + one[1:]
        three = two[:-1] * np.uint32(0x85EBCA77) + one[2:]
        flags[_places(one[one != 0])] = True
        flags[_places(two + np.uint32(0x3C6EF372))] = True
        flags[_places(three + np.uint32(0x78DDE6E4))] = True
    return True


def presence_rows(docs: DataFrame) -> DataFrame:
    """``(lang, n_grams, grams binary)``: sorted places of the n-grams of each text that has a letter, and their number."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(FEATURES, dtype=bool)
        for batch in batches:
            grams, sizes = [], []
            for text in batch.column("text"):
                found = presence(text.as_py() or "", flags)
                places = np.flatnonzero(flags).astype(np.int32)
                grams.append(places.tobytes() if found else None)
                sizes.append(len(places))
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(sizes, pa.int64()), pa.array(grams, pa.binary())], ["lang", "n_grams", "grams"]
            )

    return docs.select("lang", "text").mapInArrow(rows, "lang string, n_grams long, grams binary").where("grams is not null")


def _below(rows: DataFrame, places: int) -> DataFrame:
    """``(lang, grams)`` with the n-grams at lower places only."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [np.frombuffer(g.as_py(), dtype=np.int32) for g in batch.column("grams")]
            grams = pa.array([g[: np.searchsorted(g, places)].tobytes() for g in grams], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), grams], ["lang", "grams"])

    return rows.select("lang", "grams").mapInArrow(cut, "lang string, grams binary")


def _rows_at_once(grams: int) -> int:
    """Rows of presence of ``grams`` n-grams, as 4-byte numbers, that are held at a time."""
    return min(ROWS, max(ROW_BYTES // (4 * max(grams, 1)), 1))


def shared(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Numbers of n-grams that rows have in common with landmarks (columns)."""
    found = np.zeros((len(rows), landmarks.shape[1]), dtype=np.float32)
    step = max(SLICE * 8 // max(landmarks.shape[1], 1), 1)
    for at in range(0, len(landmarks), step):
        found += rows[:, at : at + step] @ landmarks[at : at + step].astype(np.float32)
    return found


@dataclass(frozen=True)
class LanguageModel:
    """Languages, the landmarks' n-grams, and the matrices of the two products: presence of the n-grams in the
    landmarks, in bytes as there are the more landmarks the more languages, and weights."""

    languages: tuple[str, ...]
    grams: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray
    #: Only n-grams at lower places count.
    places: int = FEATURES

    def score(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Regression outputs for rows of presence of ``grams``, with all n-grams that count in ``sizes``."""
        kernel = shared(rows, self.landmarks) / np.sqrt(np.maximum(sizes, 1))[:, None]
        return np.concatenate((kernel, np.ones((len(kernel), 1), dtype=np.float32)), axis=1) @ self.weights


def _first_of_each(rows: DataFrame, order: list[str], each: int) -> DataFrame:
    """The first ``each`` rows of every language.

    Every task sends that many at most, and as one language has rows in all tasks, they are ranked twice: among
    groups of tasks, then among the groups. Group g has tasks g * g to g * g + 2 * g, so with t tasks nobody
    reads the rows of more than some 2 * sqrt(t) others.
    """
    group = F.floor(F.sqrt(F.spark_partition_id().cast("double")))
    rows = rows.withColumn("group", group)
    for keys in (["lang", "group"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= each).drop("rank")
    return rows.drop("group")


def sample(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A bounded sample of the labelled rows, the same number of each language, by hash of the id.

    Rows that repeat an id count each: of those with drawn ids the first ones stay, by id and text.
    """
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    each = max(MIN_ROWS, rows // max(labelled.select("lang").distinct().count(), 1))
    draw = F.xxhash64(F.col("doc_id"), F.lit(7))
    # Only ids are ranked first; the texts of the drawn ones follow.
    ranked = _first_of_each(labelled.select("lang", "doc_id", draw.alias("draw")), ["draw", "doc_id"], each)
    drawn = broadcast_if_small(materialize(ranked.select("doc_id").distinct(), "drawn"))
    found = labelled.join(drawn, "doc_id", "left_semi").withColumn("draw", draw)
    return _first_of_each(found, ["draw", "doc_id", "text"], each).drop("draw")


def fit(docs: DataFrame, learn: Column | None = None) -> LanguageModel | None:
    """A model learnt from the rows ``(doc_id, text, lang)`` where ``learn`` holds; None without any."""
    drawn = materialize(presence_rows(sample(docs, F.lit(True) if learn is None else learn)), "sample")
    total = drawn.agg(F.sum("n_grams")).first()[0]
    if not total:
        return None
    # Places are even, so a part of them holds that part of the n-grams.
    places = min(FEATURES, FEATURES * SAMPLE_BYTES // (4 * total))
    rows = sorted((row.lang, bytes(row.grams)) for row in _below(drawn, places).collect())
    return _fitted([(lang, np.frombuffer(grams, dtype=np.int32)) for lang, grams in rows], places)


def _fitted(rows: list[tuple[str, np.ndarray]], places: int = FEATURES) -> LanguageModel:
    """A model from languages and sorted places of n-grams, of which those below ``places`` are known of every row."""
    languages = tuple(sorted({lang for lang, _ in rows}))
    grams = [g[: np.searchsorted(g, places)] for _, g in rows]
    place = {lang: k for k, lang in enumerate(languages)}
    labels = np.array([place[lang] for lang, _ in rows])
    # Landmarks: the same number of each language, spread over its rows.
    marks = []
    for k in range(len(languages)):
        own = np.flatnonzero(labels == k)
        wanted = min(len(own), max(LANDMARKS // len(languages), MIN_LANDMARKS))
        marks += list(own[np.linspace(0, len(own) - 1, wanted).astype(int)])
    used = np.unique(np.concatenate([grams[i] for i in marks]))
    if len(used) * len(marks) > MODEL_BYTES:
        used = used[: max(MODEL_BYTES // len(marks), 1)]
        places = int(used[-1]) + 1
        grams = [g[: np.searchsorted(g, places)] for g in grams]

    def matrix(picked: list[int], kind: type = np.float32) -> np.ndarray:
        dense = np.zeros((len(picked), len(used)), dtype=kind)
        for row, i in enumerate(picked if len(used) else []):
            at = np.searchsorted(used, grams[i])
            at[at == len(used)] = 0
            dense[row, at[used[at] == grams[i]]] = 1
        return dense

    sizes = np.array([max(len(g), 1) for g in grams], dtype=np.float64)
    landmarks = np.ascontiguousarray(matrix(marks, np.uint8).T)
    scale = 1 / np.sqrt(sizes[marks])

    step = _rows_at_once(len(used))

    def kernels(picked: list[int]) -> np.ndarray:
        return np.concatenate(
            [shared(matrix(picked[at : at + step]), landmarks) for at in range(0, len(picked), step)]
        )

    among = kernels(marks) * np.outer(scale, scale)
    values, vectors = np.linalg.eigh(among)
    held = values > 1e-6 * values[-1]
    # Nyström map: kernel with the landmarks times the inverse root of the kernel among them.
    root = vectors[:, held] / np.sqrt(values[held])
    mapped = (kernels(list(range(len(grams)))) / np.sqrt(sizes)[:, None] * scale) @ root
    mapped = np.concatenate((mapped, np.ones((len(mapped), 1))), axis=1)
    targets = np.where(labels[:, None] == np.arange(len(languages)), 1.0, -1.0)
    ridge = RIDGE * np.eye(mapped.shape[1])
    beta = np.linalg.solve(mapped.T @ mapped + ridge, mapped.T @ targets)
    weights = np.concatenate((scale[:, None] * (root @ beta[:-1]), beta[-1:]))
    return LanguageModel(languages, used, landmarks, weights.astype(np.float32), places)


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs (doc_id, text)``, from the text alone.

    ``score`` is the share of the best language among the exponentials of the outputs. A text that
    is null or has no letter is ``und`` with score 0, as is every text without a model.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        flags = np.zeros(FEATURES, dtype=bool)
        at_once = _rows_at_once(len(model.grams)) if model is not None else ROWS
        for batch in batches:
            for first in range(0, batch.num_rows, at_once):
                part = batch.slice(first, at_once)
                langs: list[str] = [UNKNOWN] * part.num_rows
                scores = np.zeros(part.num_rows)
                if model is not None:
                    rows = np.zeros((part.num_rows, len(model.grams)), dtype=np.float32)
                    sizes = np.zeros(part.num_rows, dtype=np.float32)
                    for i, text in enumerate(part.column("text")):
                        if presence(text.as_py() or "", flags):
                            rows[i] = flags[model.grams]
                            sizes[i] = max(np.count_nonzero(flags[: model.places]), 1)
                    outputs = model.score(rows, sizes).astype(np.float64)
                    odds = np.exp(SHARPNESS * (outputs - outputs.max(axis=1, keepdims=True)))
                    best = outputs.argmax(axis=1)
                    for i in np.flatnonzero(sizes):
                        langs[i] = model.languages[best[i]]
                        scores[i] = 1 / odds[i].sum()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(classify, "doc_id long, lang_pred string, score double")


def fold(doc_id: str = "doc_id") -> Column:
    """Fold 0 to 3 of a document; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4


def held_out_languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learn on three folds, predict all rows.

    ``docs (doc_id, text, lang)``. Rows of fold 2 are held out; null langs are not learnt from.
    Repeated rows are rows like others, other columns are ignored, an empty table gives no rows. Texts of any
    length are read whole for their prediction. Where two languages score the same, the first by name is predicted.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    found = predict(rows, fit(rows, fold() != 2))
    return found.select("doc_id", (fold() == 2).alias("held_out"), "lang_pred", "score")
