"""Whitening of embeddings by an incremental eigendecomposition of their covariance.

Each task keeps the count, the mean and the spectrum (eigenvalues and eigenvectors) of the scatter matrix of
the vectors it has seen. A vector enters as one centred rank-one update: in the basis of the eigenvectors
the new scatter is a diagonal matrix plus z z', whose eigenvalues are the roots of the secular equation
1 + sum z_j^2 / (d_j - x) = 0. Entries with no weight, and all but one of equal eigenvalues after a
rotation, are deflated: they stay as they are. A long block of vectors enters as the rows of its
triangular factor, which have the same scatter, so a block costs as many updates as there are dimensions.

The spectra of the tasks are combined in levels, each by successive rank-one updates: one for every
eigenvector of the smaller side and one for the distance of the means. The basis so found goes through the
vectors once more: the scatter of the projected vectors, centred exactly, gives the final rotation
(Rayleigh-Ritz), so rounding of the many updates does not stay in the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rankloom.durable import materialize
from rankloom.llm.vectors import matrix, merged, whole_vectors

# An entry c is taken as floor(1024 * c) + 100000; components that are returned.
FACTOR, OFFSET = 1024, 100_000
COMPONENTS = 8

#: Entries are whole numbers below this after scaling.
LIMIT = 1 << 40

#: Vectors of a block, see above; a block of no more vectors than dimensions goes in one by one.
BLOCK_ROWS = 2048

#: Entries of z this much smaller than the largest value, and eigenvalues this close, are deflated.
_TINY = 8 * np.finfo(float).eps

#: Eigenvalues below this share of the largest are zero: their components cannot be whitened.
_RANK = 1e-12


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z_j^2 / (d_j - x) = 0 for increasing ``d`` and ``z`` without zeros.

    Each root is returned as its nearest pole and the distance to it, which keeps all digits of
    differences between roots and poles. The root behind pole i lies before pole i+1, the last one within |z|^2.
    """
    k, weight = len(d), z * z
    span = np.append(np.diff(d), weight.sum())
    here, middle = np.arange(k), span / 2
    gaps = d[None, :] - d[:, None]  # pole j as seen from pole i
    value = 1 + (weight / (gaps - middle[:, None])).sum(axis=1)
    nearer_right = (value < 0) & (here < k - 1)
    origin = here + nearer_right
    gaps = d[None, :] - d[origin][:, None]
    low = np.where(nearer_right, -middle, np.where(value < 0, middle, 0.0))
    high = np.where(nearer_right, 0.0, np.where(value < 0, span, middle))
    left, right = np.where(nearer_right, -span, 0.0), np.where(nearer_right, 0.0, span)
    found, on_left = (low + high) / 2, here[None, :] <= here[:, None]
    todo = here
    for _ in range(80):
        at = found[todo]
        apart = gaps[todo] - at[:, None]
        terms = weight / apart
        value = 1 + terms.sum(axis=1)
        settled = np.abs(value) <= k * np.finfo(float).eps * (1 + np.abs(terms).sum(axis=1))
        settled |= high[todo] - low[todo] <= np.finfo(float).eps * np.abs(at)
        if settled.all():
            break
        todo, at, value, terms, apart = (v[~settled] for v in (todo, at, value, terms, apart))
        below = value <= 0
        low[todo], high[todo] = np.where(below, at, low[todo]), np.where(below, high[todo], at)
        # All poles on one side of the root are replaced by the nearest one, with equal value and slope.
        slopes = terms / apart
        a = np.where(on_left[todo], slopes, 0.0).sum(axis=1)
        b = slopes.sum(axis=1) - a
        inner = todo < k - 1
        to_left, to_right = left[todo] - at, np.where(inner, right[todo] - at, 1.0)
        rest = value - a * to_left - b * to_right
        p, q = a * to_left * to_left, b * to_right * to_right
        # rest + p / (to_left - step) + q / (to_right - step) = 0, and q = 0 behind the last pole.
        c1 = -(rest * (to_left + to_right) + p + q)
        c0 = rest * to_left * to_right + p * to_right + q * to_left
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(c1 * c1 - 4 * rest * c0, 0.0))
            half = -(c1 + np.where(c1 >= 0, root, -root)) / 2
            one, two = half / rest, c0 / half
            step = np.where((one > to_left) & (one < to_right), one, two)
            step = np.where(inner, step, to_left + p / rest)
            new = at + step
        outside = ~np.isfinite(new) | (new <= low[todo]) | (new >= high[todo])
        found[todo] = np.where(outside, (low[todo] + high[todo]) / 2, new)
    return origin, found


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (increasing) and eigenvectors of ``vectors diag(values) vectors' + x x'``."""
    z = vectors.T @ x
    scale = max(abs(values[-1]), abs(values[0]), float(z @ z))
    if scale == 0:
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    # Equal eigenvalues: rotate the weight of one into the next, so that it can stay.
    live = np.flatnonzero(z * z > _TINY * _TINY * scale)
    close = np.flatnonzero(np.diff(values[live]) <= _TINY * scale)
    for i in close:
        a, b = live[i], live[i + 1]
        length = np.hypot(z[a], z[b])
        c, s = z[b] / length, z[a] / length
        vectors[:, a], vectors[:, b] = c * vectors[:, a] - s * vectors[:, b], s * vectors[:, a] + c * vectors[:, b]
        z[a], z[b] = 0.0, length
    live = np.flatnonzero(z * z > _TINY * _TINY * scale)
    if not len(live):
        return values, vectors
    d, w = values[live], z[live]
    origin, shift = secular_roots(d, w)
    # Roots minus poles, and the weights for which the roots found are exact.
    apart = (d[origin] - d[:, None]) + shift  # [pole j, root i]
    poles = d[None, :] - d[:, None]
    np.fill_diagonal(poles, 1.0)
    # The product over i of (root_i - d_j) / (d_i - d_j) is the square of weight j.
    exact = np.sqrt(np.abs(apart / poles).prod(axis=1)) * np.sign(w)
    inner = exact[:, None] / -apart
    inner /= np.linalg.norm(inner, axis=0)
    values[live] = d[origin] + shift
    vectors[:, live] = vectors[:, live] @ inner
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, exact sums, mean, and the eigenvalues and eigenvectors of the scatter matrix of some vectors."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(d: int) -> Spectrum:
        return Spectrum(0, [0] * d, np.zeros(d), np.zeros(d), np.eye(d))

    def _update(self, x: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, x)

    def _join(self, n: int, mean: np.ndarray) -> None:
        """Count and mean with ``n`` vectors more, and the update for the distance of the means."""
        away = mean - self.mean
        if self.n:
            self._update(np.sqrt(self.n * n / (self.n + n)) * away)
        self.mean = self.mean + away * (n / (self.n + n))
        self.n += n

    def add(self, x: np.ndarray, block_rows: int = BLOCK_ROWS) -> None:
        """Take in the rows of ``x`` (whole numbers)."""
        self.sums = [a + int(b) for a, b in zip(self.sums, x.sum(axis=0))]
        for start in range(0, len(x), block_rows):
            block = x[start : start + block_rows].astype(float)
            if len(block) <= block.shape[1]:
                for row in block:
                    self._join(1, row)
                continue
            mean = block.mean(axis=0)
            for row in np.linalg.qr(block - mean, mode="r"):
                self._update(row)
            self._join(len(block), mean)

    def combine(self, other: Spectrum) -> Spectrum:
        """The spectrum of both sets of vectors."""
        big, small = (self, other) if self.n >= other.n else (other, self)
        if small.n:
            for value, vector in zip(small.values, small.vectors.T):
                if value > 0:
                    big._update(np.sqrt(value) * vector)
            big.sums = [a + b for a, b in zip(big.sums, small.sums)]
            big._join(small.n, small.mean)
        return big

    def row(self) -> dict:
        return {"n": self.n, "sums": [str(v) for v in self.sums], "mean": self.mean.tolist(),
                "eigenvalues": self.values.tolist(), "eigenvectors": self.vectors.ravel().tolist()}

    @staticmethod
    def of(row: dict) -> Spectrum:
        d = len(row["mean"])
        vectors = np.array(row["eigenvectors"], dtype=float).reshape(d, d)
        return Spectrum(row["n"], [int(v) for v in row["sums"]], np.array(row["mean"], dtype=float),
                        np.array(row["eigenvalues"], dtype=float), vectors)


_SPECTRUM = ("part long, n long, sums array<string>, mean array<double>, eigenvalues array<double>, "
             "eigenvectors array<double>")


def spectrum(x_rows: DataFrame, block_rows: int = BLOCK_ROWS) -> Spectrum | None:
    """The spectrum of all vectors ``x``, by tasks and then in levels; None if there are none.

    The driver gets one spectrum; its size is that of a square of the dimension.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            x = matrix(batch.column("x"))
            if len(x):
                found = found or Spectrum.empty(x.shape[1])
                found.add(x, block_rows)
        if found:
            yield pa.RecordBatch.from_pylist([found.row() | {"part": TaskContext.get().partitionId()}], schema=schema)

    schema = to_arrow_schema(T.StructType.fromDDL(_SPECTRUM))
    states = x_rows.select("x").mapInArrow(local, _SPECTRUM)
    row = merged(states, Spectrum.of, Spectrum.combine, Spectrum.row)
    return Spectrum.of(row) if row else None


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S exactly, as whole numbers (Python's where 64 bits are too few), and as doubles over n."""
    most = max((abs(s) for s in sums), default=0) + n * int(np.abs(x).max(initial=0))
    kind = np.int64 if most < 1 << 62 else object
    exact = x.astype(kind) * (n if kind is object else np.int64(n)) - np.array(sums, dtype=kind)
    return exact, exact.astype(float) / n


def _deviations(exact: np.ndarray) -> list[int | None]:
    """Sum of squares of each row; null beyond 64 bits."""
    if exact.dtype != object and int(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1] < 1 << 63:
        return (exact * exact).sum(axis=1).tolist()
    found = (sum(int(v) * int(v) for v in row) for row in exact)
    return [v if v < 1 << 63 else None for v in found]


_MOMENTS = "part long, n long, mean array<double>, scatter array<double>"


def _moments(x_rows: DataFrame, n: int, sums: list[int], directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance (divisor n) of the centred vectors on some directions, over all tasks.

    Every block is centred on its own mean before multiplying, and blocks are joined by the distance of their means.
    """

    def load(row: dict) -> tuple[int, np.ndarray, np.ndarray]:
        k = len(row["mean"])
        return row["n"], np.array(row["mean"], dtype=float), np.array(row["scatter"], dtype=float).reshape(k, k)

    def add(a, b):
        away, total = b[1] - a[1], a[0] + b[0]
        return total, a[1] + away * (b[0] / total), a[2] + b[2] + np.outer(away, away) * (a[0] * b[0] / total)

    def save(state) -> dict:
        return {"n": state[0], "mean": state[1].tolist(), "scatter": state[2].ravel().tolist()}

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = matrix(batch.column("x"))
            if len(x):
                y = _centred(x, n, sums)[1] @ directions
                mean = y.mean(axis=0)
                own = (len(y), mean, (y - mean).T @ (y - mean))
                total = own if total is None else add(total, own)
        if total is not None:
            yield pa.RecordBatch.from_pylist([save(total) | {"part": TaskContext.get().partitionId()}], schema=schema)

    schema = to_arrow_schema(T.StructType.fromDDL(_MOMENTS))
    row = merged(x_rows.select("x").mapInArrow(local, _MOMENTS), load, add, save)
    _, mean, scatter = load(row)
    return mean, scatter / n


def whitened(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for every usable row and component.

    Rows whose vector is null, holds null or non-finite entries or has another length than most are left out;
    so are rows with an entry of 2^40 or more after scaling. Repeated rows and null or repeated ids are rows of their
    own; ties of eigenvalues keep the order the decomposition gives them, the same for all rows. Components
    without variance cannot be whitened and have no rows, so one vector, or many equal ones, give none.
    ``deviation`` is null where it does not fit 64 bits. Empty tables give no rows; other columns are ignored.
    The sign of a component makes its largest entry positive.
    """
    spark = rows.sparkSession
    chosen = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    x_rows = materialize(whole_vectors(chosen, "vector", FACTOR, OFFSET, LIMIT), "whole-vectors")
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    found = spectrum(x_rows, block_rows)
    if found is None:
        return spark.createDataFrame([], schema)
    n, sums = found.n, found.sums
    # The basis is orthonormal but for rounding; the rotation inside it comes from one more pass.
    basis = np.linalg.qr(found.vectors[:, ::-1])[0]
    values, turn = np.linalg.eigh(_moments(x_rows, n, sums, basis)[1])
    values, axes = values[::-1], basis @ turn[:, ::-1]
    trace = float(values.sum())
    last = min(components, int((values > _RANK * max(values[0], 0.0)).sum()) if values[0] > 0 else 0)
    if not last:
        return spark.createDataFrame([], schema)
    axes = axes[:, :last]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(last)] < 0, -1.0, 1.0)
    explained = (values[:last] / trace).tolist()
    whitening = axes / np.sqrt(values[:last])
    error = float(np.abs(_moments(x_rows, n, sums, whitening)[1] - np.eye(last)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            exact, centred = _centred(matrix(batch.column("x")), n, sums)
            rows = np.repeat(np.arange(batch.num_rows), last)
            deviation = pa.array(_deviations(exact), pa.int64()).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, last + 1, dtype=np.int32), batch.num_rows)),
                 pa.array(np.full(len(rows), n)), deviation, pa.array((centred @ whitening).ravel()),
                 pa.array(np.tile(explained, batch.num_rows)), pa.array(np.full(len(rows), error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x_rows.select("vec_id", "x").mapInArrow(project, schema)
