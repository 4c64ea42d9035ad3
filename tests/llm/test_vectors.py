"""Whitening and hard negatives against plain models, on edge rows and empty tables."""

import numpy as np
import pytest

from rankloom.llm import catalog, hard_negatives, vectors, whitening

ROWS = "vec_id long, embedding array<float>, label int"


def plain_whitening(x):
    """x-vectors: deviations, whitened values by component, explained shares."""
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return ((n * x - sums) ** 2).sum(axis=1), centred @ axes[:, :8] / np.sqrt(values[:8]), values[:8] / values.sum()


@pytest.mark.parametrize("kind", ["random", "equal", "low rank", "scales", "inside"])
def test_rank_one_updates_equal_a_full_decomposition(kind):
    rng = np.random.default_rng(3)
    for k in (1, 2, 7, 40):
        values = {"random": rng.random(k), "equal": np.round(rng.random(k), 1), "low rank": np.zeros(k),
                  "scales": 10.0 ** rng.integers(-9, 9, k), "inside": rng.random(k)}[kind]
        values = np.sort(values)
        axes = np.linalg.qr(rng.normal(size=(k, k)))[0]
        x = axes[:, : max(1, k // 3)].sum(axis=1) if kind == "inside" else rng.normal(size=k)
        got, turned = whitening.rank_one(values, axes, x)
        matrix = axes @ np.diag(values) @ axes.T + np.outer(x, x)
        scale = np.abs(matrix).max()
        assert np.abs(turned @ np.diag(got) @ turned.T - matrix).max() < 1e-13 * k * scale
        assert np.abs(turned.T @ turned - np.eye(k)).max() < 1e-13 * k and (np.diff(got) >= 0).all()


def test_spectra_of_parts_combine_to_that_of_all():
    rng = np.random.default_rng(4)
    x = rng.integers(-400, 400, (300, 12)) * np.arange(1, 13) + 100_000
    scatter = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    for cuts, block in (((), 1), ((1, 2, 150), 64), ((299,), 8)):
        total = whitening.Spectrum.empty(12)
        for part in np.split(x, cuts):
            own = whitening.Spectrum.empty(12)
            own.add(part, block)
            total = whitening.Spectrum.of(total.combine(own).row())
        assert total.n == 300 and total.sums == x.sum(axis=0).tolist()
        assert np.allclose(total.vectors @ np.diag(total.values) @ total.vectors.T, scatter, rtol=0, atol=1e-9 * scatter.max())


@pytest.mark.parametrize("partitions", [1, 40])
def test_whitening_equals_a_plain_model(spark, partitions):
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(400, 10)) * np.arange(10, 0, -1)).astype(np.float32)
    data = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [(900, None, 0), (901, [None] * 10, 0), (902, [float("nan")] * 10, 1), (903, [float("inf")] + [0.0] * 9, None), (904, [1.0], 1)]
    rows = spark.createDataFrame(data + bad, ROWS).selectExpr("*", "'kept' as x", "1 as n", "2 as whitened").repartition(partitions)
    got = sorted(whitening.whitened(rows, block_rows=16).collect(), key=lambda r: (r.component, r.vec_id))
    whole = np.floor(x.astype(float) * 1024).astype(np.int64) + 100_000
    deviation, expected, explained = plain_whitening(whole)
    assert len(got) == 8 * 400
    for c in range(8):
        part = got[400 * c : 400 * c + 400]
        values = np.array([r.whitened for r in part])
        assert np.abs(values - np.sign(values @ expected[:, c]) * expected[:, c]).max() < 1e-9
        assert [r.deviation for r in part] == deviation.tolist() and {r.n for r in part} == {400}
        assert abs(part[0].explained / explained[c] - 1) < 1e-9 and part[0].identity_error < 1e-9


def test_whitening_of_degenerate_tables(spark):
    def rows(*found):
        return spark.createDataFrame([(i, v, 0) for i, v in enumerate(found)], ROWS)

    assert whitening.whitened(rows()).count() == 0
    assert whitening.whitened(rows([1.0, 2.0])).count() == 0
    assert whitening.whitened(rows(*[[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whitened(rows(None, None)).count() == 0
    line = whitening.whitened(rows([0.0, 0.0], [1.0, 1.0], [2.0, 2.0], [2.0, 2.0])).collect()
    assert {r.component for r in line} == {1} and len(line) == 4 and line[0].explained == pytest.approx(1)
    far = whitening.whitened(rows([0.0, 0.0], [1e8, 1.0], [0.0, 1e8])).collect()
    assert {r.deviation for r in far} == {None} and far[0].identity_error < 1e-4


def plain_negatives(rows, positives=5, negatives=10):
    """Rows (vec_id, vector, label) to the contract's result."""
    usable = [(i, np.floor(np.array(v) * 256), label) for i, v, label in rows]
    out = []
    for i, x, label in usable:
        if i % 100:
            continue
        scored = sorted(((-int(x @ y), j, other) for j, y, other in usable if j != i))
        for score, j, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score]
            out += [(i, j, r + 1, s[1], -score, -s[0]) for r, s in enumerate(inside[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("kind, block", [("random", 1024), ("random", 3), ("clusters", 4), ("copies", 2)])
def test_hard_negatives_equal_a_plain_model(spark, kind, block):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 8))
    if kind == "clusters":
        x = rng.normal(size=(6, 8))[np.arange(900) % 6] * 5 + x / 20
    if kind == "copies":
        x[::3] = x[0]
    rows = [(i, v.astype(np.float32).astype(float).tolist(), int(i * 7 % 4)) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, ROWS).selectExpr("*", "'kept' as x", "2 as rank", "3 as anchor").repartition(5)
    got = hard_negatives.hard_negatives(table, block_anchors=block).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)


def test_bounds_spare_scores_of_far_candidates():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(8, 16)) * 400
    anchors = np.rint(centres[np.arange(64) % 8] + rng.normal(size=(64, 16)))
    candidates = np.rint(centres[np.arange(400) % 8] + rng.normal(size=(400, 16)))
    block = hard_negatives.Block(np.arange(64), np.zeros(64), anchors.astype(np.int64), *hard_negatives.spanning_tree(anchors))
    scored, truth = 0, candidates @ anchors.T
    best = truth.max(axis=0)
    for a, chosen, scores in block.visit(candidates.astype(np.int64), lambda a, low, high: high >= 0.95 * best[a]):
        scored += len(chosen)
        assert (scores == truth[chosen, a]).all()
        assert set(np.flatnonzero(truth[:, a] >= 0.95 * best[a])) <= set(chosen)
    assert scored < 0.3 * truth.size


def test_hard_negatives_on_edge_rows(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], ROWS)).count() == 0
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (2, [0.5, 0.0], 2),
            (None, [1.0, 0.0], 1), (3, None, 1), (4, [1.0, None], 1), (5, [float("nan"), 0.0], 1), (6, [1.0, 0.0], None),
            (7, [1.0, 0.0, 0.0], 2), (8, [1e30, 0.0], 1), (100, [1.0, 1.0], 9)]
    got = sorted(map(tuple, hard_negatives.hard_negatives(spark.createDataFrame(rows, ROWS)).collect()))
    # Both rows of the anchor find both rows of 1, and for each both rows of 2; 100 has no positive.
    assert got == [(0, 1, rank, 2, 65536, 32768) for rank in (1, 2) for _ in range(4)]


def test_huge_whole_numbers_are_exact(spark):
    rows = [(0, [200_000.0, 3.0], 1), (1, [250_000.0, 1.0], 1), (2, [150_000.0, 7.0], 2)]
    got = [tuple(r) for r in hard_negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()]
    x = {i: [int(c * 256) for c in v] for i, v, _ in rows}
    dot = lambda a, b: sum(p * q for p, q in zip(x[a], x[b]))
    assert got == [(0, 1, 1, 2, dot(0, 1), dot(0, 2))]


def test_vectors_of_most_rows_length(spark):
    rows = [(i, [1.0] * (2 + i % 3 // 2), 0) for i in range(9)]
    found = vectors.whole_vectors(spark.createDataFrame(rows, ROWS), "embedding", 2, 1, 100)
    assert [len(r.x) for r in found.collect()] == [2] * 6 and found.first().x == [3, 3]


def test_queries_cover_their_table(spark, sf_dir):
    vectors_read = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert catalog.op12_whitening(spark, sf_dir).count() == 8 * vectors_read.count()
    anchors = catalog.op13_hard_negatives(spark, sf_dir).select("anchor_id").distinct().count()
    assert 0 < anchors <= vectors_read.where("vec_id % 100 = 0").count()
