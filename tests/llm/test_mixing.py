"""The mixture by one row per source, broadcast or joined by split keys."""

import hashlib

from rankloom.llm import mixing
from rankloom.operators import skew

SOURCES = (("a", 700), ("b", 40), (None, 60), ("", 30), ("c", 300), ("blank", 5))


def rows_of(spark):
    rows = [
        (1000 * k + i, "w " * (0 if source == "blank" else i % 7 + 1), source)
        for k, (source, n) in enumerate(SOURCES)
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def taken_of(table):
    return {r.doc_id: (r.size, r.target, r.taken) for r in mixing.mixture(table).collect()}


def test_mixture_equals_a_plain_model(spark):
    rows, table = rows_of(spark)
    got = taken_of(table)
    for name, _ in SOURCES:
        own = sorted((hashlib.md5(str(i).encode()).hexdigest(), i, len(t.split())) for i, t, s in rows if s == name)
        total = sum(size for _, _, size in own)
        target = next(got[i][1] for _, i, _ in own)
        budget = round(target)
        rounds, rest = divmod(budget, total) if total else (0, 0)
        for _, i, size in own:
            extra = min(max(rest, 0), size)
            rest -= size
            assert got[i] == (size, target, rounds * size + extra)
    assert len(got) == len(rows)


def test_one_decision_for_each_source(spark):
    _, table = rows_of(spark)
    sizes = mixing._keyed(table).withColumn("size", mixing._size())
    told = mixing._decisions(sizes).collect()
    assert sorted(r.of for r in told) == ["", "=", "=a", "=b", "=blank", "=c"]
    assert sum(r.n for r in told) == sum(n for _, n in SOURCES)


def test_sources_too_many_to_broadcast_are_split(spark, monkeypatch):
    _, table = rows_of(spark)
    plain = taken_of(table)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    assert taken_of(table) == plain


def test_targets_of_many_sources_equal_a_plain_model(spark):
    names = sorted(f"host{i}" for i in range(700)) + [None]
    sizes = {name: (i * i * 31) % 9973 * (i % 11 > 0) for i, name in enumerate(names)}
    table = spark.createDataFrame([(n, sizes[n]) for n in reversed(names)], "source string, source_size long")
    for weights, share, epochs in (((3, 1, 2), 1.5, 2), ((1, 50), 1.9, 2), ((5,), 3.0, 2), ((1, 2), 0.0, 1)):
        weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
        left, open_, wanted = share * sum(sizes.values()), set(names), {}
        for n in sorted(names, key=lambda n: epochs * sizes[n] / weight[n]):
            level = left / sum(weight[m] for m in open_)
            if epochs * sizes[n] > weight[n] * level:
                break
            wanted[n] = epochs * sizes[n]
            left -= wanted[n]
            open_.remove(n)
        wanted |= {n: weight[n] * left / sum(weight[m] for m in open_) for n in open_}
        found = {r.source: r.target for r in mixing.source_targets(table, weights, share, epochs).collect()}
        assert found.keys() == wanted.keys() and all(abs(found[n] - wanted[n]) < 1e-6 for n in names)


def test_targets_without_sources(spark):
    assert mixing.source_targets(spark.createDataFrame([], "source string, source_size long")).count() == 0
