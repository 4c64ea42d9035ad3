"""Groups around one node, and keys that many classes share, give the same results when they are split."""

import random

from rankloom.llm import components, near_dup, splits
from rankloom.operators import skew


def test_hub_is_split(spark, monkeypatch):
    links = [(0, i) for i in range(1, 60)] + [(100, i) for i in range(40, 99)] + [(200, 201), (201, 202), (203, 202)]
    table = spark.createDataFrame(links, "a long, b long").repartition(4)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    asked = []
    monkeypatch.setattr(components, "split_keys", lambda *a: asked.append(splits.split_keys(*a)) or asked[-1])
    got = {r.node: r.component for r in components.connected_components(table).collect()}
    assert got == {i: 0 for i in [*range(99), 100]} | {i: 200 for i in range(200, 204)}
    assert any(hot is not None for hot in asked)


def near_copies(groups, size):
    random.seed(11)
    texts = []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(120)]
        for i in range(size):
            words = list(base)
            words[random.randrange(120)] = f"x{g}y{i}"
            texts.append(" ".join(words))
    return texts


def test_hot_pairs_heads_and_components_are_split(spark, docs, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(near_dup, "HOT_PAIRS", 3)
    monkeypatch.setattr(near_dup, "HOT_OPEN", 3)
    table = docs(*near_copies(2, 14), "shared by all of them", "shared by all of them too")
    found = {r.doc_id: r.component_id for r in near_dup.near_duplicates(table).collect()}
    assert [found[i] for i in range(30)] == [0] * 14 + [14] * 14 + [28, 29]


def test_last_pass_is_exact_without_any_turn(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dup, "FEW", 0)
    monkeypatch.setattr(near_dup, "HOT_OPEN", 2)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs(*near_copies(2, 6))).collect()}
    assert [got[i] for i in range(12)] == [0] * 6 + [6] * 6
