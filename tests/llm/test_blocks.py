"""Decontamination in bounded memory: distinct windows, one block at a time. Recall of the quality rules."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rankloom.llm import decontaminate, quality


class Counted:
    """A broadcast that counts how many of its kind are loaded."""

    loaded = most = 0

    def __init__(self, block):
        self._kept = block

    @property
    def value(self):
        if "_value" not in vars(self):
            Counted.loaded += 1
            Counted.most = max(Counted.most, Counted.loaded)
            self._value = Handle(self._kept)
        return self._value


class Handle:
    def __init__(self, block):
        vars(self).update(vars(block))
        self.expanded = block.expanded

    def __del__(self):
        Counted.loaded -= 1


def hashes(*words):
    return np.array(words, dtype=np.uint64)


def test_one_block_at_a_time():
    blocks = [Counted(decontaminate.Block([(i, hashes(i + 1, i + 2))], 13)) for i in range(20)]
    shard = decontaminate.Shard(hashes(*range(1, 30)), np.array([0, 10, 29]), 13)
    n_hit, found = decontaminate._judged(shard, blocks)
    assert Counted.most == 1 and Counted.loaded <= 1
    # The second document begins with 11.
    assert list(n_hit) == [10, 11] and [x.to_pylist() for x in decontaminate._item_lists(2, found)] == [
        [sorted(map(str, range(9))), sorted(map(str, range(10, 20)))]
    ]


def test_equal_windows_are_searched_once():
    tracemalloc.start()
    block = decontaminate.Block([(i, hashes(7)) for i in range(2000)] + [(5000, hashes(7, 8))], 13)
    assert len(block.start) == 2 and len(block.item) == 2001
    shard = decontaminate.Shard(np.full(4000, 7, dtype=np.uint64), np.arange(0, 4001, 2), 13)

    class Whole:
        value = block

    n_hit, found = decontaminate._judged(shard, [Whole()])
    rows = 0
    for lists in decontaminate._item_lists(2000, found):
        assert lists.value_lengths().to_pylist() == [2000] * len(lists)
        rows += len(lists)
    assert rows == 2000 and set(n_hit) == {2}
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()


def test_windows_with_equal_hashes_stay_apart(monkeypatch):
    monkeypatch.setattr(decontaminate, "mixed", lambda values: np.zeros_like(values))
    block = decontaminate.Block([(1, hashes(1, 2, 3)), (2, hashes(4, 5, 6)), (3, hashes(1, 2, 3)), (4, hashes(9))], 2)
    found = sorted(tuple(block.words[s : s + n]) for s, n in zip(block.start, block.length))
    assert set(found) == {(1, 2), (2, 3), (4, 5), (5, 6), (9,)}


def test_matches_name_every_item(spark, docs):
    bench = spark.createDataFrame([(i, "a b c d") for i in range(3)] + [(9, None)], "item_id long, text string")
    rows = decontaminate.longest_matches(docs("x a b c d y", None), bench, 3).collect()
    assert sorted(tuple(r) for r in rows) == [(0, i, 1, 0, 4) for i in range(3)]


def test_labelled_junk_is_rejected_and_good_text_kept(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    judged = quality.quality(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(labels, "doc_id")
    long = judged.where(~F.col("base_failed") & (F.col("n_words") >= quality.COMPARED_WORDS))
    share = {r.label: r.kept for r in long.groupBy("label").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[0] <= 0.1 and share[1] >= 0.99


def plain_distance(p, q):
    p, q = np.array(p), np.array(q)
    m = (p + q) / 2
    part = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a > 0)
    return np.sqrt(max((part(p) + part(q)) / 2, 0.0))


def test_class_distances_equal_a_plain_model(spark):
    import regex

    texts = ["Plain words, 12 of them. " * 30, "| + = " * 60, "ÀÉ ß 漢字 😀 " * 20, "x"]
    rows = [(i, t, "en" if i < 2 else None) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}

    def classes(text):
        count = lambda pattern: len(regex.findall(pattern, text))
        upper, digit, space, punctuation = (count(p) for p in (r"\p{Lu}", r"\p{N}", r"[\x20\x09-\x0D]", r"\p{P}"))
        letters = count(r"\p{L}")
        return np.array([letters - upper, upper, digit, space, punctuation, len(text) - letters - digit - space - punctuation], float)

    reference = classes(texts[0]) + classes(texts[1])
    for i, text in enumerate(texts):
        found = classes(text)
        assert abs(got[i].class_distance - plain_distance(found / found.sum(), reference / reference.sum())) < 1e-9
