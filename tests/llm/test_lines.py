"""Shared lines against a plain model, over many ranges."""

import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from rankloom.llm import catalog, line_dedup


def key(line):
    line = line.strip(" \t\n\v\f\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def model(rows, min_docs, min_chars=1, keep_first=False):
    """Kept text of each (doc_id, text)."""
    documents = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    places = defaultdict(list)
    for row in documents:
        for at, line in enumerate((row[1] or "").split("\n")):
            if len(key(line)) >= min_chars:
                places[key(line)].append((row, at))
    dropped = defaultdict(set)
    for found in places.values():
        if len({row for row, _ in found}) >= min_docs:
            for row, at in found[1:] if keep_first else found:
                dropped[row].add(at)
    return {row: "\n".join(x for at, x in enumerate((row[1] or "").split("\n")) if at not in dropped[row]) for row in documents}


def corpus(documents=300):
    random.seed(11)
    lines = [f"line {i}" for i in range(40)] + [" Line 3\t", "LINE 4\r", "", "  ", "É", "é", "ß"]
    rows = [(i, "\n".join(random.choices(lines, k=random.randrange(0, 9)) + ["everywhere"])) for i in range(documents)]
    return rows + [(1000, None), (1001, ""), (None, "everywhere\nx"), (1002, "\n".join(["everywhere"] * 5000))]


def test_dropped_lines_equal_a_plain_model(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for min_docs, min_chars, keep_first in ((10, 1, False), (40, 1, True), (1, 5, True), (2, 3, False)):
        expected = model(rows, min_docs, min_chars, keep_first)
        # With many small ranges the common lines are cut several times.
        spark.conf.set("spark.sql.shuffle.partitions", 40)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        try:
            kept = line_dedup.without_shared_lines(docs.withColumn("keep", F.lit(1)), min_docs, min_chars, keep_first)
            assert kept.columns == ["doc_id", "text", "keep"]
            got = {r.doc_id: r.text for r in kept.collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
        assert got.pop(1000) is None
        assert got == {row[0]: text for row, text in expected.items() if row[0] != 1000}


def test_bitmaps_are_compressed_and_only_for_documents_that_lose_lines(spark):
    rows = [(i, "shared\nown " + str(i)) for i in range(12)] + [(50, "nothing\nshared here")]
    found = line_dedup.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in found) == list(range(12))
    assert all(list(line_dedup.unpacked(r.keep, r.n_lines)) == [False, True] for r in found)
    assert all(r.n_dropped == 1 and len(zlib.decompress(r.keep)) == 1 for r in found)


def test_edge_rows_and_empty_tables(spark, edge_rows):
    docs = edge_rows.selectExpr("*", "1 as keep", "2 as n_lines", "3 as text_hash")
    rows = line_dedup.line_digest(docs, min_docs=2).collect()
    assert len(rows) == 8 and {r.n_lines for r in rows if r.doc_id in (1, 2)} == {1}
    # Both rows of 4 are one document, the row without an id is another one.
    assert [r.n_dropped for r in rows if r.doc_id == 4] == [1, 1]
    assert line_dedup.without_shared_lines(docs, 2).columns == docs.columns
    assert line_dedup.line_digest(docs.limit(0)).count() == 0
    assert line_dedup.line_digest(docs.limit(0)).columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def test_query_covers_every_document(spark, sf_dir):
    rows = catalog.op11_line_dedup(spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert rows.where("n_dropped > 0").count() > 0
