"""The pipeline's stages on nulls, empty tables, repeated rows and columns with clashing names."""

import corpus_pipeline
from rankloom.llm import mixing, pii


def test_stages_keep_extra_columns_whatever_their_names(spark, edge_rows, tmp_path):
    edge_rows.sparkSession.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    words = " ".join(f"plain{i} words{i}" for i in range(60))
    more = spark.createDataFrame([(i, f"{words} {i} " * 2, "en", "a") for i in (10, 10, 11)], edge_rows.schema)
    docs = edge_rows.unionByName(more).selectExpr("*", "1 as round", "'w' as words", "2 as size", "3 as key", "4 as part", "5 as Round_2")
    names = docs.columns
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, str(tmp_path))
            assert table.columns[: len(names)] == names, name
        rows = table.collect()
        assert table.columns == [*names, "round_3", "words_2"]
        assert {r["words"] for r in rows} <= {"w"}


def test_names_are_free_whatever_their_case():
    assert mixing._free_name("round", ["a"]) == "round"
    assert mixing._free_name("round", ["ROUND", "round_2"]) == "round_3"


def test_the_key_comes_from_the_session(spark):
    drawn = pii.session_key(spark)
    assert len(drawn) == 32 and drawn == pii.session_key(spark)
    spark.conf.set(pii.KEY_SETTING, "my own")
    try:
        assert pii.session_key(spark) == b"my own"
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_pseudonyms_are_a_permutation_of_each_format():
    forward, back = pii.Feistel(b"k"), pii.Feistel(b"k", inverse=True)
    for digits in ("4111 1111 1111 %s", "1984-02-%s"):
        values = []
        for n in range(28):
            tail = f"{n + 1:02d}" if "-" in digits else f"{n:03d}"
            text = digits % tail
            if "-" not in digits:
                text += str(pii._luhn(text.replace(" ", "")))
            values.append(text)
        coded = [pii.pseudonymized(v, forward) for v in values]
        assert len(set(coded)) == len(values) and [pii.pseudonymized(c, back) for c in coded] == values
