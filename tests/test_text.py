from collections import Counter

from model import kept

from rankloom.operators import terms as tx


def words_of(spark, text, stops=()):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [row.term for row in tx.token_table(docs, stops).orderBy("pos").collect()]


def test_words_with_joiners_and_marks(spark):
    assert words_of(spark, "Don't use state-of-the-art @User #tag, 'quoted' a--b ab") == [
        "don't", "use", "state-of-the-art", "@user", "#tag", "quoted",
    ]


def test_short_and_long_words(spark):
    assert words_of(spark, "ab abc") == ["abc"]
    assert [len(w) for w in words_of(spark, "x" * 60)] == [25, 25, 10]


def test_null_empty_and_stop_words_only(spark):
    assert words_of(spark, None) == []
    assert words_of(spark, "") == []
    assert words_of(spark, "The history of references", tx.STOP_WORDS) == []


def test_whole_corpus_equals_the_model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    wanted = Counter()
    for row in docs.collect():
        for term, n in Counter(kept(row.text)).items():
            wanted[(row.doc_id, term, n)] += 1
    got = Counter((r.doc_id, r.term, r.tf) for r in tx.term_counts(docs).collect())
    assert got == wanted


def test_counts_and_length_of_one_document(spark):
    docs = spark.createDataFrame(
        [(1, "moon sun moon the moon"), (2, None), (3, "the of"), (4, "sun")], "doc_id long, text string"
    )
    rows = {(r.doc_id, r.term): (r.tf, r.dl) for r in tx.term_counts(docs).collect()}
    assert rows == {(1, "moon"): (3, 4), (1, "sun"): (1, 4), (4, "sun"): (1, 1)}
    assert {r.doc_id: r.dl for r in tx.doc_terms(docs).collect()} == {1: 4, 2: 0, 3: 0, 4: 1}


def test_stop_word_table(spark):
    own = spark.createDataFrame([("moon",), ("the",)], "term string")
    stops = tx.stop_word_table(spark, ("the", "of"), own)
    assert sorted(r.term for r in stops.collect()) == ["moon", "of", "the"]
    docs = spark.createDataFrame([(1, "the moon and sun")], "doc_id long, text string")
    left = tx.drop_stop_words(tx.token_table(docs, ()), stops)
    assert sorted(r.term for r in left.collect()) == ["and", "sun"]


def test_query_terms_keep_repeats_and_first_position(spark):
    queries = spark.createDataFrame([("a", "the Moon sun moon"), ("b", ""), ("c", None)], "query_id string, query string")
    rows = {(r.query_id, r.term): (r.qtf, r.pos) for r in tx.query_terms(queries).collect()}
    assert rows == {("a", "moon"): (2, 0), ("a", "sun"): (1, 1)}


def test_map_terms_adds_up_words_of_one_stem(spark):
    queries = spark.createDataFrame([(1, "moons sun moon")], "query_id long, query string")
    stems = spark.createDataFrame([("moons", "moon")], "term string, stem string")
    rows = {r.term: (r.qtf, r.pos) for r in tx.map_terms(tx.query_terms(queries), stems).collect()}
    assert rows == {"moon": (2, 0), "sun": (1, 1)}
