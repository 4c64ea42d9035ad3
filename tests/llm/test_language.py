"""String kernels against sets of n-grams, over scripts, and within their bounds."""

import random

import numpy as np

from rankloom.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string"


def grams(text):
    """The n-grams of a text as strings, with runs of other than letters as one gap."""
    letters = "".join(c.lower()[0] if c.isalpha() else " " for c in f" {text} ")
    letters = " " + " ".join(letters.split()) + " "
    return {letters[i : i + n] for n in (1, 2, 3) for i in range(len(letters) - n + 1)} - {" "}


def places(text):
    flags = np.zeros(li.FEATURES, dtype=bool)
    assert li.presence(text, flags) == bool(grams(text) - {"  "})
    return np.flatnonzero(flags).astype(np.int32)


def drawn_texts(alphabets, rows, seed):
    random.seed(seed)
    return [
        (k * rows + i, " ".join("".join(random.choices(letters, k=4)) for _ in range(12)), lang)
        for k, (lang, letters) in enumerate(alphabets.items())
        for i in range(rows)
    ]


ALPHABETS = {
    "aa": "abcdefgh", "bb": "efghijkl", "cyr": "абвгдежз", "one": [chr(0x4E00 + i) for i in range(30)],
    "two": [chr(0x4E00 + 252 + i) for i in range(30)], "far": [chr(0x20000 + i) for i in range(20)],
}


def test_places_equal_sets_of_strings():
    texts = ["Ab-c  ab", "", "12 .", "é ß İx", "日本 語", "a", *[t for _, t, _ in drawn_texts(ALPHABETS, 2, 3)]]
    sets = [grams(t) for t in texts]
    found = [places(t) if s else np.zeros(0) for t, s in zip(texts, sets)]
    for x, a in zip(sets, found):
        assert abs(len(a) - len(x)) <= 1  # two n-grams may share a place
        for y, b in zip(sets, found):
            assert abs(len(np.intersect1d(a, b)) - len(x & y)) <= 1


def test_long_texts_are_read_in_slices(monkeypatch):
    text = " ".join(t for _, t, _ in drawn_texts(ALPHABETS, 3, 4))
    whole = places(text)
    monkeypatch.setattr(li, "SLICE", 16)
    assert (places(text) == whole).all()


def test_outputs_equal_ridge_regression_on_plain_kernels():
    rows = drawn_texts(ALPHABETS, 6, 5)
    model = li._fitted([(lang, places(text)) for _, text, lang in sorted(rows, key=lambda r: r[2])])
    rows.sort(key=lambda r: r[2])
    sets = [set(places(text)) for _, text, _ in rows]
    kernel = np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in sets] for x in sets])
    # All rows are landmarks here, so that the map is exact and the dual form gives the same outputs.
    values, vectors = np.linalg.eigh(kernel)
    mapped = np.c_[kernel @ (vectors / np.sqrt(values)), np.ones(len(rows))]
    names = sorted(ALPHABETS)
    targets = np.array([[1.0 if lang == n else -1.0 for n in names] for _, _, lang in rows])
    wanted = mapped @ np.linalg.solve(mapped.T @ mapped + li.RIDGE * np.eye(mapped.shape[1]), mapped.T @ targets)
    dense = np.array([[g in s for g in model.grams] for s in sets], dtype=np.float32)
    got = model.score(dense, np.array([len(s) for s in sets], dtype=np.float32))
    assert model.languages == tuple(names) and np.abs(got - wanted).max() < 1e-3


def test_scripts_are_told_apart_and_bounds_hold(spark, monkeypatch):
    rows = drawn_texts(ALPHABETS, 40, 6)
    rows += [(7, rows[7][1], "aa")] * 200  # one id many times
    table = spark.createDataFrame(rows, SCHEMA)
    lang = {i: name for i, _, name in rows}
    found = li.held_out_languages(table).collect()
    assert len(found) == len(rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in found if r.held_out]) >= 0.97
    assert li.sample(table, li.F.lit(True), 60).count() <= 6 * li.MIN_ROWS
    monkeypatch.setattr(li, "SAMPLE_BYTES", 24_000)
    monkeypatch.setattr(li, "MODEL_BYTES", 12_000)
    model = li.fit(table)
    assert model.landmarks.nbytes <= 12_000 and model.places < li.FEATURES and (model.grams < model.places).all()
    found = li.predict(table, model).collect()
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in found]) >= 0.9


def test_first_rows_of_each_language_over_many_tasks(spark):
    rows = [(k, (k * 7919) % 1009, "hot" if k % 10 else f"l{k % 70}") for k in range(5000)]
    table = spark.createDataFrame(rows, "doc_id long, draw long, lang string").repartition(30)
    found = li._first_of_each(table, ["draw", "doc_id"], 12)
    wanted = {lang: sorted((d, i) for i, d, of in rows if of == lang)[:12] for lang in {r[2] for r in rows}}
    got = {}
    for r in found.collect():
        got.setdefault(r.lang, []).append((r.draw, r.doc_id))
    assert {lang: sorted(of) for lang, of in got.items()} == wanted
    # The cut is made before each of the two shuffles.
    assert found._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 4


def test_empty_tables_and_texts_without_letters(spark):
    table = spark.createDataFrame([(1, "1 2 3", "aa"), (2, None, "aa"), (None, "", None)], SCHEMA)
    assert {r.lang_pred for r in li.held_out_languages(table).collect()} == {"und"}
    assert li.held_out_languages(table.limit(0)).count() == 0
