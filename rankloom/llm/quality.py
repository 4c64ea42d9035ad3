"""Quality rules: base counts, and divergence from what a language looks like.

All of it is built-in functions on one row per document: a word list is an array, repeated word
windows are neighbours in a sorted array. The only aggregation is the reference: character-class and
common-word counts summed per language over the whole corpus, one short row per language.

A document is rejected by divergence when the Jensen-Shannon distance of its character classes, or
of its common words, from every language reference is above a threshold. The closest language
counts, so a wrong label does no harm; texts below a minimum length are not judged this way.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.durable import materialize

# Words, symbols, and the bounds of the base rules.
WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
MOST_REPEATED = 50

# Common words of the languages that have a reference.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that for it as was with be by on not he his but".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au".split(),
}
VOCABULARY = tuple(sorted({word for words in COMMON_WORDS.values() for word in words}))

#: Words from which a text is long enough to compare, and the largest distances of a kept text. The distance of classes
#: has a long gap in its distribution: nine of ten texts lie below 0.1, and 0.17 is 1.75 times that.
COMPARED_WORDS = 100
FAR_CLASSES = 0.17
FAR_WORDS = 0.4

CLASSES = ("lower", "upper", "digit", "space", "punctuation", "other")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _indices(size: Column) -> Column:
    """0 to size - 1, none for a size below 1."""
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside 3-word windows that the text has twice or more.

    Windows are sorted with their places; equal windows are then neighbours.
    """
    windows = F.transform(
        _indices(F.size("words") - 2),
        lambda i: F.struct(
            F.concat_ws(" ", F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("w"), i.alias("i")
        ),
    )
    rows = rows.withColumn("windows", F.sort_array(windows))
    window = lambda i: F.get("windows", i)["w"]
    # Of each pair of equal neighbours both places count. Twice named, so that it is computed once.
    twice = F.filter(_indices(F.size("windows") - 1), lambda i: window(i) == window(i + 1))
    rows = rows.withColumn("twice", twice)
    places = F.flatten(
        F.transform(
            "twice",
            lambda i: F.flatten(
                F.transform(
                    F.array(F.get("windows", i)["i"], F.get("windows", i + 1)["i"]),
                    lambda p: F.array(p, p + 1, p + 2),
                )
            ),
        )
    )
    count = F.when(F.size("twice") > 0, F.size(F.array_distinct(places))).otherwise(0)
    return rows.withColumn("n_repeat_words", count.cast("long")).drop("windows", "twice")


def _with_histograms(rows: DataFrame) -> DataFrame:
    """Add ``n_words``, ``n_chars``, ``classes`` (characters by class) and ``common`` (by vocabulary entry)."""
    length = lambda text: F.length(text).cast("long")
    rows = rows.withColumn("bare", F.regexp_replace("whole", r"\p{L}+", ""))
    upper = length(F.regexp_replace("whole", r"[^\p{Lu}]+", ""))
    digit = length(F.regexp_replace("bare", r"[^\p{N}]+", ""))
    space = length(F.regexp_replace("bare", r"[^\x20\x09-\x0D]+", ""))
    punctuation = length(F.regexp_replace("bare", r"[^\p{P}]+", ""))
    rows = rows.withColumns(
        {"n_words": F.size("words").cast("long"), "n_chars": length("whole"), "n_bare": length("bare"), "upper": upper, "digit": digit, "space": space,
         "punctuation": punctuation, "found": F.filter("words", lambda w: w.isin(*VOCABULARY))}
    )
    other = F.col("n_bare") - F.col("digit") - F.col("space") - F.col("punctuation")
    lower = F.col("n_chars") - F.col("n_bare") - F.col("upper")
    classes = F.array(lower, F.col("upper"), F.col("digit"), F.col("space"), F.col("punctuation"), other)
    common = F.transform(_literals(VOCABULARY), lambda word: F.size("found") - F.size(F.array_remove("found", word)))
    return rows.withColumn("classes", classes).withColumn("common", common).drop(
        "bare", "n_bare", "upper", "digit", "space", "punctuation", "found"
    )


def _with_counts(rows: DataFrame) -> DataFrame:
    """Add the base counts to rows with ``whole`` (the text) and ``words``."""
    lines = F.filter(F.split("whole", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("lines", lines)
    rows = rows.withColumns(
        {
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace("whole", NOT_SYMBOLS, "")).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        }
    ).drop("lines")
    return _with_repeats(rows)


def _read(docs: DataFrame, text: str) -> DataFrame:
    rows = docs.withColumn("whole", F.coalesce(F.col(text).cast("string"), F.lit("")))
    return rows.withColumn("words", _words(F.col("whole")))


def language_references(histograms: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Class and word shares of each language of ``COMMON_WORDS``, over all rows ``(lang, n_words,
    classes, common)`` of it. One row per such language comes to the driver."""
    sums = lambda name, size: F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(size)])
    rows = (
        histograms.where(F.col("lang").isin(*COMMON_WORDS))
        .groupBy("lang")
        .agg(
            sums("classes", len(CLASSES)).alias("classes"),
            sums("common", len(VOCABULARY)).alias("common"),
            F.sum("n_words").alias("n_words"),
        )
        .collect()
    )
    found = {}
    for row in sorted(rows):
        own = [row.common[VOCABULARY.index(word)] / max(row.n_words, 1) for word in COMMON_WORDS[row.lang]]
        found[row.lang] = [count / max(sum(row.classes), 1) for count in row.classes], [*own, 1 - sum(own)]
    return found


def _literals(values: Iterable) -> Column:
    return F.array(*[F.lit(value) for value in values])


def _distance(shares: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) of an array of shares from the reference."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    parts = F.zip_with(shares, _literals(reference), lambda p, r: part(p, (p + r) / 2) + part(r, (p + r) / 2))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / 2, F.lit(0.0)))


def _own_shares(lang: str) -> Column:
    """Shares of the language's common words, and of all other words."""
    places = _literals(VOCABULARY.index(word) for word in COMMON_WORDS[lang])
    share = lambda count: count / F.greatest("n_words", F.lit(1))
    own = F.transform(places, lambda i: share(F.get("common", i)))
    rest = F.aggregate(places, F.col("n_words"), lambda left, i: left - F.get("common", i))
    return F.array_append(own, share(rest))


def _with_verdict(rows: DataFrame, references: dict[str, tuple[list[float], list[float]]]) -> DataFrame:
    """Add ``class_distance``, ``word_distance``, ``base_failed`` and ``kept``."""

    shares = {f"share_{lang}": _own_shares(lang) for lang in references}
    rows = rows.withColumn("share", F.transform("classes", lambda c: c / F.greatest("n_chars", F.lit(1))))
    rows = rows.withColumns(shares)
    far = lambda found: F.array_min(F.array(*found)) if found else F.lit(0.0)
    classes = [_distance(F.col("share"), reference) for reference, _ in references.values()]
    common = [_distance(F.col(f"share_{lang}"), reference) for lang, (_, reference) in references.items()]
    rows = rows.withColumn("class_distance", far(classes)).withColumn("word_distance", far(common))
    rows = rows.drop("share", *shares)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    close = (F.col("class_distance") <= FAR_CLASSES) & (F.col("word_distance") <= FAR_WORDS)
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~failed & ((F.col("n_words") < COMPARED_WORDS) | close))


def quality(docs: DataFrame) -> DataFrame:
    """Base counts and verdict for every row of ``docs (doc_id, text, lang)``.

    ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance, word_distance)``. A null or empty text has no words and fails the base rules. A
    null or unknown lang adds to no reference; where no language has one, nothing is far. Repeated
    rows and null ids are rows like others; texts go through whole, other columns are ignored, and an empty table gives
    no rows.
    """
    rows = _read(docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string")), "text").drop("text")
    rows = _with_counts(_with_histograms(rows)).drop("whole", "words")
    rows = materialize(rows, "quality")
    return _with_verdict(rows, language_references(rows.select("lang", "n_words", "classes", "common"))).select(
        "doc_id", *COUNTS, "base_failed", "kept", "class_distance", "word_distance"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    The texts are read twice, once for the references and once for the verdict, and never shuffled.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, lang = (f"c{names.index(name)}" for name in ("text", "lang"))
    seen = _with_histograms(_read(plain.select(text, F.col(lang).cast("string").alias("lang")), text))
    references = language_references(seen.select("lang", "n_words", "classes", "common"))
    rows = _with_counts(_with_histograms(_read(plain, text))).drop("whole", "words")
    # An outer generator drops nothing, so the optimizer has no filter to push below the verdict, where
    # it would be computed anew for every use.
    stay = F.explode_outer(F.when(F.col("kept"), F.array(F.lit(True))))
    return _with_verdict(rows, references).withColumn("stay", stay).where("stay").select(
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    )
