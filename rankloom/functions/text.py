"""Tokenizing expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is '#', '@' or a word character, followed by 2 to 24 word characters, each
# of which may have one apostrophe or hyphen before it. Word characters are spelled out because
# Java's \w is ASCII only; possessive quantifiers match the same words without backtracking.
WORD_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?+[\p{L}\p{N}_]){2,24}+"

# English stop words.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
    he him his himself she she's her hers herself it it's its itself they them their theirs themselves
    what which who whom this that that'll these those am is are was were be been being have has had having
    do does did doing a an the and but if or because as until while of at by for with about against between
    into through during before after above below to from up down in out on off over under again further then
    once here there when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren aren't
    couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn
    mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't
    wouldn wouldn't
    """.split()
)

# Words too common in the corpus to tell pages apart.
CORPUS_STOP_WORDS = tuple(
    """
    category references also external links may first see history people one two part thumb including
    second following many however would became
    """.split()
)

STOP_WORDS = ENGLISH_STOP_WORDS + CORPUS_STOP_WORDS


def words(text: Column | str) -> Column:
    """All words of a text in order, lower-cased; a null text has none."""
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def without(tokens: Column, stop_words: Iterable[str]) -> Column:
    """Drop the stop words of an array; order and repeats stay."""
    stops = sorted(set(stop_words))
    return F.filter(tokens, lambda word: ~word.isin(stops)) if stops else tokens


def tokens(text: Column | str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Words of a text less the stop words."""
    return without(words(text), stop_words)


def term_bucket(term: Column | str, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the first 5 bytes of the MD5 digest, the same in any engine."""
    return (F.conv(F.substring(F.md5(term), 1, 10), 16, 10).cast("long") % buckets).cast("int")
