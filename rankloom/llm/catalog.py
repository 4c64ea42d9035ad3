"""Queries of the operators for training text, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.durable import scratch_path
from rankloom.llm import (
    chat, decontaminate, hard_negatives, html_text, language_id, line_dedup, mixing, near_dup, pii, quality, token_counts,
    warc, whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`language_id.held_out_languages` for nulls, ties, long texts and empty tables."""
    return language_id.held_out_languages(_table(spark, sf_dir, "documents"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`token_counts.token_counts` for nulls, ties, long texts and empty tables."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back; see :func:`warc.write_warc` and :func:`warc.read_warc`.

    The archives stay in the scratch folder, as the result reads them.
    """
    path = scratch_path(spark, "archive")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    return warc.records(warc.read_warc(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`quality.quality` for nulls, ties, long texts and empty tables."""
    return quality.quality(_table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`chat.chat_digest`; a null text is empty, and an empty table leaves conversation -7."""
    tricky = r"\### Assistant: </turn> ok"
    fixed = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digest(chat.conversation_records(rows.unionByName(fixed)))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`pii.pseudonyms` for nulls, ties, long texts and empty tables."""
    return pii.pseudonyms(_table(spark, sf_dir, "documents"), pii.session_key(spark))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`near_dup.near_duplicates` for nulls, ties, long texts and empty tables."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`mixing.mixture` for nulls, ties, long texts and empty tables."""
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`decontaminate.verdicts` for nulls, ties, long texts and empty tables."""
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.with_verdict(decontaminate.verdicts(documents, benchmark))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`html_text.extract` for nulls, ties, long texts and empty tables."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`line_dedup.line_digest`."""
    return line_dedup.line_digest(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`whitening.whitened`."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """See :func:`hard_negatives.hard_negatives`; rows whose id is divisible by 7 get the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", label))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_language, op2_tokens, op3_warc, op4_quality, op5_chat, op6_pseudonyms, op7_near_dup, op8_mixture,
              op9_decontaminate, op10_html, op11_line_dedup, op12_whitening, op13_hard_negatives)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"

_OP3 = """
with p as (
    select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes,
           sha256(coalesce(html, '')) as payload_digest
    from pages),
f as (select payload_digest, min(page_id) as first_page from p where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest,
       case when first_page is not null and page_id is distinct from first_page then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from first_page then first_page end as refers_to
from p left join f using (payload_digest)
"""

_OP5 = r"""
with c as (
    select conv_id, turn, role, text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from c),
e as (
    select *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') as body,
           replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c') as head
    from t)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length('### ' || head || ': ' || body || ' </turn>' || chr(10)))::bigint as formatted_chars
from e group by conv_id
"""

_OP4_COUNTS = rf"""
w as (
    select doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_SPACED}') as words,
           row_number() over () as r
    from documents),
g as (
    select r, unnest(range(1, len(words) - 1)) as i, words from w),
windows as (select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g from g),
twice as (select r, g from windows group by r, g having count(*) > 1),
places as (
    select distinct r, unnest([i, i + 1, i + 2]) as p from windows join twice using (r, g)),
repeats as (select r, count(*) as n from places group by r),
lines as (
    select r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from w),
counts as (
    select doc_id, lang, t, words, len(words)::bigint as n_words,
           length(array_to_string(words, ''))::bigint as word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
           (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
           coalesce(n, 0)::bigint as n_repeat_words
    from w join lines using (r) left join repeats using (r))
"""


def _quality_sql() -> str:
    vocabulary = "[" + ", ".join(f"'{word}'" for word in quality.VOCABULARY) + "]"
    own = ", ".join(
        f"('{lang}', [" + ", ".join(str(quality.VOCABULARY.index(w) + 1) for w in words) + "])"
        for lang, words in quality.COMMON_WORDS.items()
    )
    classes = ", ".join(f"sum(classes[{i + 1}])" for i in range(len(quality.CLASSES)))
    common = ", ".join(f"sum(common[{i + 1}])" for i in range(len(quality.VOCABULARY)))
    return rf"""
with {_OP4_COUNTS},
bare as (
    select *, regexp_replace(t, '\p{{L}}+', '', 'g') as b,
           length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) as upper,
           list_filter(words, lambda x: list_contains({vocabulary}, x)) as found
    from counts),
classed as (
    select *, length(regexp_replace(b, '[^\p{{N}}]+', '', 'g')) as digit,
           length(regexp_replace(b, '[^\x20\x09-\x0D]+', '', 'g')) as space,
           length(regexp_replace(b, '[^\p{{P}}]+', '', 'g')) as punctuation
    from bare),
histograms as (
    select doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, length(t) as n_chars,
           [length(t) - length(b) - upper, upper, digit, space, punctuation, length(b) - digit - space - punctuation] as classes,
           list_transform({vocabulary}, lambda v: len(list_filter(found, lambda x: x = v))) as common
    from classed),
own(lang, places) as (values {own}),
sums as (
    select lang, [{classes}] as classes, [{common}] as common, sum(n_words) as n_words
    from histograms where lang in (select lang from own) group by lang),
refs as (
    select lang, places, list_transform(classes, lambda c: c / greatest(list_sum(classes), 1)) as class_ref,
           list_transform(places, lambda i: common[i] / greatest(n_words, 1)) as own_ref
    from sums join own using (lang)),
pairs as (
    select h.*, list_zip(list_transform(h.classes, lambda c: c / greatest(n_chars, 1)), class_ref) as class_pairs,
           list_zip(list_append(list_transform(places, lambda i: h.common[i] / greatest(n_words, 1)),
                                (n_words - list_sum(list_transform(places, lambda i: h.common[i]))) / greatest(n_words, 1)),
                    list_append(own_ref, 1 - list_sum(own_ref))) as word_pairs
    from histograms h left join refs on true),
distances as (
    select * exclude (class_pairs, word_pairs),
           sqrt(greatest(list_sum(list_transform(class_pairs, lambda z:
               (case when z[1] > 0 then z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) else 0 end)
               + (case when z[2] > 0 then z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) else 0 end))) / 2, 0)) as cd,
           sqrt(greatest(list_sum(list_transform(word_pairs, lambda z:
               (case when z[1] > 0 then z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) else 0 end)
               + (case when z[2] > 0 then z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) else 0 end))) / 2, 0)) as wd
    from pairs),
closest as (
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           coalesce(min(cd), 0) as cd, coalesce(min(wd), 0) as wd
    from distances group by all),
judged as (
    select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words as base_failed from closest)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and (n_words < {quality.COMPARED_WORDS} or (cd <= {quality.FAR_CLASSES} and wd <= {quality.FAR_WORDS})) as kept
from judged
"""


_OP7 = rf"""
with recursive
w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACED}') as words
    from documents),
s as (
    select doc_id, case when len(words) >= 5 then list_distinct(list_transform(range(1, len(words) - 3),
               lambda i: array_to_string(words[i:i + 4], ' '))) when len(words) > 0 then [array_to_string(words, ' ')] else [] end as s
    from w),
n as (select doc_id, len(s)::bigint as n_shingles from s),
g as (select doc_id, unnest(s) as g from s),
links as (
    select a, b from (
        select x.doc_id as a, y.doc_id as b, count(*) as shared from g x join g y on x.g = y.g and x.doc_id <> y.doc_id group by all) p
    join n x on x.doc_id = a join n y on y.doc_id = b
    where 100 * shared >= 75 * (x.n_shingles + y.n_shingles - shared)),
reach(doc_id, other) as (
    select doc_id, doc_id from n
    union select reach.doc_id, links.b from reach join links on reach.other = links.a)
select doc_id, any_value(n_shingles) as n_shingles, min(other) as component_id, doc_id = min(other) as kept
from n join reach using (doc_id) group by doc_id
"""

_OP8 = rf"""
with d as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_SPACED}'))::bigint as size,
           md5(coalesce(doc_id::varchar, '')) as key
    from documents),
s as (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as place
    from d group by source),
r as (
    select *, [3.0::double, 1.0::double, 2.0::double][(place - 1) % 3 + 1] as weight, 2.0::double * source_size as most,
           1.5::double * sum(source_size) over () as wanted
    from s),
l as (
    select *, (wanted - coalesce(sum(most) over (order by most / weight, place rows between unbounded preceding and 1 preceding), 0))
              / sum(weight) over (order by most / weight, place rows between current row and unbounded following) as level
    from r),
t as (
    select *, most <= weight * level as stops,
           arg_min(level, (most / weight, place)) filter (not most <= weight * level) over () as stand
    from l),
b as (
    select source, source_size, case when stops then most else weight * stand end as target from t),
m as (
    select *, round(target)::bigint as budget, case when source_size > 0 then round(target)::bigint // source_size else 0 end as rounds
    from b),
o as (
    select d.doc_id, size, source_size, target, rounds, budget - rounds * source_size as rest,
           coalesce(sum(size) over (partition by d.source order by key, d.doc_id, size
                                    rows between unbounded preceding and 1 preceding), 0) as before
    from d join m on d.source is not distinct from m.source)
select doc_id, size, source_size, target, (rounds * size + least(greatest(rest - before, 0), size))::bigint as taken
from o
"""

_OP9 = rf"""
with d as (
    select doc_id, row_number() over () as r,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents),
i as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from benchmark where item_id is not null),
windows as (
    select distinct item_id, least(13, len(words)) as size,
           unnest(list_transform(range(1, len(words) - least(13, len(words)) + 2),
                                 lambda k: array_to_string(words[k:k + least(13, len(words)) - 1], ' '))) as g
    from i where len(words) > 0),
sizes as (select distinct size from windows),
grams as (
    select r, size, unnest(range(1, len(words) - size + 2)) as k, words from d join sizes on len(words) >= size),
hits as (
    select r, k, grams.size, item_id from grams join windows
    on grams.size = windows.size and array_to_string(words[k:k + grams.size - 1], ' ') = g),
covered as (select r, count(distinct p) as n from (select r, unnest(range(k, k + size)) as p from hits) group by r),
items as (
    select r, count(*) as n, string_agg(item, ',' order by item) as ids
    from (select distinct r, item_id::varchar as item from hits) group by r)
select doc_id, len(words)::bigint as n_words, coalesce(covered.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(covered.n, 0) > 0 and 20 * coalesce(covered.n, 0) >= len(words) as contaminated
from d left join covered using (r) left join items using (r)
"""

_OP11 = f"""
with l as (
    select doc_id, row_number() over () as r, string_split(coalesce(text, ''), chr(10)) as lines from documents),
k as (
    select r, doc_id, i, lines[i] as line,
           translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') as key
    from (select *, unnest(range(1, len(lines) + 1)) as i from l)),
shared as (select key from k where length(key) >= 1 group by key having count(distinct r) >= 10)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (shared.key is not null) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (shared.key is null), '')) as kept_sha256
from k left join shared using (key) group by r
"""

_OP13 = """
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda c: floor(256 * c::double)) as x
    from embeddings
    where label is not null and embedding is not null and vec_id is not null
      and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as (
    select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same, list_dot_product(a.x, r.x)::bigint as score
    from v a join v r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id),
p as (
    select anchor_id, other_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
n as (
    select anchor_id, positive_id, other_id as negative_id, positive_score, score as negative_score,
           row_number() over (partition by anchor_id, positive_id order by score desc, other_id)::int as rank
    from p join s using (anchor_id)
    where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
"""

ORACLE: dict[str, str] = {
    "op3_warc": _OP3,
    "op4_quality": _quality_sql(),
    "op5_chat": _OP5,
    "op7_near_dup": _OP7,
    "op8_mixture": _OP8,
    "op9_decontaminate": _OP9,
    "op11_line_dedup": _OP11,
    "op13_hard_negatives": _OP13,
}
