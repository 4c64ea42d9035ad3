"""The same queries in SQL for DuckDB."""

from __future__ import annotations

from rankloom.catalog import fixtures as fx
from rankloom.catalog.fixtures import EDGE_QUERIES, VIEW_MONTH
from rankloom.catalog.jobs import DEEP_RESULTS, SAMPLE_TERM
from rankloom.functions.text import STOP_WORDS
from rankloom.operators.index import BLOCK_IDS, MIN_DF, NUM_BUCKETS
from rankloom.operators.stems import MAX_ENDING, MIN_PAIRS, MIN_SHARE, MIN_STEM

PATTERN = r"[#@\p{L}\p{N}_](?:[''\-]?[\p{L}\p{N}_]){2,24}"


def _quoted(words: tuple[str, ...]) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


def _tokens(name: str, table: str, key: str, text: str, stops: str | None) -> str:
    """CTE ``name(key, pos, term)``."""
    where = f"where term not in ({stops})" if stops else ""
    return f"""
    {name}_words as (select {key}, regexp_extract_all(lower({text}), '{PATTERN}') as found from {table}),
    {name}_all as (select {key}, unnest(range(len(found))) as raw_pos, unnest(found) as term from {name}_words),
    {name} as (
      select {key}, row_number() over (partition by {key} order by raw_pos) - 1 as pos, term from {name}_all {where}
    )"""


STOPS = _quoted(STOP_WORDS)
DOC_TOKENS = _tokens("doc_tokens", "documents", "doc_id", "text", STOPS)
QUERIES = "(select item_id as query_id, text from benchmark)"
QUERY_TOKENS = _tokens("query_tokens", QUERIES, "query_id", "text", STOPS)
WITH_EDGES = f"(from {QUERIES} union all values {', '.join(map(str, EDGE_QUERIES))})"
FACTS = f"""{DOC_TOKENS},
    facts as (select term, doc_id, count(*) as tf from doc_tokens group by all),
    lengths as (select doc_id, sum(tf)::bigint as dl from facts group by doc_id),
    corpus as (select count(*) as n, avg(dl) as avgdl from lengths),
    stats as (select term, count(*) as df, sum(tf)::bigint as term_total from facts group by term)"""
QUERY_TERMS = f"""{QUERY_TOKENS},
    query_terms as (select query_id, term, count(*) as qtf, min(pos)::int as pos from query_tokens group by all)"""
STEMS = f"""
    cuts as (
      select term, left(term, len(term) - cut) as stem, right(term, cut) as ending
      from stats, (select unnest(range(1, {MAX_ENDING} + 1)) as cut) where len(term) - cut >= {MIN_STEM}
    ),
    seen as (select *, stem in (select term from stats) as known from cuts),
    regular as (
      select ending from seen group by ending
      having count(*) filter (known) >= {MIN_PAIRS} and count(*) filter (known) >= {MIN_SHARE} * count(*)
    ),
    parents as materialized (
      select term, max(stem) as stem from seen where known and ending in (select ending from regular) group by term
    ),
    chains as (
      select term, stem from parents
      union all
      select chains.term, parents.stem from chains join parents on parents.term = chains.stem
    ),
    stems as (select term, arg_min(stem, len(stem)) as stem from chains group by term),
    mapped_terms as (
      select query_id, coalesce(stem, term) as term, sum(qtf)::bigint as qtf, min(pos) as pos
      from query_terms left join stems using (term) group by all
    )"""


def _bm25(name: str, k: int, b: float = 0.7, min_df: int = MIN_DF, terms: str = "query_terms") -> str:
    """CTE ``name(query_id, rank, doc_id, score)``."""
    return f"""
    {name}_scores as (
      select query_id, doc_id, min(pos) as pos,
        sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (1 - {b} + {b} * dl / avgdl))) as score
      from {terms} join stats using (term) join facts using (term) join lengths using (doc_id), corpus
      where df > {min_df} group by query_id, doc_id
    ),
    {name} as (
      select query_id, rank, doc_id, score from (
        select *, row_number() over (partition by query_id order by round(score, 9) desc, pos, doc_id) as rank
        from {name}_scores
      ) where rank <= {k}
    )"""


def _reranked(candidates: str) -> str:
    """CTE ``reranked(query_id, rank, doc_id, score)``."""
    return f"""
    blended as (
      select query_id, rank as text_rank, doc_id, 0.8::double * score + (1 - 0.8::double) * coalesce(pagerank, 0) as final
      from {candidates} left join blending on id = doc_id
    ),
    reranked as (
      select query_id, place as rank, doc_id, final as score from (
        select *, row_number() over (partition by query_id order by round(final, 9) desc, text_rank) as place from blended
      ) where place <= 10
    )"""


TITLES = r"""
    page_titles as (
      select page_id as doc_id, regexp_extract(html, '<title>(.*?)</title>', 1) as title from pages
      where regexp_extract(html, '<title>(.*?)</title>', 1) <> ''
    )"""
ANCHORS = r"""
    found_links as (
      select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>.*?</a>')) as link from pages
    ),
    page_links as (
      select 'p' || page_id as src, regexp_extract(link, 'href="([^"]*)"', 1) as dst,
        regexp_extract(link, '>(.*?)</a>', 1) as text
      from found_links
    )"""
SUPPLIER_EDGES = """
    edges as (
      select distinct a.l_suppkey as src, b.l_suppkey as dst
      from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1
    )"""
PAGE_EDGES = f"{ANCHORS}, edges as (select distinct src, dst from page_links)"


def _pagerank(edges: str) -> str:
    """CTE ``ranks(id, pagerank)``: six rounds written out."""
    parts = [
        edges,
        "vertices as materialized (select src as id from edges union select dst from edges)",
        "degrees as materialized (select src, count(*) as degree from edges group by src)",
        "round_0 as materialized (select id, 1.0::double as value from vertices)",
    ]
    for turn in range(1, 7):
        parts.append(f"""
    round_{turn} as materialized (
      select id, 0.15::double + 0.85::double * coalesce(total, 0) as value
      from vertices left join (
        select dst, sum(value / degree) as total
        from edges join degrees using (src) join round_{turn - 1} on id = src group by dst
      ) on dst = id
    )""")
    parts.append(
        "ranks as (select id, value * (select count(*) / sum(value) from round_6) as pagerank from round_6)"
    )
    return ",".join(parts)


RANKS = _pagerank(SUPPLIER_EDGES)
BLENDING = f"""{RANKS},
    blending as (
      select id, case when (select max(pagerank) > min(pagerank) from ranks)
        then (pagerank - (select min(pagerank) from ranks)) / (select max(pagerank) - min(pagerank) from ranks)
        else 0 end as pagerank
      from ranks
    )"""
SEARCH = f"{FACTS}, {QUERY_TERMS}, {_bm25('candidates', 20)}, {BLENDING}, {_reranked('candidates')}"
JUDGMENTS = """
    needed as (select query_id, count(*) as needed from query_terms group by query_id),
    judgments as (
      select query_id, doc_id from query_terms join facts using (term) join needed using (query_id)
      group by query_id, doc_id, needed having count(*) = needed
    )"""
METRICS = f"""{SEARCH}, {JUDGMENTS},
    queries as (select query_id from {QUERIES}),
    judged as (
      select query_id, rank, case when j.doc_id is null then 0 else 1 end as hit
      from reranked left join judgments j using (query_id, doc_id)
    ),
    shown as (
      select query_id, count(*) as results, count(*) filter (rank <= 5) as shown_5, count(*) filter (rank <= 30) as shown_30,
        sum(hit) filter (rank <= 5) as hits_5, sum(hit) filter (rank <= 30) as hits_30
      from judged group by query_id
    ),
    relevant as (select query_id, count(*) as relevant from judgments group by query_id),
    counts as (
      select query_id, coalesce(results, 0) as results, coalesce(shown_5, 0) as shown_5, coalesce(shown_30, 0) as shown_30,
        coalesce(hits_5, 0) as hits_5, coalesce(hits_30, 0) as hits_30, coalesce(relevant, 0) as relevant
      from queries left join shown using (query_id) left join relevant using (query_id)
    ),
    rates as (
      select query_id, results,
        case when shown_5 = 0 then 0 else printf('%.3f', hits_5 / shown_5)::double end as p5,
        case when relevant = 0 then 1 else printf('%.3f', hits_5 / relevant)::double end as r5,
        case when shown_30 = 0 then 0 else printf('%.3f', hits_30 / shown_30)::double end as p30,
        case when relevant = 0 then 1 else printf('%.3f', hits_30 / relevant)::double end as r30
      from counts
    ),
    scores as (
      select *, case when p5 = 0 or r5 = 0 then 0 else printf('%.3f', 2 / (1 / p5 + 1 / r5))::double end as f5,
        case when p30 = 0 or r30 = 0 then 0 else printf('%.3f', 2 / (1 / p30 + 1 / r30))::double end as f30
      from rates
    ),
    quality as (
      select query_id, results,
        case when p5 = 0 or f30 = 0 then 0 else printf('%.3f', 2 / (1 / p5 + 1 / f30))::double end as quality
      from scores
    )"""
DEEP = METRICS.replace(SEARCH, f"{FACTS}, {QUERY_TERMS}, {_bm25('reranked', DEEP_RESULTS)}").replace(QUERIES, WITH_EDGES)
AVERAGE_PRECISION = """
        running as (
          select query_id, rank, hit, sum(hit) over (partition by query_id order by rank) / rank as precision
          from judged where rank <= 40
        ),
        means as (select query_id, avg(precision) as mean from running where hit = 1 group by query_id)
        select query_id, coalesce(printf('%.3f', mean)::double, 0) as average_precision
        from queries left join means using (query_id)"""
PER_QUERY = "select query_id, results, case when results > 0 then quality end as quality from quality"
RESULT = "select query_id, rank, doc_id, round(score, 6) as score from"
VIEWS = f"""
    views as (
      select user_id as id, count(*) as value from events
      where event_type = 'view' and strftime(ts, '%Y-%m') = '{VIEW_MONTH}' group by user_id
    )"""

FREQUENT_QUERIES = f"""
    placed as (select term, row_number() over (order by df desc, term) as place from stats),
    query_terms as (
      select query_id, term, 1 as qtf, (place <> query_id)::int as pos
      from placed join (select unnest(range(1, {fx.FREQUENT_QUERIES} + 1)) as query_id)
        on place = query_id or place = 2 * query_id + 1
    )"""


def _body(min_df: int) -> str:
    return f"""
        weights as (
          select term, doc_id, tf * ln(n / df) as weight, ln(n / df) as idf
          from facts join stats using (term), corpus where df > {min_df}
        ),
        norms as (select doc_id, sqrt(sum(weight * weight)) as norm from weights group by doc_id),
        query_weights as (
          select query_id, term, qtf * ln(n / df) as query_weight
          from query_terms join stats using (term), corpus where df > {min_df}
        ),
        query_norms as (
          select query_id, sqrt(sum(query_weight * query_weight)) as query_norm from query_weights group by query_id
        ),
        dots as (
          select query_id, doc_id, sum(weight * query_weight) as dot
          from query_weights join weights using (term) group by all having dot > 0
        ),
        cosines as (
          select query_id, doc_id, dot / (norm * query_norm) as score
          from dots join norms using (doc_id) join query_norms using (query_id)
        )
        select query_id, rank, doc_id, round(score, 6) as score from (
          select *, row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as rank from cosines
        ) where rank <= 100"""


LATER_VIEWS = """
    moved as (
      select user_id as id, case when event_id % 3 = 0 then ts + interval 1 month else ts end as ts
      from events where event_type = 'view'
    )"""

ORACLE: dict[str, str] = {
    "corpus_count": "select count(*) as pages from documents",
    "tokens": f"with {DOC_TOKENS} select doc_id, pos::int as pos, term from doc_tokens",
    "tokens_stop_table": f"""with {_tokens("raw", "documents", "doc_id", "text", None)}
        select doc_id, pos::int as pos, term from raw
        where term not in ({STOPS}) and term not in (select lower(n_name) from nation)""",
    "term_counts": f"with {FACTS} select term, doc_id, tf from facts",
    "query_terms": f"with {QUERY_TERMS} select * from query_terms",
    "stems": f"with recursive {FACTS}, {QUERY_TERMS}, {STEMS} select * from stems",
    "mapped_terms": f"with recursive {FACTS}, {QUERY_TERMS}, {STEMS} select * from mapped_terms",
    "titles": f"with {TITLES} select * from page_titles",
    "term_df": f"with {FACTS} select term, df from stats",
    "term_totals": f"with {FACTS} select term, term_total from stats",
    "frequent_terms": f"with {FACTS} select term, df from stats where df > {MIN_DF}",
    "postings": f"with {FACTS} select term, doc_id, tf from facts join stats using (term) where df > {MIN_DF}",
    "posting_lists": f"""with {FACTS}
        select term, doc_id // {BLOCK_IDS} as block, string_agg(doc_id || ':' || tf, ' ' order by doc_id) as postings
        from facts join stats using (term) where df > {MIN_DF} group by all""",
    "posting_of_term": f"with {FACTS} select doc_id, tf from facts where term = '{SAMPLE_TERM}'",
    "bucket_sizes": f"""with {FACTS}
        select (('0x' || left(md5(term), 10))::bigint % {NUM_BUCKETS})::int as bucket,
          count(*) as terms, sum(df)::bigint as postings
        from stats group by 1""",
    "doc_lengths": f"with {FACTS} select * from lengths",
    "corpus_stats": f"with {FACTS} select n, round(avgdl, 6) as avgdl from corpus",
    "index_after_add": f"with {FACTS} select * from stats",
    "index_after_add_pruned": f"with {FACTS} select * from stats where df > {MIN_DF}",
    "bm25_after_add_pruned": f"with {FACTS}, {QUERY_TERMS}, {_bm25('found', 10)} {RESULT} found",
    "bm25_after_add": f"with {FACTS}, {QUERY_TERMS}, {_bm25('found', 10, min_df=0)} {RESULT} found",
    "saved_doc_lengths": f"with {FACTS} select * from lengths",
    "saved_titles": f"with {TITLES} select * from page_titles",
    "saved_pagerank": f"with {RANKS} select id, round(pagerank, 6) as pagerank from ranks",
    "query_idf": f"""with {FACTS}, {QUERY_TERMS},
        frequent as (select term, df from stats where df > {MIN_DF})
        select query_id, term, coalesce(df, 0) as df,
          round(ln(1 + (n - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5)), 6) as idf
        from query_terms left join frequent using (term), corpus""",
    "query_idf_zero": f"""with {FACTS}, {QUERY_TERMS},
        frequent as (select term, df from stats where df > {MIN_DF})
        select query_id, term, coalesce(df, 0) as df,
          case when df is null then 0 else round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) end as idf
        from query_terms left join frequent using (term), corpus""",
    "bm25_top10": f"with {FACTS}, {QUERY_TERMS}, {_bm25('found', 10)} {RESULT} found",
    "bm25_all_terms_top10": f"with {FACTS}, {QUERY_TERMS}, {_bm25('found', 10, min_df=0)} {RESULT} found",
    "bm25_by_term_top10": f"with {FACTS}, {QUERY_TERMS}, {_bm25('found', 10)} {RESULT} found",
    "bm25_separate_lengths_top10": f"with {FACTS}, {QUERY_TERMS}, {_bm25('found', 10)} {RESULT} found",
    "bm25_classic_top10": f"""with recursive {FACTS}, {QUERY_TERMS}, {STEMS},
        {_bm25('found', 10, b=0.75, terms='mapped_terms')} {RESULT} found""",
    "rerank": f"""with {FACTS}, {QUERY_TERMS}, {_bm25('candidates', 30)}, {BLENDING}, {_reranked('candidates')}
        {RESULT} reranked""",
    "search": f"""with {SEARCH}, {TITLES}
        select query_id, rank, doc_id, round(score, 6) as score, coalesce(title, 'UNKNOWN TITLE') as title
        from reranked left join page_titles using (doc_id)""",
    "search_without_artifacts": f"""with {FACTS}, {QUERY_TERMS}, {_bm25('found', 10)}
        select query_id, rank, doc_id, round(0.8::double * score, 6) as score, 'UNKNOWN TITLE' as title from found""",
    "body_search": f"with {FACTS}, {QUERY_TERMS}, {_body(MIN_DF)}",
    "body_search_frequent_terms": f"with {FACTS}, {FREQUENT_QUERIES}, {_body(0)}",
    "bm25_frequent_terms_top10": f"with {FACTS}, {FREQUENT_QUERIES}, {_bm25('found', 10, min_df=0)} {RESULT} found",
    "title_search": f"""with {QUERY_TERMS}, {TITLES}, {_tokens("title_tokens", "page_titles", "doc_id", "title", STOPS)}
        select query_id, doc_id, title, count(distinct term) as matches
        from query_terms join title_tokens using (term) join page_titles using (doc_id) group by all""",
    "anchor_search": f"""with {QUERY_TERMS}, {ANCHORS}, {_tokens("anchor_tokens", "page_links", "dst", "text", STOPS)}
        select query_id, dst as doc_id, count(distinct term) as matches
        from query_terms join anchor_tokens using (term) group by all""",
    "pageview_lookup": f"""with {VIEWS},
        asked as (
          select c_custkey as request_id, unnest([0, 1, 2])::int as pos,
            unnest([c_custkey, c_nationkey::bigint, c_custkey]) as id
          from customer
        )
        select request_id, pos, id, coalesce(value, 0) as value from asked left join views using (id)""",
    "monthly_page_views": f"with {VIEWS} select * from views",
    "stored_page_views": f"""with {LATER_VIEWS}
        select id, count(*) as value from moved where strftime(ts, '%Y-%m') = '{fx.NEXT_MONTH}' group by id""",
    "stored_pageview_lookup": f"""with {LATER_VIEWS},
        counted as (select id, count(*) as value from moved where strftime(ts, '%Y-%m') = '{VIEW_MONTH}' group by id),
        asked as (
          select c_custkey as request_id, unnest([0, 1])::int as pos, unnest([c_custkey, c_nationkey::bigint]) as id
          from customer
        )
        select request_id, pos, id, coalesce(value, 0) as value from asked left join counted using (id)""",
    "edges": f"with {SUPPLIER_EDGES} select * from edges",
    "link_rows": f"with {ANCHORS} select src, dst from page_links",
    "vertices": f"with {PAGE_EDGES} select src as id from edges union select dst from edges",
    "pagerank": f"with {RANKS} select id, round(pagerank, 6) as pagerank from ranks",
    "pagerank_sinks": f"with {_pagerank(PAGE_EDGES)} select id, round(pagerank, 6) as pagerank from ranks",
    "pagerank_normalized": f"with {BLENDING} select id, round(pagerank, 6) as pagerank from blending",
    "pagerank_normalized_max": f"""with {RANKS}
        select id, round(pagerank / (select max(pagerank) from ranks), 6) as pagerank from ranks""",
    "pagerank_normalized_sum": f"""with {RANKS}
        select id, round(pagerank / (select sum(pagerank) from ranks), 6) as pagerank from ranks""",
    "pagerank_lookup": f"""with {RANKS},
        asked as (
          select o_orderkey as request_id, unnest([0, 1, 2])::int as pos,
            unnest([o_custkey, o_orderkey, o_custkey]) as id
          from orders
        )
        select request_id, pos, id, round(coalesce(pagerank, 0), 6) as value from asked left join ranks using (id)""",
    "judgments": f"with {FACTS}, {QUERY_TERMS}, {JUDGMENTS} select * from judgments",
    "stored_judgments": f"""with {FACTS}, {QUERY_TERMS}, {JUDGMENTS}
        select distinct text as query, doc_id from {QUERIES} q left join judgments using (query_id)""",
    "average_precision": f"with {METRICS}, {AVERAGE_PRECISION}",
    "average_precision_edge_queries": f"with {DEEP}, {AVERAGE_PRECISION}",
    "precision_recall_f1": f"with {METRICS} select query_id, p5 as precision, r5 as recall, f5 as f1 from scores",
    "results_quality": f"with {METRICS} select query_id, quality from quality",
    "eval_per_query": f"with {METRICS} {PER_QUERY}",
    "eval_edge_queries": f"with {DEEP} {PER_QUERY}",
    "bm25_edge_queries": f"with {FACTS}, {QUERY_TERMS}, {_bm25('found', 10)} {RESULT} found".replace(QUERIES, WITH_EDGES),
    "eval_summary": f"""with {METRICS}
        select count(*) as processed, count(*) filter (results > 0) as successful,
          round(avg(quality) filter (results > 0), 6) as average_quality
        from quality""",
}
