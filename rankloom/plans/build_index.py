"""Building, loading, growing, saving and compacting an index.

An index is a list of segments, see :mod:`rankloom.sources.segments`. Building writes one segment; adding documents
writes another one with the new documents only. Rows of one document id are one document, wherever
they come from: a segment that brings more text for a known id holds the whole document anew, names the id
as gone from older segments, and its statistics are the differences. So sums over the segments are those of one build.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import schemas
from rankloom.durable import Scratch, scratch_path, together
from rankloom.functions.text import STOP_WORDS
from rankloom.operators import blocks as bl
from rankloom.operators import index as ix
from rankloom.operators import terms as tx
from rankloom.operators.matching import document_norms
from rankloom.operators.skew import broadcast_if_small, least_that_fits
from rankloom.sources import segments as sg
from rankloom.sources.artifacts import save_postings


@dataclass(frozen=True)
class Index:
    """The tables a search reads.

    The facts are there twice: by term in ``stored_postings``, of which a few terms need only a part, and
    in buckets by document in ``doc_terms``, where sums per document need no shuffle. Both have all terms;
    ``term_stats``, the statistics of the terms above the cut ``min_df``, decide what a query term finds, so a
    term that passes the cut later needs no other postings. ``postings`` are those above the cut. ``all_stats``
    are the statistics of all terms. ``norms`` are the lengths of the documents' TF-IDF vectors for body
    search, in the same buckets; they depend on the whole corpus, so a grown index has none until it is
    compacted or :func:`save_norms` is called. ``impacts`` bound the scores of blocks of documents.
    """

    postings: DataFrame
    term_stats: DataFrame
    doc_lengths: DataFrame
    corpus_stats: DataFrame
    doc_terms: DataFrame | None = None
    all_stats: DataFrame | None = None
    min_df: int = 0
    buckets: int = ix.NUM_BUCKETS
    norms: DataFrame | None = None
    impacts: DataFrame | None = None
    stored_postings: DataFrame | None = None
    path: str | None = None
    version: sg.Version | None = None

    @property
    def by_term(self) -> DataFrame:
        """Postings that a search joins with the terms of the index."""
        return self.postings if self.stored_postings is None else self.stored_postings


def build_index(
    docs: DataFrame,
    path: str | None = None,
    min_df: int = ix.MIN_DF,
    stop_words: Iterable[str] = STOP_WORDS,
    buckets: int = ix.NUM_BUCKETS,
    doc_buckets: int | None = None,
    impact_rows: int = bl.IMPACT_ROWS,
) -> Index:
    """Index ``docs (doc_id, text)`` into the folder ``path``; rows of one ``doc_id`` are one document.

    The text is read and tokenized once; its counted terms are shuffled once into buckets by document, one row per
    document, and once into postings. ``doc_buckets`` is the number of buckets, by default the session's number
    of shuffle partitions; each is read by one task. An index that is there already is replaced at the
    end: readers see the old one until the new one is whole, and keep it if they have loaded it.
    """
    spark = docs.sparkSession
    path = (path or scratch_path(spark, "index")).rstrip("/")
    doc_buckets = doc_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    old = sg.read_version(spark, path)
    empty = sg.Version(old.number if old else -1, (), min_df, buckets, doc_buckets, impact_rows=impact_rows)
    name = (old or empty).next_name()
    return _publish(spark, path, _write_whole(spark, path, empty, name, _counted(docs, doc_buckets, stop_words), True))


def _counted(docs: DataFrame, doc_buckets: int, stop_words: Iterable[str]) -> DataFrame:
    """Documents with their counted terms, in their buckets; the texts move there, which are shorter than the terms."""
    return tx.doc_terms(docs.select("doc_id", "text").repartition(doc_buckets, "doc_id"), stop_words)


def _publish(spark: SparkSession, path: str, version: sg.Version) -> Index:
    sg.publish(spark, path, version)
    return _index(spark, path, version)


def _write_whole(
    spark: SparkSession, path: str, empty: sg.Version, name: str, per_doc: DataFrame, placed: bool = False
) -> sg.Version:
    """A version of one segment, with norms."""
    segment = _write_documents(spark, path, empty, name, per_doc, placed)
    return _with_postings(spark, path, empty, segment, norms=True)


def _doc_table(spark: SparkSession, path: str, version: sg.Version, segments: tuple[sg.Segment, ...]) -> DataFrame:
    names = [s.name for s in segments]
    return sg.bucketed_table(
        spark, f"{path}/doc_terms", schemas.DOC_TERMS, "doc_id", version.doc_buckets, "segment", names
    )


def _visible(rows: DataFrame, spark: SparkSession, path: str, segments: tuple[sg.Segment, ...], number) -> DataFrame:
    """Rows whose document is not gone from their segment; ``number`` is that of a row's segment."""
    replacing = tuple(s for s in segments if s.gone)
    if not replacing:
        return rows
    gone = sg.scan(spark, path, "gone", replacing, schemas.GONE)
    last = gone.groupBy(F.col("doc_id").alias("gone_id")).agg(F.max(sg.segment_number()).alias("gone_in"))
    return rows.join(broadcast_if_small(last), (F.col("doc_id") == F.col("gone_id")) & (number < F.col("gone_in")), "left_anti")


def _documents(spark: SparkSession, path: str, version: sg.Version) -> DataFrame:
    """``(doc_id, dl, terms)`` of all documents, in their buckets."""
    rows = _doc_table(spark, path, version, version.segments)
    return _visible(rows, spark, path, version.segments, sg.segment_number()).select("doc_id", "dl", "terms")


def _merged(parts: DataFrame) -> DataFrame:
    """One row per document from rows ``(doc_id, dl, terms)`` that share ids."""
    flat = parts.select("doc_id", F.explode_outer("terms").alias("t"))
    added = flat.groupBy("doc_id", F.col("t.term").alias("term")).agg(F.sum("t.tf").alias("tf"))
    terms = F.sort_array(F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "tf"))))
    whole = added.groupBy("doc_id").agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("dl"), terms.alias("terms"))
    return whole.select("doc_id", "dl", "terms")


@dataclass(frozen=True)
class _Written:
    """Documents of a segment that are written, its statistics, and documents with tokens in its own rows."""

    segment: sg.Segment
    documents: DataFrame
    rows: int


def _write_documents(
    spark: SparkSession, path: str, version: sg.Version, name: str, per_doc: DataFrame, placed: bool = False
) -> _Written:
    """Write documents ``(doc_id, dl, terms)``, rows of which may share ids, and their statistics.

    ``placed`` rows lie in their buckets already.
    """
    older = version.segments
    sg.write_bucketed(per_doc, f"{path}/doc_terms/segment={name}", "doc_id", version.doc_buckets, placed)
    own = _doc_table(spark, path, version, (sg.Segment(name, 0, 0),)).drop("segment")
    with Scratch(spark) as scratch:
        # Within a bucket, so without a shuffle, and only the ids are read.
        repeated = own.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
        known, minus = None, None
        if older:
            known = _documents(spark, path, version)
            repeated = repeated.union(own.select("doc_id").distinct().join(known.select("doc_id"), "doc_id", "left_semi"))
            repeated = repeated.distinct()
        repeated = scratch.table(repeated, "repeated-ids")
        gone = 0
        if not repeated.isEmpty():
            parts = own
            if known is not None:
                minus = scratch.table(known.join(repeated, "doc_id", "left_semi"), "replaced")
                gone = minus.count()
                minus = minus if gone else None
                parts = own.unionByName(minus) if gone else own
            whole = _merged(parts.join(repeated, "doc_id", "left_semi"))
            merged = scratch.table(own.join(repeated, "doc_id", "left_anti").unionByName(whole), "merged")
            name = version.next_name()
            sg.write_bucketed(merged, f"{path}/doc_terms/segment={name}", "doc_id", version.doc_buckets)
            own = _doc_table(spark, path, version, (sg.Segment(name, 0, 0),)).drop("segment")
            if gone:
                minus.select("doc_id").write.parquet(f"{path}/gone/segment={name}")
        stats = ix.term_statistics(tx.term_facts(own))
        n, total = rows, tokens = _size(own)
        if minus is not None:
            less = ix.term_statistics(tx.term_facts(minus))
            stats = ix.merge_statistics(stats, less.select("term", *[(-F.col(c)).alias(c) for c in ("df", "term_total")]))
            before = _size(minus)
            n, total = rows - before[0], tokens - before[1]
        ix.with_bucket(stats, version.buckets).write.parquet(f"{path}/term_stats/segment={name}")
        return _Written(sg.Segment(name, n, total, gone), own, rows)


def _size(per_doc: DataFrame) -> tuple[int, int]:
    """Documents with tokens, and tokens."""
    found = per_doc.where("dl > 0").agg(F.count("*").alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("total")).first()
    return found.n, found.total


def _with_postings(
    spark: SparkSession, path: str, version: sg.Version, written: _Written, norms: bool = False, source: str | None = None
) -> sg.Version:
    """The next version, with the segment; writes its postings and score bounds, and norms of all if wanted."""
    segment = written.segment
    grown = version.grown(segment, source)

    def postings() -> int:
        placed = bl.with_block(tx.term_facts(written.documents), segment.number, written.rows)
        stats = sg.scan(spark, path, "term_stats", (segment,), schemas.TERM_STATS).select("term", "df", "bucket")
        save_postings(placed, f"{path}/postings/segment={segment.name}", version.buckets, term_stats=stats)
        return _write_impacts(spark, path, version, segment)

    jobs = [postings, lambda: _write_norms(spark, path, grown)] if norms else [postings]
    impacts, *names = together(spark, *jobs)
    grown = version.grown(replace(segment, impacts=impacts), source)
    return replace(grown, norms=names[0] if names else None)


def _write_impacts(
    spark: SparkSession, path: str, version: sg.Version, segment: sg.Segment, to: str | None = None
) -> int:
    """Score bounds of the segment's frequent terms; the number of rows, none where no term is frequent.

    They go to the folder ``to``, by default that of the index. Where the frequent terms are too many to broadcast, the most
    frequent ones have bounds; a search reads all postings of terms that have none.
    """
    own, to = (segment,), to or path
    stats = sg.scan(spark, path, "term_stats", own, schemas.TERM_STATS).select("term", "df")
    frequent = stats.where(F.col("df") >= version.impact_rows)
    least = least_that_fits(frequent, "df")
    frequent = frequent.where(F.col("df") >= least) if least else frequent.where(F.lit(False))
    if frequent.isEmpty():
        return 0
    postings = sg.scan(spark, path, "postings", own, schemas.POSTINGS)
    bl.impacts(postings, frequent).sortWithinPartitions("bucket", "term", "block").write.partitionBy("bucket").parquet(
        f"{to}/impacts/segment={segment.name}"
    )
    return sg.scan(spark, to, "impacts", own, schemas.IMPACTS).count()


def _write_norms(spark: SparkSession, path: str, version: sg.Version) -> str:
    """Norms of all documents in their buckets; without a shuffle of facts where the vocabulary is small."""
    name = version.next_name()
    frequent = ix.frequent_terms(_statistics(spark, path, version), version.min_df)
    norms = document_norms(tx.term_facts(_documents(spark, path, version)), frequent, _sizes(spark, version))
    sg.write_bucketed(norms, f"{path}/norms/version={name}", "doc_id", version.doc_buckets)
    return name


def load_index(spark: SparkSession, path: str, version: int | None = None) -> Index:
    """The newest version of the index in ``path``, or that of a number; an index without one is empty."""
    path = path.rstrip("/")
    found = sg.read_version(spark, path, version)
    if found is None:
        found = sg.Version(-1, (), 0, ix.NUM_BUCKETS, 1)
    return _index(spark, path, found)


def _index(spark: SparkSession, path: str, version: sg.Version) -> Index:
    segments = version.segments
    stats = _statistics(spark, path, version)
    frequent = ix.frequent_terms(stats, version.min_df)
    stored = sg.scan(spark, path, "postings", segments, schemas.POSTINGS).drop("segment")
    stored = _visible(stored, spark, path, segments, F.shiftright("block", sg.BLOCK_BITS))
    with_impacts = tuple(s for s in segments if s.impacts)
    if segments:
        per_doc = _documents(spark, path, version)
    else:
        per_doc = spark.createDataFrame([], schemas.DOC_TERMS)
    norms = None
    if version.norms:
        norms = sg.bucketed_table(
            spark, f"{path}/norms", schemas.NORMS, "doc_id", version.doc_buckets, "version", [version.norms]
        ).drop("version")
    return Index(
        ix.above_cut(stored, frequent) if version.min_df > 0 else stored,
        frequent,
        _lengths(per_doc),
        _sizes(spark, version),
        per_doc,
        stats,
        version.min_df,
        version.buckets,
        norms,
        sg.scan(spark, path, "impacts", with_impacts, schemas.IMPACTS).drop("segment") if with_impacts else None,
        stored,
        path,
        version,
    )


def _statistics(spark: SparkSession, path: str, version: sg.Version) -> DataFrame:
    """Statistics of all terms: the sums over the segments."""
    stats = sg.scan(spark, path, "term_stats", version.segments, schemas.TERM_STATS).drop("segment")
    return ix.merge_statistics(stats).where("df > 0") if len(version.segments) > 1 else stats


def _sizes(spark: SparkSession, version: sg.Version) -> DataFrame:
    """The row of corpus statistics, a constant of the plan; none without segments."""
    n, total = sum(s.n for s in version.segments), sum(s.total for s in version.segments)
    mean = F.lit(total / n if n else None).cast("double")
    row = spark.range(1).select(F.lit(n).cast("long").alias("n"), mean.alias("avgdl"))
    return row if version.segments else row.where(F.lit(False))


def _lengths(per_doc: DataFrame) -> DataFrame:
    return per_doc.where("dl > 0").select("doc_id", "dl")


def add_documents(index: Index, docs: DataFrame, stop_words: Iterable[str] = STOP_WORDS, source: str | None = None) -> Index:
    """The index with more ``docs (doc_id, text)``, the same as one build over old and new documents.

    Writes a segment of the new documents beside the others. The stored index stays as it is until the
    result is saved. Rows whose id the index has already add to that document. ``source`` names what the documents are.
    """
    spark, path, version = docs.sparkSession, index.path, index.version
    if path is None or version is None:
        raise ValueError("only an index that was built or loaded from a folder can grow")
    per_doc = _counted(docs, version.doc_buckets, stop_words)
    written = _write_documents(spark, path, version, version.next_name(), per_doc, True)
    return _index(spark, path, _with_postings(spark, path, version, written, source=source))


def save_index(index: Index, path: str | None = None) -> Index:
    """Publish an index, such as a grown one, in its folder; or write all of it as one segment to another folder.

    In its own folder only the version is written, as its segments are there.
    """
    spark = index.postings.sparkSession
    path = (path or index.path).rstrip("/")
    if path == index.path:
        return _publish(spark, path, index.version)
    version = sg.Version(-1, (), index.min_df, index.buckets, index.version.doc_buckets, impact_rows=index.version.impact_rows)
    if sg.read_version(spark, path) is not None:
        raise ValueError(f"there is an index in {path}")
    return _publish(spark, path, _write_whole(spark, path, version, version.next_name(), index.doc_terms))


def cut_index(index: Index, min_df: int) -> Index:
    """The same stored index under another rare-term cut; nothing is written or published.

    The segments hold all terms, so only what the statistics let through differs. Norms depend on the cut, so they
    are computed per query, as in a grown index.
    """
    if min_df == index.min_df:
        return index
    spark = index.postings.sparkSession
    return _index(spark, index.path, replace(index.version, min_df=min_df, norms=None))


def bound_index(index: Index, impact_rows: int) -> Index:
    """The index with score bounds of the terms with ``impact_rows`` postings or more in a segment.

    They lie in a table beside the stored index, which keeps its own.
    """
    spark, path, to = index.postings.sparkSession, index.path, scratch_path(index.postings.sparkSession, "bounds")
    version = replace(index.version, impact_rows=impact_rows)
    bounded = tuple(s for s in version.segments if _write_impacts(spark, path, version, s, to))
    return replace(index, impacts=sg.scan(spark, to, "impacts", bounded, schemas.IMPACTS).drop("segment"))


def save_norms(index: Index) -> Index:
    """Publish the index with norms for body search, one row per document."""
    spark, path = index.postings.sparkSession, index.path
    version = replace(index.version, number=index.version.number + 1, norms=_write_norms(spark, path, index.version))
    return _publish(spark, path, version)


def compact_index(index: Index, keep: int = 0) -> Index:
    """Put all segments but the first ``keep`` ones together and publish that.

    Many small segments cost a search many small files. What the segments replace in each other is dropped;
    what they replace in the segments kept stays named.
    """
    spark, path, version = index.postings.sparkSession, index.path, index.version
    kept, small = version.segments[:keep], version.segments[keep:]
    if len(small) < 2:
        return index
    name = version.next_name()
    own = _doc_table(spark, path, version, small)
    rows = _visible(own, spark, path, small, sg.segment_number()).select("doc_id", "dl", "terms")
    sg.write_bucketed(rows, f"{path}/doc_terms/segment={name}", "doc_id", version.doc_buckets)
    gone = 0
    if kept and any(s.gone for s in small):
        replaced = sg.scan(spark, path, "gone", tuple(s for s in small if s.gone), schemas.GONE).select("doc_id").distinct()
        replaced.write.parquet(f"{path}/gone/segment={name}")
        gone = sg.scan(spark, path, "gone", (sg.Segment(name, 0, 0),), schemas.GONE).count()
    stats = ix.merge_statistics(sg.scan(spark, path, "term_stats", small, schemas.TERM_STATS).drop("segment"))
    stats.where("df <> 0 or term_total <> 0").select("term", "df", "term_total", "bucket").write.parquet(f"{path}/term_stats/segment={name}")
    segment = sg.Segment(name, sum(s.n for s in small), sum(s.total for s in small), gone)
    documents = _doc_table(spark, path, version, (segment,)).drop("segment")
    written = _Written(segment, documents, _size(documents)[0])
    return _publish(
        spark, path, _with_postings(spark, path, replace(version, segments=kept), written, not kept, version.source)
    )
