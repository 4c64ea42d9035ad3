"""Adding a stream of documents to a stored index."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from rankloom import schemas
from rankloom.functions.text import STOP_WORDS
from rankloom.operators import index as ix
from rankloom.plans.build_index import Index, add_documents, build_index, compact_index, load_index, save_index

#: Segments from which the later ones are put together.
COMPACT_SEGMENTS = 32


def index_stream(
    docs: DataFrame,
    path: str,
    stop_words: Iterable[str] = STOP_WORDS,
    buckets: int = ix.NUM_BUCKETS,
    min_df: int = 0,
    doc_buckets: int | None = None,
    compact_segments: int = COMPACT_SEGMENTS,
) -> DataStreamWriter:
    """A writer that adds each micro-batch of ``docs (doc_id, text)`` to the index in ``path``, from nothing on.

    A batch becomes a segment and counts once its version is published, which is the last thing done and
    names the batch; a batch that is run again after a failure is either there already or not at all. Rows of one
    id are one document, within a batch and across batches. ``min_df`` and the numbers of buckets hold for an
    index that is not there yet. After ``compact_segments`` batches the segments behind the first are put together.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, batch_id, path, stop_words, buckets, min_df, doc_buckets, compact_segments)

    return docs.writeStream.foreachBatch(add)


def add_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    stop_words: Iterable[str] = STOP_WORDS,
    buckets: int = ix.NUM_BUCKETS,
    min_df: int = 0,
    doc_buckets: int | None = None,
    compact_segments: int = COMPACT_SEGMENTS,
) -> None:
    """Add one micro-batch to the index, unless the newest version says that it is there."""
    spark, source = batch.sparkSession, f"batch {batch_id}"
    index = load_index(spark, path)
    if index.version.number < 0:
        none = spark.createDataFrame([], schemas.DOC_TEXT)
        index = build_index(none, path, min_df, stop_words, buckets, doc_buckets)
    if index.version.source == source:
        return
    index = save_index(add_documents(index, batch, stop_words, source))
    if len(index.version.segments) > compact_segments:
        compact_index(index, keep=1)


def load_stream_index(spark: SparkSession, path: str) -> Index:
    """The index of all batches so far."""
    return load_index(spark, path)
