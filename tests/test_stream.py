import tempfile

from rankloom.operators.index import term_statistics
from rankloom.plans.build_index import build_index
from rankloom.plans.search import bm25
from rankloom.streaming.ingest import index_stream, load_stream_index


def test_stream_of_documents_builds_the_same_index(spark):
    folder = tempfile.mkdtemp(prefix="stream-test-")
    docs = spark.createDataFrame(
        [(1, "moon sun moon"), (2, "moon star"), (3, "sun star dust"), (4, None)], "doc_id long, text string"
    )
    queries = spark.createDataFrame([(1, "moon star")], "query_id long, query string")
    for part in ("doc_id <= 2", "doc_id > 2"):
        docs.where(part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    for _ in range(2):
        run = index_stream(source, f"{folder}/index", buckets=3).option("checkpointLocation", f"{folder}/state")
        query = run.trigger(availableNow=True).start()
        query.awaitTermination(120)
    grown, whole = load_stream_index(spark, f"{folder}/index"), build_index(docs, min_df=0, buckets=3)
    sort = lambda df: sorted(tuple(r) for r in df.collect())
    assert sort(grown.term_stats.select("term", "df", "term_total")) == sort(term_statistics(whole.postings))
    assert sort(grown.doc_lengths) == sort(whole.doc_lengths)
    assert sort(bm25(grown, queries)) == sort(bm25(whole, queries))
