"""Declared schemas of the tables the jobs read and write."""

from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


ID = T.LongType()

LINK = _table(("id", ID), ("text", T.StringType()))

CORPUS = _table(
    ("id", ID),
    ("title", T.StringType()),
    ("text", T.StringType()),
    ("anchor_text", T.ArrayType(LINK)),
)

DOC_TEXT = _table(("doc_id", ID), ("text", T.StringType()))

POSTINGS = _table(
    ("term", T.StringType()),
    ("doc_id", ID),
    ("tf", T.LongType()),
    ("dl", T.LongType()),
    ("block", T.LongType()),
    ("bucket", T.IntegerType()),
)

IMPACTS = _table(
    ("term", T.StringType()),
    ("block", T.LongType()),
    ("tf", T.LongType()),
    ("dl", T.LongType()),
    ("bucket", T.IntegerType()),
)

TERM_STATS = _table(
    ("term", T.StringType()),
    ("df", T.LongType()),
    ("term_total", T.LongType()),
    ("bucket", T.IntegerType()),
)

DOC_TERMS = _table(
    ("doc_id", ID),
    ("dl", T.LongType()),
    ("terms", T.ArrayType(_table(("term", T.StringType()), ("tf", T.LongType())))),
)

DOC_LENGTHS = _table(("doc_id", ID), ("dl", T.LongType()))

NORMS = _table(("doc_id", ID), ("norm", T.DoubleType()))

GONE = _table(("doc_id", ID))

CORPUS_STATS = _table(("n", T.LongType()), ("avgdl", T.DoubleType()))

VIEW_COUNTS = _table(("id", ID), ("value", T.LongType()), ("month", T.StringType()))

TITLES = _table(("doc_id", ID), ("title", T.StringType()))

PAGERANK = _table(("id", ID), ("pagerank", T.DoubleType()))

JUDGMENTS = _table(("query_id", T.StringType()), ("query", T.StringType()), ("doc_id", ID))
