import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    """A maker of small document tables with a column whose name clashes with those of operators."""

    def make(*texts, lang="en", source="a"):
        rows = [(i, text, lang, source) for i, text in enumerate(texts)]
        return spark.createDataFrame(rows, DOCUMENTS).selectExpr("*", "'kept' as node", "'kept' as size", "'kept' as kept")

    return make


@pytest.fixture(scope="session")
def edge_rows(spark):
    """Nulls in every column, empty and blank texts, repeated rows."""
    rows = [(None, None, None, None), (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None),
            (4, "one two", "en", "b"), (4, "one two", "en", "b"), (None, "one two", "xx", None),
            (5, "word " * 30_000, "en", "b")]
    return spark.createDataFrame(rows, DOCUMENTS)
