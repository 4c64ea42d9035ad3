"""Every registered query against its SQL."""

import pytest
from check_oracle import connect, difference

import __spark_entry__ as contract
from rankloom.catalog.jobs import JOBS


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "score", "title"] or set(df.columns) == {
        "query_id", "rank", "doc_id", "score", "title"
    }
    assert df.count() > 0


def test_every_search_query_has_sql():
    assert JOBS.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, db, name):
    assert difference(contract.queries()[name](spark, sf_dir), db, contract.oracle_sql()[name]) is None
