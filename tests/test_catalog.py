"""Every registered query against its SQL, on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql
from plugsites.catalog import all_queries
from tests.oracle import connect, sorted_rows

QUERIES = {name: query.build for name, query in all_queries().items()}


@pytest.fixture(scope="module")
def duck(folder):
    connection = connect(folder)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert QUERIES.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, folder, name):
    actual = QUERIES[name](spark, folder)
    expected = duck.sql(oracle_sql()[name])
    assert sorted(actual.columns) == sorted(expected.columns)
    actual_rows = sorted_rows(actual.collect(), actual.columns)
    expected_rows = sorted_rows(expected.fetchall(), expected.columns)
    assert actual_rows, "an empty result proves nothing"
    assert actual_rows == expected_rows


def test_entry_has_rows(spark):
    assert not entry(spark).isEmpty()
