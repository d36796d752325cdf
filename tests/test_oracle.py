"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from tests import compare
from workload import queries as registered

SF_DIR = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()
QUERIES = {name: query for name, query in entry_points.queries().items() if name in SQL}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert registered.queries().keys() <= SQL.keys()
    assert SQL.keys() == QUERIES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_answer(spark, duck, name):
    columns, rows = compare.of_spark(QUERIES[name](spark, SF_DIR))
    assert (columns, rows) == compare.of_duckdb(duck, SQL[name])


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
