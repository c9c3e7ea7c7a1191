"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tradewatch import queries as registry
from tests.oracle import connect, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    assert rows
    names, expected = duck_rows(duck, ORACLES[name])
    assert columns == names
    assert rows == expected
