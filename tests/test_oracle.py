"""Every registered query against its SQL twin in a second engine."""

import duckdb
import pytest

import __spark_entry__ as contract
from cuebreaks.catalog import ORACLE_SQL, QUERIES
from helpers import SMALL, bag

TABLES = "customer documents events lineitem orders".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_result(spark, duck, name):
    result = contract.queries()[name](spark, SMALL)
    answer = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(result.columns) == sorted(names)
    order = [names.index(c) for c in sorted(names)]
    expected = {}
    for row in answer.fetchall():
        key = tuple(repr(row[i]) for i in order)
        expected[key] = expected.get(key, 0) + 1
    assert bag(result) == expected


def test_entry_has_the_summary_schema(spark):
    from cuebreaks.sources.schemas import SUMMARY

    result = contract.entry(spark)
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in SUMMARY
    ]
    assert result.count() == 5389
