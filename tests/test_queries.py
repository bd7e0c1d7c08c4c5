"""Every registered query at the smallest scale: against SQL where there is SQL, else it must give rows."""

import pytest

import __spark_entry__ as entry
from oracle import database, differences

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], SQL[name], FOLDER) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    result = entry.entry(spark)
    assert result.count() > 0 and "anomaly_flag" in result.columns
