"""Every registered query runs; those with SQL give its rows."""

import pytest
from compare import connection, rows_of_query, rows_of_sql

import __spark_entry__ as entry
from quillmill import queries as core


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    assert rows_of_query(core.QUERIES[name](spark, sf_dir)) == rows_of_sql(duck, core.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLES)))
def test_rows_without_sql(spark, sf_dir, name):
    assert core.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(core.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
