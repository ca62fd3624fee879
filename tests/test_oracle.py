"""Every registered query that SQL can express gives the same rows as SQL."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry_module

SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, sf_dir, con, name):
    assert compare(spark, con, sf_dir, entry_module.queries()[name], SQL[name]) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 4
