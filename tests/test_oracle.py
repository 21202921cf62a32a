"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tests.compare import connect, difference

SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees(name, spark, sf_dir, con):
    assert difference(driver.queries()[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["empresa", "periodo", "total"]
