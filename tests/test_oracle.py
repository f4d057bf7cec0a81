"""Every registered query that has a SQL twin gives the twin's rows."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, con, name):
    assert difference(entry.queries()[name](spark, FOLDER), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.queries())
