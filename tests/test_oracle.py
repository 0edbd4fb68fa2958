"""Every query with SQL gives the rows of its SQL; every other one gives rows."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    columns, got = spark_rows(entry.queries()[name](spark, SF_DIR))
    want_columns, want = sql_rows(duck, entry.oracle_sql()[name])
    assert columns == want_columns
    assert got == want


OWN = {name for name, query in entry.queries().items() if query.__module__.startswith("caudal.catalog")}


@pytest.mark.parametrize("name", sorted(OWN - set(entry.oracle_sql())))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["day", "hour", "visits"]
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
