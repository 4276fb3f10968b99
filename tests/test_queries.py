"""Every registered query against its SQL on DuckDB, or for rows only."""

import pytest
from check import connect, difference

import __spark_entry__ as entry
from churnloom.plans import registry

SF_DIR = "/root/testdata/sf0.001"
# The optional folder's queries are tested beside it.
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert difference(entry.queries()[name](spark, SF_DIR), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(SQL)))
def test_has_rows(spark, name):
    # The smallest tables have no user on the later side of the split.
    assert entry.queries()[name](spark, "/root/testdata/sf0.01").count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
