"""Every query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from testbed.compare import actual, connect, expected
from testbed.oracle import ORACLE
from testbed.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got, columns = actual(spark, SF, name)
    want, want_columns = expected(duck, name)
    assert columns == want_columns
    assert got == want
    assert got


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
