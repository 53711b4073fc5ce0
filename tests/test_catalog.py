"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from vacancia import catalog


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, con, name):
    sql = catalog.oracles().get(name)
    fn = catalog.queries()[name]
    if sql is None:
        assert fn(spark, sf).columns
        return
    problem, _, rows = compare(spark, con, sf, fn, sql)
    assert problem is None, problem
    assert rows > 0
