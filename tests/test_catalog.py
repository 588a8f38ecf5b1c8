"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from fieldlab import catalog
from compare import differences, duck
from conftest import SMALL

QUERIES, ORACLES = catalog.load().QUERIES, catalog.load().ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    problem = differences(QUERIES[name](spark, SMALL), con, ORACLES[name])
    assert problem is None, problem


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5
