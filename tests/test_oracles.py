"""Every query with comparison SQL must give the same rows at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tests.oracle_compare import compare, duck

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    error, _ = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert error is None


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 180
