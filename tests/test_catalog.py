"""Every registered query against its DuckDB SQL, on the smallest tables."""

import pytest
from check_oracle import compare, connect

from tunewright import catalog

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    difference = compare(spark, duck, name, QUERIES[name], ORACLES[name], SF)
    assert difference in (None, "no rows")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
