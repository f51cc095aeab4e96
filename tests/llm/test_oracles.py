"""The queries that SQL can express, against DuckDB."""

import pytest
from check_oracle import compare, connect

from tunewright.llm import registry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracles()


def test_every_operator_has_a_query():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None
