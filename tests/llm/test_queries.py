"""Queries of the operators against their SQL, over the smallest tables."""

import os

import pytest

from checks.compare import duckdb_over, held_against
from visitlens.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, connection, name):
    assert held_against(spark, SF_DIR, QUERIES[name], SQL[name], connection) is None
