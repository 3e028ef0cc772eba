"""Every registered query against its SQL, over the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import differences, duckdb_over
from checks.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    assert differences(spark, SF_DIR, name, connection) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["area", "area_level", "product_id", "city_infos", "click_count",
                          "product_name", "product_type"]
    assert df.count() == 50
