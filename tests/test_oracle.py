"""Every query against its SQL statement, over the whole smallest tables."""

import os

import comparing
import pytest

import __spark_entry__ as entry_points
from tillhouse.queries import REGISTRY

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    connection = comparing.open_tables(SF_DIR)
    yield connection
    connection.close()


def test_every_query_of_the_library_has_its_sql():
    assert set(REGISTRY) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, tables, name):
    assert comparing.differences(QUERIES[name](spark, SF_DIR), tables, SQL[name]) == []


def test_entry_has_rows(spark):
    result = entry_points.entry(spark)
    assert result.columns[:2] == ["product_id", "store_id"]
    assert result.limit(1).count() == 1
