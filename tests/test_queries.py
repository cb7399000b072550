"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from harvestry.plans import catalog
from tests.compare import difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.QUERIES, catalog.ORACLE_SQL


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_every_query_is_an_entry():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert difference(spark, SF, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["word", "shift"] and result.count() > 0
