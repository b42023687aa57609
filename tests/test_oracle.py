"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from checks import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_all_queries_of_the_reference_have_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["num_oper", "version_id", "value_ts", "priority", "receipt_ts", "origin"]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR) is None
