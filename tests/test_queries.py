"""Every registered query next to its SQL."""

import re

import pytest

import __spark_entry__ as entry_points
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()
# The training-data queries, where they are in the tree, have tests of their own.
QUERIES = {n: q for n, q in entry_points.queries().items() if n != "pipeline" and not re.match(r"op\d+_", n)}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name], SQL[name], spark, con, SF_DIR) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_points.queries())
