"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, queries()[name], oracle_sql().get(name), SF_DIR) == ""


def test_entry(spark):
    assert entry(spark).count() > 0


def test_all_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
