"""Every registered query beside its reference SQL, on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare, connect

FOLDER = os.environ.get("QUERY_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_reference_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    result = queries()[name](spark, FOLDER)
    if name in oracle_sql():
        assert compare(result, con, oracle_sql()[name]) == ""
    else:
        assert result.count() > 0
