"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from __spark_entry__ import QUERIES, entry, oracle_sql, queries
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_library_query_has_sql():
    """The optional corpus queries that SQL can't express are tested beside their operators."""
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, db, name):
    text, ok = compare(spark, db, SF_DIR, name, queries()[name], oracle_sql()[name])
    assert ok, text


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns[0] == "receipt_id" and df.count() > 0
