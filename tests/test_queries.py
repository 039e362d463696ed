"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from oracle import compare, connect

from tidemark.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    fn, sql = QUERIES[name]
    if sql:
        compare(spark, con, SF_DIR, fn, sql)
    else:
        assert fn(spark, SF_DIR).columns
