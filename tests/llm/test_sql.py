"""Queries that SQL can express, against their SQL on the smallest tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oracle import compare, connect  # noqa: E402

from tidemark.llm.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_matches_sql(spark, name):
    fn, sql = QUERIES[name]
    assert compare(spark, connect(SF_DIR), SF_DIR, fn, sql) > 0
