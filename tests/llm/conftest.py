import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

from llm_rows import ODD  # noqa: E402


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) rows, with columns that clash with names used inside."""
    def build(rows):
        full = [(d, t, "en", "s", None if t is None else len(t), 1, "x") for d, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, words int, found string")
    return build


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)
