from __future__ import annotations

QUERIES: dict = {}


def query(sql: str | None):
    """Register the decorated ``(spark, sf_dir) -> DataFrame`` under its own name."""

    def add(fn):
        QUERIES[fn.__name__] = (fn, sql)
        return fn

    return add
