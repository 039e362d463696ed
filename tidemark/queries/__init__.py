"""Registered queries over the given tables, each with its SQL beside it."""

from __future__ import annotations

import importlib

MODULES = ("basics", "joins", "aggregates", "values", "temporal", "writes", "business", "changes", "loading")


def all_queries() -> dict:
    """Name -> (function, SQL or None), in module order."""
    from tidemark.queries.registry import QUERIES

    for module in MODULES:
        importlib.import_module(f"tidemark.queries.{module}")
    return dict(QUERIES)
