"""Column names of namespaced keys."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def normalise(key: str, id_key: str = "_id") -> str:
    """``:movie/title`` -> ``movie$title``; dots and slashes alike become ``$``.

    The key that identifies records, ``id_key``, becomes ``_id``.
    """
    key = key.removeprefix(":")
    if key == id_key:
        return "_id"
    return re.sub(r"[./]", "$", key).replace("-", "_").lower()


def normalise_columns(df: DataFrame, id_key: str = "_id") -> DataFrame:
    names = [normalise(c, id_key) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"different keys normalise to the same column: {clashes}")
    return df.toDF(*names)


def table_identifier(name: str) -> str:
    """Keep letters, digits and underscores of a routed table name."""
    return re.sub(r"[^a-zA-Z0-9_]", "", name)
