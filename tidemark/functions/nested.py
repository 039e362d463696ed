"""Access to arrays, records and VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nth(array: Column | str, index: int) -> Column:
    """Element by 0-based position, NULL out of range."""
    return F.get(array, F.lit(index))


def element(array: Column | str, position: int) -> Column:
    """Element by 1-based position as SQL ``a[n]`` counts, NULL out of range."""
    return F.try_element_at(F.col(array) if isinstance(array, str) else array, F.lit(position))


def path(value: Column | str, *steps, as_type: str = "string") -> Column:
    """Value at a path of keys and 0-based positions, NULL if absent or another type."""
    text = "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in steps)
    return F.try_variant_get(value, text, as_type)


def kind(value: Column | str) -> Column:
    """Name of the type a VARIANT holds in this row."""
    return F.schema_of_variant(value)


def scalar_key(value: Column | str, as_type: str = "bigint") -> Column:
    """A polymorphic column as a join key: scalars only, arrays and records give NULL."""
    return F.try_variant_get(value, "$", as_type)
