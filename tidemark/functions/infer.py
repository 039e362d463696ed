"""Types of text values, by the fixed order number, boolean, date, null, string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the text loader.
NULL_TEXT = r"\N"
WHOLE = r"^-?\d+$"
DECIMAL = r"^-?\d+\.\d+$"
BOOLEAN = r"^(?i)(t|true|f|false)$"
DATE = r"^\d{4}-\d{2}-\d{2}$"
DATE_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

# Kinds that share a column widen to the first type able to hold both.
# Whole numbers that the wider type would round stay exact: as decimals, or as text.
WIDENING = {
    frozenset({"long"}): "bigint",
    frozenset({"wide"}): "bigint",
    frozenset({"long", "wide"}): "bigint",
    frozenset({"huge"}): "decimal(38,0)",
    frozenset({"long", "huge"}): "decimal(38,0)",
    frozenset({"wide", "huge"}): "decimal(38,0)",
    frozenset({"long", "wide", "huge"}): "decimal(38,0)",
    frozenset({"double"}): "double",
    frozenset({"long", "double"}): "double",
    frozenset({"boolean"}): "boolean",
    frozenset({"date"}): "date",
    frozenset({"timestamp"}): "timestamp_ntz",
    frozenset({"date", "timestamp"}): "timestamp_ntz",
}


def kind_of(text: Column) -> Column:
    """The kind of one text value; calendar-invalid dates are strings.

    Whole numbers are ``long`` up to 2^53, which doubles hold too, then ``wide`` up to
    64 bits, ``huge`` up to 38 digits, and strings beyond.
    """
    whole = text.rlike(WHOLE)
    number = text.try_cast("bigint")
    return (
        F.when(text.isNull() | (text == NULL_TEXT), "null")
        .when(whole & number.between(-(1 << 53), 1 << 53), "long")
        .when(whole & number.isNotNull(), "wide")
        .when(whole & text.try_cast("decimal(38,0)").isNotNull(), "huge")
        .when(text.rlike(DECIMAL), "double")
        .when(text.rlike(BOOLEAN), "boolean")
        .when(text.rlike(DATE) & text.try_cast("date").isNotNull(), "date")
        .when(text.rlike(DATE_TIME) & text.try_cast("timestamp_ntz").isNotNull(), "timestamp")
        .otherwise("string")
    )


def column_types(texts: DataFrame) -> dict[str, str]:
    """The narrowest type for each text column, from one pass over the data."""
    kinds = texts.agg(*[
        F.collect_set(kind_of(F.col(f"`{c}`"))).alias(str(i)) for i, c in enumerate(texts.columns)
    ]).first()
    return {
        c: WIDENING.get(frozenset(kinds[i]) - {"null"}, "string")
        for i, c in enumerate(texts.columns)
    }


def typed(texts: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Cast text columns to their inferred (or given) types; ``\\N`` becomes NULL."""
    types = types or column_types(texts)
    return texts.select(*[
        F.when(F.col(f"`{c}`") != NULL_TEXT, F.col(f"`{c}`")).try_cast(types[c]).alias(c)
        for c in texts.columns
    ])
