"""Documents as records: inline rows, JSON arrays, one JSON text per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import ID


def from_literals(spark: SparkSession, rows: Sequence[Mapping], schema: str | None = None) -> DataFrame:
    """Literal records.  Records with different keys share one table; gaps are NULL."""
    if schema is not None:
        return spark.createDataFrame([dict(r) for r in rows], schema)
    keys = list(dict.fromkeys(k for r in rows for k in r))
    return spark.createDataFrame([tuple(r.get(k) for k in keys) for r in rows], keys)


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A file holding one JSON array of documents."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One document per line; files split across tasks."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def from_json_text(
    rows: DataFrame, text: str, id_type: str = "string", id_field: str = "_id", payload: str = "doc"
) -> DataFrame:
    """JSON documents as ``_id`` plus one VARIANT column; no field list needed.

    Text that is no JSON, or has no id, is left out; ``rejected_json`` lists it.
    """
    parsed = rows.withColumn(payload, F.try_parse_json(text))
    known = parsed.withColumn(ID, F.try_variant_get(payload, f"$['{id_field}']", id_type))
    return known.where(F.col(ID).isNotNull()).drop(text)


def rejected_json(rows: DataFrame, text: str, id_type: str = "string", id_field: str = "_id") -> DataFrame:
    """The rows that ``from_json_text`` leaves out, with ``reject_reason``."""
    parsed = F.try_parse_json(text)
    reason = (
        F.when(F.col(text).isNull() | (F.trim(text) == ""), "empty value")
        .when(parsed.isNull(), "not json")
        .when(F.try_variant_get(parsed, f"$['{id_field}']", id_type).isNull(), "no id"))
    return rows.withColumn("reject_reason", reason).where("reject_reason is not null")


def promote(rows: DataFrame, fields: Mapping[str, str], payload: str = "doc") -> DataFrame:
    """Typed columns out of a VARIANT payload; keys a record lacks read as NULL."""
    made = {n: F.try_variant_get(payload, f"$['{n}']", t) for n, t in fields.items()}
    return rows.withColumns(made).drop(payload)


def provided_keys(document: str | Column) -> Column:
    """The keys a VARIANT object really holds: absent and null stay different."""
    column = F.col(document) if isinstance(document, str) else document
    return F.map_keys(column.cast("map<string,variant>"))
