"""Transit-JSON lines: records whose maps, keywords and dates are tagged JSON.

Loading turns each line into plain JSON, then VARIANT or typed columns; export
builds the lines from the schema with JVM expressions, but for VARIANT values.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import ID
from tidemark.session import ship

# Fixed markers of the format.
MAP_MARK = "^ "
TAG_MARK = "~#"
SCALAR_MARKS = ("~:", "~t", "~u", "~r", "~$")
SET_TAG = "~#set"


def _plain(node):
    """A parsed transit value as the ordinary JSON value it stands for."""
    if isinstance(node, str):
        if node[:2] in SCALAR_MARKS:
            return node[2:]
        return node[1:] if node[:2] in ("~~", "~^") else node
    if not isinstance(node, list):
        return node
    match node:
        case ["^ ", *pairs]:
            return {_plain(k): _plain(v) for k, v in zip(pairs[::2], pairs[1::2])}
        case ["~#set", members]:
            seen = {json.dumps(m, sort_keys=True): m for m in map(_plain, members)}
            return list(seen.values())
        case [str(tag), value] if tag.startswith(TAG_MARK):
            return _plain(value)
    return [_plain(item) for item in node]


def _line_to_json(line: str | None) -> str | None:
    try:
        return None if line is None else json.dumps(_plain(json.loads(line)), ensure_ascii=False)
    except ValueError:
        return None


def _marked(node):
    """An ordinary JSON value as transit: objects become marked arrays, marks in text are escaped."""
    if isinstance(node, dict):
        return [MAP_MARK, *(x for k, v in node.items() for x in (_marked(k), _marked(v)))]
    if isinstance(node, list):
        return [_marked(x) for x in node]
    return "~" + node if isinstance(node, str) and node[:1] in ("~", "^") else node


def _json_to_line(text: str | None) -> str | None:
    return None if text is None else json.dumps(_marked(json.loads(text)), ensure_ascii=False, separators=(",", ":"))


@F.pandas_udf(T.StringType())
def from_json_text(texts: pd.Series) -> pd.Series:
    """Values of no fixed type only show their fields row by row, hence in Python."""
    return texts.map(_json_to_line)


@F.pandas_udf(T.StringType())
def to_json_text(lines: pd.Series) -> pd.Series:
    return lines.map(_line_to_json)


def _plain_lines(spark: SparkSession, path: str) -> DataFrame:
    ship(spark)
    text = spark.read.text(path).where(F.length("value") > 0)
    return text.select("value", to_json_text("value").alias("json"))


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not JSON, as ``value``."""
    return _plain_lines(spark, path).where("json is null").select("value")


def read_lines(
    spark: SparkSession, path: str, schema: str | None = None, id_key: str = "_id"
) -> DataFrame:
    """Load transit-JSON lines.

    With a ``schema`` (names as in the file) columns are typed; without one each
    record is ``_id`` plus a VARIANT ``doc``.  Lines that cannot be read are left out;
    ``rejected_lines`` lists them.
    """
    plain = _plain_lines(spark, path).where("json is not null").select("json")
    if schema is None:
        doc = F.try_parse_json("json")
        return plain.select(
            F.try_variant_get(doc, f"$['{id_key}']", "string").alias(ID), doc.alias("doc"))
    typed = plain.select(F.from_json("json", schema).alias("r")).select("r.*")
    return typed.withColumnRenamed(id_key, ID)


def _holds_variant(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_variant(f.dataType) for f in kind)
    inner = [getattr(kind, n) for n in ("elementType", "keyType", "valueType") if hasattr(kind, n)]
    return isinstance(kind, T.VariantType) or any(map(_holds_variant, inner))


def _encode(value: Column, kind: T.DataType) -> Column:
    """The transit text of one value, by its Spark type."""
    if isinstance(kind, (T.ArrayType, T.MapType)) and _holds_variant(kind):
        # Python functions cannot run inside the expression over elements.
        text = from_json_text(F.to_json(value))
    elif isinstance(kind, T.StructType):
        text = _encode_map([(f.name, value.getField(f.name), f.dataType) for f in kind])
    elif isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda x: _encode(x, kind.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.concat(
            _encode(e["key"].cast("string"), T.StringType()), F.lit(","), _encode(e["value"], kind.valueType)))
        text = F.concat(F.lit('["^ "'), F.when(F.size(entries) > 0, F.concat(F.lit(","), F.array_join(entries, ","))).otherwise(""), F.lit("]"))
    elif isinstance(kind, T.VariantType):
        text = from_json_text(F.to_json(value))
    elif isinstance(kind, T.TimestampType):
        text = F.date_format(value, "'\"~t'yyyy-MM-dd'T'HH:mm:ss.SSSXXX'\"'")
    elif isinstance(kind, T.TimestampNTZType):
        text = F.date_format(value, "'\"~t'yyyy-MM-dd'T'HH:mm:ss.SSS'\"'")
    elif isinstance(kind, T.DateType):
        text = F.date_format(value, "'\"~t'yyyy-MM-dd'\"'")
    elif isinstance(kind, T.StringType):
        # A leading ~ or ^ would read as a marker, so it is escaped by another ~.
        marked = F.when(value.rlike("^[~^]"), F.concat(F.lit("~"), value)).otherwise(value)
        text = F.regexp_extract(F.to_json(F.struct(marked.alias("s"))), r"(?s)^\{\"s\":(.*)\}$", 1)
    else:
        text = value.cast("string")
    return F.when(value.isNull(), F.lit("null")).otherwise(text)


def _encode_map(fields) -> Column:
    parts = [F.lit(json.dumps(MAP_MARK))]
    for name, value, kind in fields:
        parts += [F.lit(json.dumps(f"~:{name}")), _encode(value, kind)]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def to_lines(rows: DataFrame) -> DataFrame:
    """One transit-JSON line per row, in a column ``value`` ready for ``write.text``."""
    ship(rows.sparkSession)
    return rows.select(
        _encode_map([(f.name, F.col(f"`{f.name}`"), f.dataType) for f in rows.schema]).alias("value"))
