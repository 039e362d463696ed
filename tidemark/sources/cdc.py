"""Change-data-capture events into writes.

Accepted forms: the full envelope (``source``, ``op``, ``before``, ``after``), the
same wrapped in ``payload``, and the flat form with ``__op`` and friends.  Every
event comes out of ``normalise`` with either a write or the reason it is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import (
    DELETE, ID, OP, PUT, SEQ, SYSTEM_FROM, TX, VALID_FROM, VALID_TO, instant_literal,
)
from tidemark.functions.temporal import from_epoch_millis

KNOWN_OPS = ("c", "r", "u", "d")


def read_array_file(spark: SparkSession, path: str) -> DataFrame:
    """Events of a JSON array file: ``_position`` in the array and a VARIANT ``event``."""
    whole = spark.read.option("multiLine", True).option("singleVariantColumn", "v").json(path)
    return spark.sql(
        "SELECT CAST(e.pos AS BIGINT) AS _position, e.value AS event "
        "FROM {whole}, LATERAL variant_explode(v) AS e", whole=whole)


PLACE = ("_file_time", "_file", "_block")


def placed_lines(lines: DataFrame) -> DataFrame:
    """Text lines as ``event`` with the place they were read from, batch or stream."""
    return lines.select(
        F.col("value").alias("event"), F.col("_metadata.file_modification_time").alias("_file_time"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def in_order(events: DataFrame) -> DataFrame:
    """``_position`` by file time, path and place in the file.

    Tasks get blocks of files by size, so a task's number says nothing about order; rows
    of one block do stay in order.  Blocks, as many as there are tasks or so, are ranked
    and a row's position is its block's rank and its number in the task.
    """
    place = [F.col(c) for c in PLACE]
    blocks = events.select(*PLACE).distinct().select(
        *[c.alias(f"{n}_of") for n, c in zip(PLACE, place)],
        F.row_number().over(Window.orderBy(*PLACE)).alias("_rank"))
    numbered = events.withColumn("_number", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in PLACE]
    # One row per block of input read; the sizes measured decide how they are joined.
    found = numbered.join(blocks, same[0] & same[1] & same[2])
    return found.withColumn("_position", F.shiftleft(F.col("_rank").cast("bigint"), 33) + F.col("_number")).drop(
        *PLACE, *[f"{c}_of" for c in PLACE], "_rank", "_number")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Events of JSON-lines files, older files first and in file order within each."""
    return in_order(placed_lines(spark.read.text(path)))


def _at(value: Column, key: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, f"$['{key}']", kind)


# Variant fields keep a JSON null apart from an absent key.
BODY_FIELDS = (
    "struct<payload: variant, source: variant, before: variant, after: variant, ddl: variant, "
    "tableChanges: variant, op: string, ts_ms: string, __op: string, __table: string, "
    "__source_ts_ms: string, __deleted: string>")
SOURCE_FIELDS = "struct<table: string, ts_ms: string>"


def _fields(value: Column, fields: str) -> Column:
    return F.try_variant_get(value, "$", fields)


def normalise(
    events: DataFrame, now, event: str = "event", position: str = "_position", id_field: str = "id"
) -> DataFrame:
    """One row per event: form, table, op, id, time, data and ``reject_reason``.

    ``event`` is JSON text or VARIANT.  ``now`` replaces a missing event time.
    """
    is_text = events.schema[event].dataType.typeName() == "string"
    raw = F.col(event)
    parsed = events.select(
        F.col(position).alias(SEQ),
        (raw.isNull() | (F.length(raw) == 0) if is_text else raw.isNull()).alias("_empty"),
        (F.try_parse_json(raw) if is_text else raw).alias("_event"),
    )
    # One struct extraction per level: each path lookup on its own copies the value.
    top = _fields(F.col("_event"), BODY_FIELDS)
    inner = _fields(_at(F.col("_event"), "payload"), BODY_FIELDS)
    opened = parsed.withColumn("_top", top).withColumn(
        "_wrapped", F.col("_top.payload").isNotNull())
    body = opened.withColumns({
        "_body": F.when(F.col("_wrapped"), F.col("_top.payload")).otherwise(F.col("_event")),
        "_b": F.when(F.col("_wrapped"), inner).otherwise(F.col("_top")),
    })
    fields = body.withColumn("_s", _fields(F.col("_b.source"), SOURCE_FIELDS))
    enveloped = F.col("_b.source").isNotNull()
    form = (
        F.when(F.col("_wrapped"), "wrapped").when(enveloped, "envelope").otherwise("flat"))
    shaped = fields.withColumns({
        "form": form,
        "op": F.when(enveloped, F.coalesce("_b.op", F.lit("r")))
        .otherwise(F.coalesce("_b.__op", F.lit("c"))),
        "table": F.when(enveloped, F.col("_s.table"))
        .otherwise(F.substring_index("_b.__table", ".", -1)),
        # Text that is no number, like a missing time, falls through to now.
        "_millis": F.when(F.col("_wrapped"), F.coalesce("_b.ts_ms", "_s.ts_ms"))
        .when(enveloped, F.col("_s.ts_ms"))
        .otherwise(F.col("_b.__source_ts_ms")).try_cast("bigint"),
    })
    deleted = (F.col("op") == "d") | (
        ~enveloped & F.coalesce(F.col("_b.__deleted") == "true", F.lit(False)))
    known = shaped.withColumns({
        "deleted": deleted,
        "data": F.when(~enveloped, F.col("_body"))
        .when(F.col("op") == "d", F.col("_b.before")).otherwise(F.col("_b.after")),
    })
    known = known.withColumns({
        "record_id": _at(F.col("data"), id_field, "string"),
        "valid_from": F.coalesce(
            from_epoch_millis(F.col("_millis")), instant_literal(now, T.TimestampNTZType())),
    })
    no_data = F.col("data").isNull() | F.is_variant_null("data")
    reason = (
        F.when(F.col("_empty"), "empty value")
        .when(F.col("_event").isNull(), "not json")
        .when(enveloped & F.is_variant_null("_b.source"), "no source")
        .when(enveloped & (F.col("_b.ddl").isNotNull() | F.col("_b.tableChanges").isNotNull()),
              "schema event")
        .when(enveloped & F.col("_b.before").isNull() & F.col("_b.after").isNull(), "no payload")
        .when(F.coalesce(F.col("table"), F.lit("")) == "", "no table")
        .when(no_data, "no data")
        .when(F.col("record_id").isNull(), "no id")
        .when(~F.col("op").isin(*KNOWN_OPS), "unknown op")
    )
    row = F.struct(
        SEQ, "form", "op", F.regexp_replace("table", "[^a-zA-Z0-9_]", "").alias("table"),
        "deleted", "record_id", "valid_from", "data", reason.alias("reject_reason"))
    # A generated row keeps later filters above it; pushed below, they would repeat the
    # whole parse inside the filter condition.
    return known.select(F.inline(F.array(row)))


def accepted(normalised: DataFrame) -> DataFrame:
    return normalised.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(normalised: DataFrame) -> DataFrame:
    return normalised.where(F.col("reject_reason").isNotNull())


def data_keys(data: Column, id_field: str = "id") -> Column:
    """Record data without the id and without ``__`` metadata, as a VARIANT object."""
    entries = F.map_filter(
        data.cast("map<string,variant>"),
        lambda k, v: ~k.startswith("__") & (k != id_field))
    return F.to_variant_object(entries)


def to_log(normalised: DataFrame, tx, system_from, id_field: str = "id") -> DataFrame:
    """Log rows: creates, snapshot reads and updates put; deletes end validity.

    Both are open-ended from the event's own time, so late events land where they
    belong.  ``table`` stays as a column for routing.
    """
    rows = accepted(normalised)
    return rows.select(
        F.col("record_id").alias(ID),
        F.col("valid_from").alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        F.lit(tx).cast("bigint").alias(TX),
        F.col(SEQ).cast("bigint").alias(SEQ),
        instant_literal(system_from, T.TimestampNTZType()).alias(SYSTEM_FROM),
        F.when(F.col("deleted"), DELETE).otherwise(PUT).alias(OP),
        F.when(~F.col("deleted"), data_keys(F.col("data"), id_field)).alias("doc"),
        "table",
    )


def route(log: DataFrame, table: str) -> DataFrame:
    """The writes of one table."""
    return log.where(F.col("table") == table).drop("table")


def tally(normalised: DataFrame) -> DataFrame:
    """Operations per table: inserts, updates, deletes and snapshot reads apart."""
    kind = (
        F.when(F.col("deleted"), "delete").when(F.col("op") == "c", "insert")
        .when(F.col("op") == "r", "snapshot").otherwise("update")
    )
    return accepted(normalised).groupBy("table", kind.alias("operation")).agg(
        F.count("*").alias("n"))
