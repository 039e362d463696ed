"""Names of the bookkeeping columns every write log carries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = "_id"
VALID_FROM = "_valid_from"
VALID_TO = "_valid_to"
TX = "_tx"
SEQ = "_seq"
SYSTEM_FROM = "_system_from"
OP = "_op"

PUT = "put"
DELETE = "delete"

# Order of writes: the greatest (transaction, position) covering an instant wins.
ORDER = (TX, SEQ)
LOG_COLUMNS = (ID, VALID_FROM, VALID_TO, TX, SEQ, SYSTEM_FROM, OP)
TEMPORAL = (VALID_FROM, VALID_TO, TX, SEQ, SYSTEM_FROM)


def write_order(alias: str | None = None) -> Column:
    """The write order as one comparable struct column."""
    prefix = f"{alias}." if alias else ""
    return F.struct(*[F.col(prefix + c) for c in ORDER])


def payload_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in LOG_COLUMNS]


def instant_literal(value, data_type: T.DataType) -> Column:
    """A literal instant of the log's own timestamp type (zoned or not)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime) and value.tzinfo is None:
        # As text: a literal would be read in the driver's zone and shown in the session's.
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(data_type)


def instant_type(log: DataFrame) -> T.DataType:
    return log.schema[VALID_FROM].dataType


def micros(column: Column, data_type: T.DataType) -> Column:
    """Microseconds since the epoch, independent of the session time zone."""
    if isinstance(data_type, T.TimestampNTZType):
        epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
        seconds = (column - epoch).cast("interval second").cast("decimal(24,6)")
        return (seconds * F.lit(1_000_000)).cast("bigint")
    return F.unix_micros(column)
