"""Which log rows count at all, decided before any version is resolved.

All of these are row filters or semi/anti joins on the raw log, so a partition
filter on ``_tx`` and a predicate on ``_id`` still reach the file scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import ID, TX, VALID_FROM, VALID_TO, instant_literal


def valid_periods(log: DataFrame) -> DataFrame:
    """Drop writes without an id or with an empty or reversed period."""
    return log.where(
        F.col(ID).isNotNull()
        & F.col(VALID_FROM).isNotNull()
        & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col(VALID_FROM)))
    )


def committed(log: DataFrame, txs: DataFrame) -> DataFrame:
    """Keep rows whose transaction reached the transaction table."""
    done = txs.where(F.col("committed")).select(TX)
    return log.join(done, TX, "left_semi")


def as_of_basis(log: DataFrame, basis: int) -> DataFrame:
    """Keep what had been written by transaction ``basis`` (a snapshot token)."""
    return log.where(F.col(TX) <= F.lit(basis))


def as_of_time(txs: DataFrame, instant) -> DataFrame:
    """The transactions committed at or before a system time."""
    at = instant_literal(instant, txs.schema["system_time"].dataType)
    return txs.where(F.col("system_time") <= at)


def without_erased(log: DataFrame, erasures: DataFrame) -> DataFrame:
    """Hide every write to an erased id made before its erasure.

    ``erasures`` holds ``_id, _tx``.  It is reduced to one row per id first; an id
    put again later than its erasure is visible again.
    """
    last = erasures.groupBy(ID).agg(F.max(TX).alias("_erase_tx"))
    cond = (F.col(f"w.{ID}") == F.col(f"e.{ID}")) & (F.col(f"w.{TX}") <= F.col("e._erase_tx"))
    return log.alias("w").join(last.alias("e"), cond, "left_anti")
