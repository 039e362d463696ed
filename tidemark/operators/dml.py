"""Statements that add to a write log.

Each function returns the log rows the statement appends; nothing is changed in
place.  Union them with the log (or commit them through ``sources.store``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import (
    DELETE, ID, LOG_COLUMNS, OP, PUT, SEQ, SYSTEM_FROM, TX, VALID_FROM, VALID_TO,
    instant_literal, instant_type, micros, payload_columns,
)
from tidemark.plans import resolve
from tidemark.plans.skew import KeyProfile


def append(log: DataFrame, *writes: DataFrame) -> DataFrame:
    """The log after more writes; keys unknown to one side read as NULL."""
    for rows in writes:
        log = log.unionByName(rows, allowMissingColumns=True)
    return log


def _as_log(rows: DataFrame, tx: int, system_from, op: str, seq: Column, data_type) -> DataFrame:
    stamped = rows.withColumns({
        TX: F.lit(tx).cast("bigint"),
        SEQ: seq.cast("bigint"),
        SYSTEM_FROM: instant_literal(system_from, data_type),
        OP: F.lit(op),
    })
    return stamped.select(*LOG_COLUMNS, *payload_columns(stamped))


def put(
    records: DataFrame,
    tx: int,
    system_from,
    valid_from=None,
    valid_to=None,
    position: Column | None = None,
    data_type: str = "timestamp_ntz",
    distinct_ids: bool = False,
) -> DataFrame:
    """Insert or replace records.

    Valid from the given instant (default: the transaction's time), or from each
    record's own ``_valid_from`` where it brings one; open-ended unless ``valid_to``
    or the record says otherwise.  ``position`` orders records of one id inside the
    transaction, and must tell them apart.  Without it they are numbered by period and content, so
    what wins does not depend on the order of rows; ``distinct_ids`` promises that no id comes
    twice and saves that shuffle.
    """
    start = instant_literal(system_from if valid_from is None else valid_from, data_type)
    end = instant_literal(valid_to, data_type)
    if VALID_FROM in records.columns:
        start = F.coalesce(F.col(VALID_FROM).cast(data_type), start)
    if VALID_TO in records.columns:
        end = F.coalesce(F.col(VALID_TO).cast(data_type), end)
    rows = records.withColumns({VALID_FROM: start, VALID_TO: end})
    if position is None:
        position = F.lit(0) if distinct_ids else F.row_number().over(
            Window.partitionBy(ID).orderBy(VALID_FROM, VALID_TO, *_content(rows))) - 1
    return _as_log(rows, tx, system_from, PUT, position, data_type)


def _content(rows: DataFrame) -> list[Column]:
    """The payload as columns that have an order."""
    def ordered(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(ordered(f.dataType) for f in kind)
        if isinstance(kind, T.ArrayType):
            return ordered(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType))

    return [F.col(f"`{c}`") if ordered(rows.schema[c].dataType) else F.to_json(F.struct(F.col(f"`{c}`"))) for c in payload_columns(rows)]


def affected(
    log: DataFrame, start, end=None, open_ended: bool = False, prof: KeyProfile | None = None
) -> DataFrame:
    """Versions overlapping ``[start, end)``, clipped to it.

    Starts are clipped before resolution, so history before ``start`` folds into ties
    at ``start`` and long-closed writes never leave the scan.  Ends are clipped after,
    so a log without bounded writes stays one.
    """
    kind = instant_type(log)
    low, high = instant_literal(start, kind), instant_literal(end, kind)
    reaching = log.where(F.col(VALID_TO).isNull() | (F.col(VALID_TO) > low))
    if end is not None:
        reaching = reaching.where(F.col(VALID_FROM) < high)
    reaching = reaching.withColumn(VALID_FROM, F.greatest(VALID_FROM, low))
    found = resolve.versions(reaching, open_ended, prof=prof)
    return found if end is None else found.withColumn(VALID_TO, F.least(VALID_TO, high))


def update(
    log: DataFrame,
    changes: Mapping[str, Column],
    tx: int,
    at,
    where: Column | None = None,
    until=None,
    open_ended: bool = False,
    prof: KeyProfile | None = None,
) -> DataFrame:
    """UPDATE .. SET .. WHERE .. for a portion of valid time, ``[at, until)``.

    Every version inside the portion that satisfies ``where`` is put again with the
    changes, for just its share of the portion; versions sticking out are split by
    resolution, not by rewriting.  ``open_ended`` says no write of the log is bounded.
    The new puts are bounded where a version ends, before a future one for instance.
    """
    rows = affected(log, at, until, open_ended, prof)
    if where is not None:
        rows = rows.where(where)
    kind = instant_type(log)
    rows = rows.withColumns(dict(changes))
    # Clipped versions of one id are disjoint, so their start tells them apart.
    return _as_log(rows, tx, at, PUT, micros(F.col(VALID_FROM), kind), kind)


def delete_where(
    log: DataFrame, where: Column, tx: int, at, until=None, open_ended: bool = False,
    prof: KeyProfile | None = None,
) -> DataFrame:
    """DELETE .. WHERE: end validity of matching versions inside ``[at, until)``."""
    rows = affected(log, at, until, open_ended, prof).where(where)
    kind = instant_type(log)
    rows = rows.select(ID, VALID_FROM, VALID_TO)
    return _as_log(rows, tx, at, DELETE, micros(F.col(VALID_FROM), kind), kind)


def delete_ids(
    ids: DataFrame, tx: int, system_from, valid_from=None, valid_to=None,
    data_type: str = "timestamp_ntz",
) -> DataFrame:
    """DELETE FOR PORTION OF VALID_TIME FROM .. TO .. WHERE _id = ..: one row per id."""
    rows = ids.select(ID).distinct().withColumns({
        VALID_FROM: instant_literal(system_from if valid_from is None else valid_from, data_type),
        VALID_TO: instant_literal(valid_to, data_type),
    })
    return _as_log(rows, tx, system_from, DELETE, F.lit(0), data_type)


def erase(ids: DataFrame, tx: int) -> DataFrame:
    """ERASE: rows for the erasure table that ``visibility.without_erased`` reads."""
    return ids.select(ID, F.lit(tx).cast("bigint").alias(TX)).distinct()


def patch(
    log: DataFrame, patches: DataFrame, tx: int, at, provided: str | None = None,
    open_ended: bool = False, prof: KeyProfile | None = None,
) -> DataFrame:
    """PATCH: overwrite the given keys from ``at`` on, keep the others.

    ``patches`` holds ``_id`` and some payload columns.  An absent key differs from
    a NULL one: name in ``provided`` an array column listing the keys each row really
    gives (default: all).  Where nothing was valid the record is created: a put of
    the given keys goes first and merged versions cover it where there were any.
    """
    kind = instant_type(log)
    keys = [c for c in patches.columns if c not in (ID, provided)]
    given = {
        k: F.array_contains(provided, k) if provided else F.lit(True) for k in keys
    }
    created = _as_log(
        patches.select(ID, *[F.when(given[k], F.col(k)).alias(k) for k in keys]).withColumns({
            VALID_FROM: instant_literal(at, kind), VALID_TO: F.lit(None).cast(kind)}),
        tx, at, PUT, F.lit(-(1 << 63)), kind)
    wanted = log.join(patches.select(ID).distinct(), ID, "left_semi")
    before = affected(wanted, at, open_ended=open_ended, prof=prof)
    news = patches.select(
        ID, *[F.col(k).alias(f"_new_{k}") for k in keys],
        *[given[k].alias(f"_has_{k}") for k in keys])
    merged = before.join(news, ID)
    for k in keys:
        old = F.col(k) if k in before.columns else F.lit(None)
        merged = merged.withColumn(k, F.when(F.col(f"_has_{k}"), F.col(f"_new_{k}")).otherwise(old))
    merged = merged.drop(*[f"_new_{k}" for k in keys], *[f"_has_{k}" for k in keys])
    kept = _as_log(merged, tx, at, PUT, micros(F.col(VALID_FROM), kind), kind)
    return created.unionByName(kept, allowMissingColumns=True)
