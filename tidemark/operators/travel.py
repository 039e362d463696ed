"""Reading versioned tables at a valid time and a system time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import (
    ID, LOG_COLUMNS, PUT, OP, SYSTEM_FROM, TX, VALID_FROM, VALID_TO, instant_literal, instant_type,
)
from tidemark.operators import dml
from tidemark.plans import resolve, visibility
from tidemark.plans.skew import KeyProfile, profile
from tidemark.session import checkpoint_dir


@dataclass(frozen=True)
class VersionedTable:
    """A write log with the settings that decide what of it is visible.

    ``clock`` tells the system time of transactions, for reads as of one (``until``).

    ``open_ended`` promises that no write has a ``_valid_to``.  ``rows_per_task``
    caps how many writes of one id a task resolves before the id is split.
    """

    log: DataFrame
    open_ended: bool = False
    txs: DataFrame | None = None
    erasures: DataFrame | None = None
    basis: int | None = None
    rows_per_task: int | None = None
    prof: KeyProfile | None = None
    clock: DataFrame | None = None
    until: object = None

    def profiled(self) -> VersionedTable:
        """The table with its writes counted per id, so later reads need not count.

        Counted on the raw log: what visibility hides can only lower the counts.
        """
        if self.prof is not None:
            return self
        return replace(self, prof=profile(self.log.select(ID), self.rows_per_task))

    def after(self, *writes: DataFrame, open_ended: bool = False) -> VersionedTable:
        """The table after statements derived from it (update, delete, patch).

        Such statements add at most one write per version of an id, so the profile
        still tells which ids are large; use ``after_puts`` for outside records.
        """
        return replace(
            self.profiled(), log=dml.append(self.log, *writes), open_ended=open_ended)

    def after_puts(self, *writes: DataFrame) -> VersionedTable:
        """The table after puts or deletes of outside records, which are profiled too."""
        prof = self.profiled().prof.merged(
            *[profile(w.select(ID), self.rows_per_task) for w in writes])
        return replace(self, log=dml.append(self.log, *writes), prof=prof)

    def update(self, changes, tx: int, at, where=None, until=None) -> VersionedTable:
        table = self.profiled()
        return table.after(dml.update(
            table.visible(), changes, tx, at, where, until, table.open_ended, table.prof))

    def delete_where(self, where, tx: int, at, until=None) -> VersionedTable:
        table = self.profiled()
        return table.after(dml.delete_where(
            table.visible(), where, tx, at, until, table.open_ended, table.prof))

    def patch(self, patches: DataFrame, tx: int, at, provided: str | None = None) -> VersionedTable:
        table = self.profiled()
        rows = dml.patch(
            table.visible(), patches, tx, at, provided, table.open_ended, table.prof)
        return replace(table.after(rows), prof=table.prof.merged(profile(patches.select(ID))))

    def settled(self) -> VersionedTable:
        """The table with its log written out, for use between statements.

        A statement reads the log to find the versions it touches and the result holds
        both, so each further statement on an unsettled table doubles the plan.
        """
        checkpoint_dir(self.log.sparkSession)
        return replace(self, log=self.log.checkpoint())

    def at_basis(self, tx: int) -> VersionedTable:
        """The table as it stood after transaction ``tx``: a repeatable read."""
        return replace(self, basis=tx)

    def at_basis_time(self, instant) -> VersionedTable:
        """The table as the last transaction committed by ``instant`` left it."""
        if self.clock is None:
            raise ValueError("this table does not know the times of its transactions")
        return replace(self, until=instant)

    def columns(self, *names: str) -> VersionedTable:
        """Keep some payload columns; fewer columns are scanned and shuffled."""
        return replace(self, log=self.log.select(*LOG_COLUMNS, *names))

    def visible(self) -> DataFrame:
        """Log rows that count: basis first, then committed, then not erased."""
        rows = self.log
        erasures = self.erasures
        if self.basis is not None:
            rows = visibility.as_of_basis(rows, self.basis)
            if erasures is not None:
                erasures = visibility.as_of_basis(erasures, self.basis)
        if self.until is not None:
            known = visibility.as_of_time(self.clock, self.until)
            rows = visibility.committed(rows, known)
            erasures = None if erasures is None else visibility.committed(erasures, known)
        if self.txs is not None:
            rows = visibility.committed(rows, self.txs)
        if erasures is not None:
            rows = visibility.without_erased(rows, erasures)
        return rows

    def as_of(self, instant) -> DataFrame:
        """FOR VALID_TIME AS OF: one row per id, temporal columns hidden."""
        return resolve.as_of(self.visible(), instant)

    def as_of_each(self, instants: Sequence) -> DataFrame:
        """Rows valid at each of the instants, in one pass; ``as_of`` names the instant."""
        return resolve.as_of_each(self.visible(), instants)

    def as_of_sets(self, instants: Sequence) -> DataFrame:
        """Rows valid at some of the instants, once for each write; bit k of ``_at`` stands for instant k."""
        return resolve.as_of_sets(self.visible(), instants, self.profiled().prof)

    def current(self, now=None) -> DataFrame:
        """Rows valid now.  ``now=None`` takes the session's clock."""
        return self.as_of(F.current_timestamp() if now is None else now)

    def all_versions(self) -> DataFrame:
        """FOR ALL VALID_TIME: every version with ``_valid_from``, ``_valid_to``."""
        return resolve.versions(self.visible(), self.open_ended, prof=self.profiled().prof)

    def between(self, start, end) -> DataFrame:
        """FOR VALID_TIME FROM a TO b: versions overlapping ``[a, b)``, unclipped."""
        found = self.all_versions()
        kind = instant_type(found)
        return found.where(
            (F.col(VALID_FROM) < instant_literal(end, kind))
            & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > instant_literal(start, kind)))
        )

    def closed_versions(self) -> DataFrame:
        """Versions that ended, whether superseded or deleted."""
        return self.all_versions().where(F.col(VALID_TO).isNotNull())

    def deleted_ids(self, now) -> DataFrame:
        """Ids with history but no version valid at ``now``."""
        rows = self.visible()
        ever = rows.where(F.col(OP) == PUT).select(ID).distinct()
        return ever.join(resolve.as_of(rows.select(*LOG_COLUMNS), now), ID, "left_anti")


def with_temporal_columns(versions: DataFrame) -> DataFrame:
    """Add the period columns ``_valid_time`` and ``_system_time`` as structs."""
    kind = instant_type(versions)
    return versions.withColumns({
        "_valid_time": F.struct(
            F.col(VALID_FROM).alias("from"), F.col(VALID_TO).alias("to")),
        "_system_time": F.struct(
            F.col(SYSTEM_FROM).alias("from"), F.lit(None).cast(kind).alias("to")),
    })


def with_status(versions: DataFrame, column: str = "status") -> DataFrame:
    """Label each version CURRENT (open end) or SUPERSEDED."""
    return versions.withColumn(
        column, F.when(F.col(VALID_TO).isNull(), "CURRENT").otherwise("SUPERSEDED"))


def hide_temporal(df: DataFrame) -> DataFrame:
    """What ``SELECT *`` shows: no bookkeeping columns but the id."""
    return df.drop(*[c for c in LOG_COLUMNS if c != ID], "_valid_time", "_system_time")


def first_seen(versions: DataFrame) -> DataFrame:
    return versions.groupBy(ID).agg(F.min(VALID_FROM).alias("first_valid_from"))


def at_instants(versions: DataFrame, instants: Sequence, name: str = "as_of") -> DataFrame:
    """Each version once per listed instant it covers: several AS OF reads in one pass.

    The instants are literals in the plan, so no join is needed; a version is copied
    only for instants inside its period.
    """
    kind = instant_type(versions)
    listed = F.array(*[instant_literal(i, kind) for i in instants])
    covered = F.filter(
        listed,
        lambda t: (F.col(VALID_FROM) <= t) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > t)))
    return versions.withColumn(name, F.explode(covered))


@dataclass(frozen=True)
class Snapshot:
    """One default valid time and basis for every table of a query."""

    tables: Mapping[str, VersionedTable]
    valid_time: object
    basis: int | None = None

    def __getitem__(self, name: str) -> DataFrame:
        table = self.tables[name]
        if self.basis is not None:
            table = table.at_basis(self.basis)
        return table.as_of(self.valid_time)

    def register(self, spark) -> None:
        """Make the tables readable by name in ``spark.sql``."""
        for name in self.tables:
            self[name].createOrReplaceTempView(name)


def transaction_log(log: DataFrame) -> DataFrame:
    """One row per transaction: when it was made and how many rows it wrote."""
    return log.groupBy(TX).agg(
        F.max(SYSTEM_FROM).alias("system_time"),
        F.count("*").alias("writes"),
    )
