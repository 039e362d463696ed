"""Resolving a write log into valid-time versions.

The rule: at each instant the covering write with the greatest ``(_tx, _seq)``
wins, whatever order valid times arrived in; a winning delete means absent.

Three plans give the same answer where they all apply:

* ``as_of`` needs no version bounds: filter to the instant, then keep the first write
  per id by descending write order.  Spark pushes that limit of one below the shuffle,
  so a task passes on at most one write per id and a large id never gathers anywhere.
* open-ended writes only: sorted by valid time, the visible writes are exactly the
  record highs of the write order, and each lasts until the next record high.
  Two windows share one shuffle and one sort; the payload just flows along.
* bounded writes: a binary tree over the points in time of each id (see ``sweep.winners``),
  n log n for n writes, never quadratic, on narrow Arrow columns.

Ids too large for one task go through ``_resolve_hot`` instead (see there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import (
    ID, OP, ORDER, PUT, SEQ, TX, VALID_FROM, VALID_TO, instant_literal, instant_type,
    payload_columns, write_order,
)
from tidemark.plans import sweep
from tidemark.plans.skew import KeyProfile, cut_points, profile
from tidemark.plans.visibility import valid_periods
from tidemark.session import ship


def as_of(log: DataFrame, instant) -> DataFrame:
    """Rows valid at ``instant``: the winning put per id, payload and ``_id`` only."""
    at = instant_literal(instant, instant_type(log))
    covering = valid_periods(log).where(
        (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > at))
    )
    newest = Window.partitionBy(ID).orderBy(*[F.desc(c) for c in ORDER])
    winner = covering.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1")
    return winner.where(F.col(OP) == PUT).select(ID, *payload_columns(log))


def as_of_each(log: DataFrame, instants, name: str = "as_of") -> DataFrame:
    """Rows valid at each of several instants, which ``name`` tells apart.

    Writes that cover none are left out first; the others are copied to the instants they
    cover and limited to one per id and instant below the shuffle, as in ``as_of``.  No
    history is sorted, and the work of a large id is shared out by instant.
    """
    kind = instant_type(log)
    listed = F.array(*[instant_literal(i, kind) for i in instants])
    covered = F.filter(listed, lambda t: (F.col(VALID_FROM) <= t) & (
        F.col(VALID_TO).isNull() | (F.col(VALID_TO) > t)))
    reaching = valid_periods(log).where(F.col(VALID_FROM) <= F.array_max(listed)).where(
        F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.array_min(listed)))
    newest = Window.partitionBy(ID, name).orderBy(*[F.desc(c) for c in ORDER])
    winner = reaching.withColumn(name, F.explode(covered)).withColumn(
        "_rank", F.row_number().over(newest)).where("_rank = 1")
    return winner.where(F.col(OP) == PUT).select(ID, name, *payload_columns(log))


def as_of_sets(log: DataFrame, instants, prof: KeyProfile, name: str = "_at") -> DataFrame:
    """Writes valid at some of several instants, once each; bit k of ``name`` stands for instant k.

    A write has the instants it covers less those that later writes of its id cover, so it is shuffled once,
    not once for each instant. Ids that are large by ``prof`` are limited below the shuffle as in ``as_of_each``.
    """
    if len(instants) > 62:
        raise ValueError("more than 62 instants")
    kind = instant_type(log)
    covered = F.lit(0).cast("bigint")
    for k, instant in enumerate(instants):
        at = instant_literal(instant, kind)
        covers = (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > at))
        covered = covered.bitwiseOR(F.when(covers, F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
    reaching = valid_periods(log).withColumn(name, covered).where(F.col(name) != 0).select(ID, *ORDER, OP, name, *payload_columns(log))
    columns = [ID, name, *payload_columns(log)]
    newest = [F.desc(c) for c in ORDER]
    later = F.bit_or(name).over(Window.partitionBy(ID).orderBy(*newest).rowsBetween(Window.unboundedPreceding, -1))
    left = F.col(name).bitwiseAND(F.bitwise_not(F.coalesce(later, F.lit(0).cast("bigint"))))
    found = prof.cold(reaching).withColumn(name, left).where((F.col(name) != 0) & (F.col(OP) == PUT)).select(*columns)
    if prof.hot:
        bits = F.filter(F.lit([1 << k for k in range(len(instants))]).cast("array<bigint>"), lambda b: b.bitwiseAND(F.col("_all")) != 0)
        each = prof.heated(reaching).withColumnRenamed(name, "_all").withColumn(name, F.explode(bits)).drop("_all")
        first = each.withColumn("_rank", F.row_number().over(Window.partitionBy(ID, name).orderBy(*newest))).where("_rank = 1")
        found = found.unionByName(first.where(F.col(OP) == PUT).select(*columns))
    return found


def versions(
    log: DataFrame,
    open_ended: bool = False,
    rows_per_task: int | None = None,
    prof: KeyProfile | None = None,
) -> DataFrame:
    """Every version of every id with its resolved ``_valid_from`` and ``_valid_to``.

    ``open_ended=True`` promises that no write has a ``_valid_to``; such logs resolve
    without leaving the JVM.  ``prof`` saves the count of writes per id where the
    caller has one already; it may list more than this log holds.
    """
    prof = prof or profile(log.select(ID), rows_per_task)
    log = valid_periods(log)
    cold = prof.cold(log)
    resolved = _resolve_open(cold) if open_ended else _resolve_mixed(cold)
    if prof.hot:
        resolved = resolved.unionByName(_resolve_hot(prof.heated(log), prof, open_ended))
    return resolved


def _resolve_open(log: DataFrame) -> DataFrame:
    timeline = Window.partitionBy(ID).orderBy(VALID_FROM, *ORDER)
    highs = (
        log.withColumn("_high", F.max(write_order()).over(
            timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where((F.col(f"_high.{TX}") == F.col(TX)) & (F.col(f"_high.{SEQ}") == F.col(SEQ)))
        .drop("_high")
    )
    bounded = highs.withColumn(VALID_TO, F.lead(VALID_FROM).over(timeline))
    # Of several writes starting at one instant only the last has a period left.
    visible = F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col(VALID_FROM))
    return bounded.where(visible & (F.col(OP) == PUT)).drop(OP)


def _narrow(log: DataFrame) -> DataFrame:
    return log.select(
        ID, VALID_FROM, VALID_TO, TX, SEQ, (F.col(OP) == PUT).alias("_put")
    )


def _attach_payload(segments: DataFrame, log: DataFrame) -> DataFrame:
    """Bring payload back to resolved periods; the key spreads even a hot id evenly."""
    rest = log.where(F.col(OP) == PUT).drop(VALID_FROM, VALID_TO, OP)
    joined = rest.join(segments, [ID, TX, SEQ])
    return joined.select(*[c for c in log.columns if c != OP])


def _resolve_mixed(log: DataFrame) -> DataFrame:
    """Ids without a bounded write go by record highs in the JVM; the others' versions come from narrow rows.

    Payload is joined back by a write's place among those of its id, which is unique even where
    ``(_tx, _seq)`` is not. One shuffle of the payload by id serves both sides.
    """
    order = [*ORDER, VALID_FROM, VALID_TO]
    line = Window.partitionBy(ID).orderBy(*order)
    told = log.withColumns({"_bounded": F.max(F.col(VALID_TO).isNotNull()).over(
        line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), "_w": F.row_number().over(line)})
    alone = _resolve_open(told.where(~F.col("_bounded")).drop("_bounded", "_w"))
    found = _resolved(_narrow(log), [ID], order).where("_bounded AND _put").select(ID, "_w", VALID_FROM, VALID_TO)
    rest = told.where("_bounded").where(F.col(OP) == PUT).drop(VALID_FROM, VALID_TO, OP, "_bounded")
    columns = [c for c in log.columns if c != OP]
    return alone.select(*columns).unionByName(rest.join(found, [ID, "_w"]).select(*columns))


def _resolved(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    ship(rows.sparkSession)
    more = [T.StructField("_w", T.IntegerType()), T.StructField("_edge", T.BooleanType()), T.StructField("_bounded", T.BooleanType())]
    ordered = rows.repartition(*group).sortWithinPartitions(*group, *order)
    return ordered.mapInArrow(sweep.resolver(rows.columns, group), T.StructType([*rows.schema.fields, *more]))


def _chunk_highs(rows: DataFrame) -> DataFrame:
    """Versions inside chunks where every write lasts to the end of its chunk.

    The open-ended plan per chunk: record highs, each until the next or the chunk's end.
    """
    line = Window.partitionBy(ID, "_chunk").orderBy(VALID_FROM, *ORDER)
    highs = (
        rows.withColumn("_high", F.max(write_order()).over(
            line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where((F.col(f"_high.{TX}") == F.col(TX)) & (F.col(f"_high.{SEQ}") == F.col(SEQ)))
    )
    following = highs.withColumn("_next", F.lead(VALID_FROM).over(line))
    return following.select(
        ID, VALID_FROM, F.coalesce("_next", VALID_TO).alias(VALID_TO), TX, SEQ, "_put",
        (F.col("_next").isNull() | F.col("_base")).alias("_edge"),
    ).where(F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col(VALID_FROM)))


def _resolve_hot(log: DataFrame, prof: KeyProfile, open_ended: bool) -> DataFrame:
    """Resolve ids that hold more writes than one task should.

    Each timeline is cut into chunks of similar depth.  A write is cut to its first
    and last chunk, and the run of chunks it covers in full is stated as a few nodes
    of a binary tree over the chunks, so only the greatest write per node is kept
    (aggregated before the shuffle).  A chunk then needs the writes with an end
    inside it plus one base write: the greatest among its ancestors in the tree.
    Chunks are resolved independently; only versions touching a cut are stitched.
    """
    spark = log.sparkSession
    narrow = _narrow(log)
    cuts = cut_points(narrow, prof)
    if not cuts:  # the profile named ids this log has no writes for
        return _resolve_mixed(log)
    depth = max(len(c) for c in cuts.values()).bit_length() + 1
    cut_schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in narrow.schema.fields]
        + [T.StructField("_level", T.IntegerType()), T.StructField("_chunk", T.IntegerType())]
    )
    ship(spark)
    cut = narrow.mapInArrow(sweep.cutter(narrow.columns, cuts, depth), cut_schema)
    keys = [ID, "_level", "_chunk", VALID_FROM, VALID_TO]
    best = cut.groupBy(*keys).agg(F.max(F.struct(TX, SEQ, "_put")).alias("_w"))
    # Generated rows keep the two filters below from being pushed apart, so the pieces
    # are made and shuffled once.
    best = best.select(F.inline(F.array(F.struct(*keys, "_w"))))
    details = best.where(F.col("_level") < 0)
    nodes = best.where(F.col("_level") >= 0).select(
        ID, "_level", F.col("_chunk").alias("_node"), "_w")

    # One row per chunk of a hot id: bounded by the cuts already on the driver.
    leaf_schema = T.StructType(
        [cut_schema[c] for c in (ID, VALID_FROM, VALID_TO, "_chunk")])
    leaves = spark.createDataFrame(
        sweep.leaf_table(cuts, narrow.schema[VALID_FROM].dataType), leaf_schema)
    ancestors = leaves.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(depth)))).withColumn(
        "_node", F.expr("shiftright(_chunk, _level)"))
    base = (
        ancestors.join(nodes, [ID, "_level", "_node"])
        .groupBy(ID, "_chunk", VALID_FROM, VALID_TO).agg(F.max("_w").alias("_w"))
    )
    shape = [ID, VALID_FROM, VALID_TO, "_w.*", "_chunk"]
    rows = details.select(*shape, F.lit(False).alias("_base")).unionByName(
        base.select(*shape, F.lit(True).alias("_base")))
    if open_ended:
        swept = _chunk_highs(rows).where("_put")
    else:
        swept = _resolved(rows.select(*narrow.columns, "_chunk"), [ID, "_chunk"], list(ORDER)).where("_put")
    inner = swept.where(~F.col("_edge")).select(ID, VALID_FROM, VALID_TO, TX, SEQ)

    # At most two versions per chunk touch a cut, so this window is small for any id.
    line = Window.partitionBy(ID).orderBy(VALID_FROM)
    continues = (
        F.lag(VALID_TO).over(line).eqNullSafe(F.col(VALID_FROM))
        & (F.lag(TX).over(line) == F.col(TX)) & (F.lag(SEQ).over(line) == F.col(SEQ))
    )
    stitched = (
        swept.where("_edge")
        .withColumn("_starts", F.when(F.coalesce(continues, F.lit(False)), 0).otherwise(1))
        .withColumn("_run", F.sum("_starts").over(line))
        .groupBy(ID, "_run", TX, SEQ)
        .agg(F.max_by(VALID_TO, VALID_FROM).alias(VALID_TO), F.min(VALID_FROM).alias(VALID_FROM))
        .select(ID, VALID_FROM, VALID_TO, TX, SEQ)
    )
    return _attach_payload(inner.unionByName(stitched), log)
