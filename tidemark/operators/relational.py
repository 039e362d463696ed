"""Relational helpers on top of plain DataFrame operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rel(spark: SparkSession, rows: Sequence[Mapping], schema: str) -> DataFrame:
    """An inline relation.  Keys not named in ``schema`` are dropped, missing ones NULL."""
    names = [f.split()[0] for f in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def bind(table: DataFrame, **bindings) -> DataFrame:
    """Choose columns of a table and name them after logic variables.

    ``variable="column"`` binds a column; a tuple of columns must hold equal values;
    any other value given as ``F.lit(..)`` under the column's own name filters on it.
    """
    for name, target in bindings.items():
        if isinstance(target, Column):
            table = table.where(F.col(name) == target)
    chosen = []
    for name, target in bindings.items():
        if isinstance(target, Column):
            continue
        first, *others = (target,) if isinstance(target, str) else target
        for other in others:
            table = table.where(F.col(first) == F.col(other))
        chosen.append(F.col(first).alias(name))
    return table.select(*chosen)


@dataclass(frozen=True)
class Literal:
    """A relation written down row by row; it may be paired with one that shares nothing."""

    rows: Sequence[Mapping]
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(r[n] for n in self.columns) for r in self.rows], self.schema)


def literal(df: DataFrame, limit: int = 1_000) -> Literal:
    """A dimension of at most ``limit`` rows, read now, as a literal relation; larger is an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows are no literal relation; join on a common variable")
    return Literal([r.asDict() for r in rows], df.schema)


def pair_with_literal(left: DataFrame, right: Literal) -> DataFrame:
    """Every row of ``left`` with every row of ``right``, whose size the caller wrote down."""
    if not right.rows:
        return left.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]
                           ).where(F.lit(False))
    rows = F.array(*[
        F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in right.schema])
        for r in right.rows
    ])
    return left.withColumn("_few", F.explode(rows)).select(*left.columns, "_few.*")


def unify(*relations: DataFrame | Literal, where: Sequence[Column] = ()) -> DataFrame:
    """Join relations on every variable they share; the order given is irrelevant.

    Each step takes a relation that shares a variable with what is joined so far, so
    no needless product arises.  What shares nothing must be a ``Literal``: whether a query is
    answered never depends on how many rows its tables have.  Bags: duplicates are kept.
    """
    pending = sorted(relations, key=lambda r: isinstance(r, Literal))
    joined = pending.pop(0)
    if isinstance(joined, Literal):
        raise ValueError("at least one relation must be a table")
    while pending:
        linked = next((r for r in pending if set(r.columns) & set(joined.columns)), None)
        if linked is None:
            linked = next((r for r in pending if isinstance(r, Literal)), None)
            if linked is None:
                raise ValueError("relations share no variable; join them on a common one or name one literal()")
            joined = pair_with_literal(joined, linked)
        else:
            right = linked.frame(joined.sparkSession) if isinstance(linked, Literal) else linked
            joined = joined.join(right, [c for c in joined.columns if c in right.columns])
        pending.remove(linked)
    for condition in where:
        joined = joined.where(condition)
    return joined


def count_above(table: DataFrame, value: str, limits: DataFrame, limit: str, width: float, name: str) -> DataFrame:
    """``limits`` with the number of rows of ``table`` whose ``value`` is greater than ``limit``.

    An inequality join that is counted, without its pairs.  Values are counted per band of
    ``width``; a limit gets the totals of the bands above its own, summed along the bands, and
    within its own band meets only different values.  Pick ``width`` so that bands hold few values.
    """
    band = lambda c: F.floor(F.col(c) / F.lit(width)).cast("bigint")
    values = table.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_value")).agg(
        F.count("*").alias("_n")).withColumn("_band", band("_value"))
    marked = limits.withColumn("_band", band(limit))
    points = marked.select(F.col(limit).alias("_limit"), "_band").where("_limit is not null").distinct()
    # One row per band, whatever the tables hold: the running total is over these.
    every = values.groupBy("_band").agg(F.sum("_n").alias("_in")).unionByName(
        points.select("_band").distinct().withColumn("_in", F.lit(0).cast("bigint"))).groupBy("_band").agg(F.sum("_in").alias("_in"))
    above = every.select(F.col("_band").alias("_of"), F.coalesce(F.sum("_in").over(
        Window.orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_above"))
    inside = points.join(values, "_band").where(F.col("_value") > F.col("_limit")).groupBy(F.col("_limit").alias("_point")).agg(
        F.sum("_n").alias("_inside"))
    found = marked.join(above, F.col("_band") == F.col("_of"), "left").join(inside, F.col(limit) == F.col("_point"), "left")
    total = F.coalesce("_above", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    return found.select(*limits.columns, total.cast("bigint").alias(name))


def left_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left outer join whose right side may hold very many rows of one key.

    A plain outer join cannot split a large key on its optional side.  The matches are
    an inner join, which can, and the rest are the left rows whose key is missing.
    """
    matches = left.join(right, F.col(left_key) == F.col(right_key))
    known = right.select(F.col(right_key).alias("_known")).distinct()
    alone = left.join(known, F.col(left_key) == F.col("_known"), "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]
    return matches.unionByName(alone.select("*", *nulls))


def unnest(table: DataFrame, array: str, variable: str) -> DataFrame:
    """One row per element; rows with an empty or NULL array go."""
    return table.withColumn(variable, F.explode(array))


def nest_one(rows: DataFrame, name: str = "record") -> DataFrame:
    """A subquery's single row as one nested value: NULL if none, an error if several."""
    found = rows.agg(F.count("*").alias("n"), F.first(F.struct("*")).alias("r"))
    too_many = F.raise_error(F.lit("nest_one: the subquery returned more than one row"))
    return found.select(
        F.when(F.col("n") > 1, too_many.cast(found.schema["r"].dataType))
        .otherwise(F.col("r")).alias(name)
    )


def semi_join_first(
    table: DataFrame, key: str, inner: DataFrame, n: int, inner_key: str | None = None
) -> DataFrame:
    """``WHERE key IN (SELECT key FROM inner ORDER BY key LIMIT n)``."""
    inner_key = inner_key or key
    first = inner.select(F.col(inner_key).alias(key)).orderBy(key).limit(n)
    return table.join(first, key, "left_semi")


def count_by_label(table: DataFrame, column: str, default: str, count: str) -> DataFrame:
    """Count per raw value, then label NULL; a real ``default`` value stays its own row."""
    counted = table.groupBy(column).agg(F.count("*").alias(count))
    return counted.select(F.coalesce(F.col(column), F.lit(default)).alias(column), count)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def jagged_union(*tables: DataFrame) -> DataFrame:
    """All records of tables with different keys; a missing key reads as NULL."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result
