"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import checkpoint_dir, ship

#: What separates words: space and the control characters from tab to carriage return.
SPACES = "\\x20\\x09-\\x0D"

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def texts(docs: DataFrame, *more: str | Column) -> DataFrame:
    """Only the id, the text and what is named besides; a null text becomes empty.

    Also sends the package to the executors, for the operators that run Python there.
    Selecting first is what makes extra columns, whatever their names, harmless.
    """
    ship(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


_TABLES: list[Callable[[], None]] = []


def emptied_by(clear: Callable[[], None]) -> None:
    """Say how to empty a table that an operator keeps in a worker process from one task to the next."""
    _TABLES.append(clear)


def without_tables() -> None:
    """Empty the tables that other operators left in this worker process.

    Workers outlive their tasks and go from operator to operator: one that needs much memory itself calls this first.
    """
    for clear in _TABLES:
        clear()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside delete their shuffle files once they have run.

    For steps that end in a checkpoint: nothing reads their shuffles afterwards, and a long
    job would otherwise hold the shuffles of all its steps on disk at once.
    """
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def settled(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder; survives lost executors."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    with shuffles_released(spark):
        # A new frame, so that it is planned under the setting above.
        return df.select("*").checkpoint(eager=True)
