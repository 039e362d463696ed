"""Directories of tab-separated files with a header row, one file per table."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import ID
from tidemark.functions import infer

log = logging.getLogger(__name__)


def table_name(path: str) -> str:
    return PurePosixPath(path).name.removesuffix(".tsv").removeprefix("public_")


def split_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records as text columns, rejected lines with the number of values found).

    Lines are split in the JVM, trailing empty values included, and a line whose
    value count differs from the header's is rejected.  The header is the line at the
    file's start, whatever other lines say.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"))
    header = lines.where("_start = 0").first()
    if header is None:
        raise ValueError(f"{path} is empty")
    names = header.value.split("\t")
    values = F.split("value", "\t", -1)
    rows = lines.where(F.col("_row") != header["_row"]).withColumn("_values", values)
    matches = F.size("_values") == len(names)
    good = rows.where(matches).select(
        *[F.get("_values", F.lit(i)).alias(n) for i, n in enumerate(names)])
    bad = rows.where(~matches).select("value", F.size("_values").alias("found"))
    return good, bad


def with_id(records: DataFrame, table: str) -> DataFrame:
    """Derive ``_id``: ``<a>_<b>`` for a two-part join table, else ``<table>_id`` renamed."""
    parts = table.split("_")
    if len(parts) == 2:
        keys = [f"{p}_id" for p in parts]
        return records.withColumn(ID, F.concat_ws("_", *[F.col(k).cast("string") for k in keys]))
    if f"{table}_id" in records.columns:
        return records.withColumnRenamed(f"{table}_id", ID)
    return records


def read_tsv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """One table, typed.  ``strict`` fails on a malformed line instead of leaving it out."""
    good, bad = split_lines(spark, path)
    if strict:
        first_bad = bad.first()
        if first_bad is not None:
            raise ValueError(f"{path}: column count mismatch in line {first_bad.value!r}")
    return with_id(infer.typed(good), table_name(path))


@dataclass
class Loaded:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def tsv_files(spark: SparkSession, directory: str) -> list[str]:
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.tsv")
        .option("recursiveFileLookup", True).load(directory)
    )
    return sorted(re.sub(r"^file:/+", "/", r.path) for r in listing.select("path").collect())


def load_directory(spark: SparkSession, directory: str, sink=None) -> Loaded:
    """Every TSV file below ``directory``.

    ``sink(table, records)`` is called per table, typically a commit.  A table that
    fails is logged and recorded; the others go on.
    """
    loaded = Loaded()
    for path in tsv_files(spark, directory):
        table = table_name(path)
        try:
            records = read_tsv(spark, path)
            if sink is not None:
                sink(table, records)
            loaded.tables[table] = records
        except Exception as error:  # noqa: BLE001 - isolation per table is the feature
            log.error("table %s failed: %s", table, error)
            loaded.errors[table] = str(error)
    return loaded


def check_count(df: DataFrame, expected: int, name: str = "table") -> int:
    """Fail unless the table holds exactly the expected number of rows."""
    found = df.count()
    if found != expected:
        raise ValueError(f"{name}: expected {expected} rows, found {found}")
    return found
