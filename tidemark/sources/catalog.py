"""Databases and tables of the Spark catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, database: str | None = None, limit: int | None = None) -> DataFrame:
    """Tables and views as rows, like an information schema."""
    rows = [(database or t.database or "", t.name, t.tableType)
            for t in spark.catalog.listTables(database)]
    found = spark.createDataFrame(
        rows, "table_schema string, table_name string, table_type string").orderBy("table_name")
    return found if limit is None else found.limit(limit)


def use_databases(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Save each ``database.table`` so one query can join across databases."""
    for name, df in tables.items():
        database = name.split(".")[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        df.write.mode("overwrite").saveAsTable(name)


def spark_version(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.version().alias("version"))
