"""Run registered queries against their SQL in DuckDB: ``python tests/oracle.py [sf] [names..]``."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(pdf):
    """Rows as sorted tuples of text, columns by name."""
    pdf = pdf[sorted(pdf.columns)]
    columns = []
    for name in pdf.columns:
        column = pdf[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.astype("datetime64[us]")
        columns.append(["~" if pd.isna(v) else text(v) for v in column.tolist()])
    return list(pdf.columns), sorted(zip(*columns))


def text(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def compare(spark, con, sf_dir, fn, sql):
    got = canonical(fn(spark, sf_dir).toPandas())
    want = canonical(con.execute(sql).df())
    assert got[0] == want[0], f"columns {got[0]} != {want[0]}"
    assert len(got[1]) == len(want[1]), f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        assert a == b, f"{a} != {b}"
    return len(got[1])


def main():
    from pyspark.sql import SparkSession

    from tidemark.queries import all_queries

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name, (fn, sql) in all_queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            rows = compare(spark, con, sf_dir, fn, sql) if sql else fn(spark, sf_dir).count()
            status = "ok" if sql else "no sql"
        except Exception as error:  # noqa: BLE001 - report and go on
            rows, status, bad = -1, f"FAIL {str(error)[:700]}", bad + 1
        print(f"{name:28s} {rows:8d} {time.time() - start:6.2f}s {status}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
