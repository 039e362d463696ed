"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark import session  # noqa: E402
from tidemark.queries import all_queries  # noqa: E402

HEADLINE = (
    "valid_as_of", "late_arrival_as_of", "current_state", "all_versions", "late_arrival_versions",
    "portion_split", "update_expr", "patch_merge", "tpch_q5_local_supplier", "unify_self_join",
    "as_of_join", "billing_report", "billing_trend", "order_status_progression",
    "late_price_correction", "bulk_corrections", "cdc_apply_current", "cdc_apply_history",
    "count_distinct", "left_join_chain",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    memory = os.environ.get("BENCH_MEMORY", "16g")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus)
    )
    spark = session.build(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    timings = {}
    for name, (fn, _) in all_queries().items():
        if name not in (only or HEADLINE):
            continue
        runs = []
        for attempt in range(RUNS + 1):
            start = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:  # the first run warms up code generation and the file cache
                runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs), 3)
        print(f"{name} {timings[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total of median warm query times", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "master": f"local[{cpus}]", "driver_memory": memory, "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
