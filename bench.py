"""Time the seven loads and the name match; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "upsert_inventory", "insert_new_requests", "insert_absent_payments", "upsert_schedule",
    "upsert_payload", "upsert_issues", "upsert_worker_payments", "fuzzy_vendor_match",
    "fuzzy_blocked", "published_inventory", "published_requests", "published_payments",
    "last_wins_batch", "first_wins_batch", "dim_date", "load_counters",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from testbed.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g").config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
