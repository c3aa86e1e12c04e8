"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times; the median counts.  Results go to the ``noop`` sink, so
that all rows and columns are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "n11_unpivot", "a01_hourly_rollup", "a01_hourly_from_wide", "a02_daily_rollup", "a02_daily_from_wide", "a04_resample_wu",
    "a17_pm25_daily", "c14_canonical_location", "j05_map_sensor_id", "w04_lag_features", "w05_moving_averages", "w06_cadence_summary",
    "q06_metric_coverage", "m01_threshold_alerts", "m03_apply_cooldown", "k05_upsert", "r03_stream_hourly",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("aeroloom-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from verification.catalog import QUERIES
    from verification.feeds import Feeds

    names = [n for n in HEADLINE if not sys.argv[1:] or any(p in n for p in sys.argv[1:])]
    took: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(statistics.median(times[1:]), 3)
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    long_rows = Feeds(spark, sf_dir).long().count()
    total = round(sum(took.values()), 3)
    # Rates of the queries that go through every long row.
    rate = {n: round(long_rows / took[n]) for n in ("n11_unpivot", "a01_hourly_from_wide") if n in took}
    print(json.dumps({"metric": "headline queries, sum of medians", "value": total, "unit": "sec", "queries": took,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "long_rows": long_rows,
                      "long_rows_per_sec": rate}))
    spark.stop()


if __name__ == "__main__":
    main()
