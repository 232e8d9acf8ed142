"""Benchmark the headline queries.

Runs each query of HEADLINE at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` (default 8), executing the
full plan through the ``noop`` sink (nothing is collected to the driver),
keeps the best of ``$BENCH_REPEATS`` (default 2) runs per query, and
prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINE = [
    "mart_route_hourly",
    "route_snapshot_hourly",
    "dedupe_trips",
    "dq_report",
    "scd2_merge",
    "lookup_as_of",
    "fact_trip",
    "fact_payment",
    "fact_vehicle_position",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from pyspark.sql import SparkSession

    from railyard.plans.registry import queries
    from railyard.session import BASE_CONF

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("railyard-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.default.parallelism", str(cpus))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    qs = queries()
    # Warm the JVM (class loading, codegen caches) outside the measurement.
    qs["speed_hourly"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # Each query is built and run end to end (plan, checks, checkpoints,
    # execution) REPEATS times; the best time is reported, which takes JIT
    # warm-up and machine noise out of the comparison between rounds.
    timings: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(REPEATS):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        timings[name] = round(best, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
