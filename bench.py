"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder with the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from caretiers.config import tune_session
from workload.queries import QUERIES

HEADLINE = (
    "silver_patients",
    "silver_encounters",
    "mart_patient_summary",
    "bronze_incremental",
    "fhir_patients",
    "fhir_encounters",
    "upsert_dim_patient",
    "landing_to_mart",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = tune_session(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        # Recording the Python line behind every expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
