"""Times the headline queries on local Spark and prints one JSON line.

Each query is run twice to warm up, then three times to completion (built and executed into a
sink that discards rows); the median counts. Environment: BENCH_SF_DIR, BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from openloop.bindings.queries import QUERIES  # noqa: E402

HEADLINE = [
    "q1_repeat_customers",
    "q1_repeat_users",
    "q2_type_trend",
    "q3_top_brands",
    "q4_throughput",
    "q5_errors_unresolved",
    "q5_returns_unclosed",
    "q6_daily_events",
    "q6_daily_orders",
    "k17_grain_lines",
    "k19_outside_run",
    "l3_load_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("openloop-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE * 2:
        once(name)
    times = {
        name: round(statistics.median(once(name) for _ in range(3)), 3) for name in HEADLINE
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "audit_reports_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rpartition("sf")[2],
            }
        )
    )


if __name__ == "__main__":
    main()
