"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 4) choose the
tables and the cores. Every query runs once to warm up; the median of the same number of
following runs is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from lakespark import configure  # noqa: E402
from lakespark.queries import load  # noqa: E402

HEADLINE = (
    "q01_q06_native_qa",
    "a01_lake_window_stats",
    "a02_scene_share_stats",
    "j01_assign_lake",
    "j03_scene_candidate_lakes",
    "j12_same_lake_nearest",
    "j16_complete_science_grid",
    "j17_compare_native_first",
    "a13_pair_metrics_full",
)
RUNS = 2


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lakespark-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, _ = load()
    wanted = sys.argv[1:] or HEADLINE
    took: dict[str, float] = {}
    for name in wanted:
        times: list[float] = []
        for run in range(RUNS + 1):
            start = time.perf_counter()
            registered[name](spark, sf).write.format("noop").mode("overwrite").save()
            if run:
                times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
