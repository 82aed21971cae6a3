"""Benchmark the headline queries; prints ONE JSON line.

env:
  BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
  BENCH_CPUS     local[N] cores (default 8)
  BENCH_REPEATS  timed runs per query, median reported (default 3)
  BENCH_QUERIES  comma-separated subset (default: HEADLINE)

Each run builds the query (stage checkpoints included) and executes the
whole plan into Spark's no-op sink, so nothing is collected to the driver.
Timings are warm: one untimed run of the first query precedes the loop.
``control_sec`` times a plain Spark aggregate over the order lines, without any
code of this library, before and after the queries: it moves with the machine only.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_transactions",
    "clean_audit",
    "rfm",
    "rfm_top_monetary",
    "revenue_describe",
    "rfm_scaled",
    "cluster_profile",
    "silhouette_fixed_centres",
    "kmeans_counts",
    "temporal_profile",
    "top_hour_unique",
    "hour_share",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from cohortlens.plans.catalog import queries
    from cohortlens.session import build_session

    spark = build_session(
        f"local[{cpus}]",
        app_name="cohortlens-bench",
        shuffle_partitions=cpus,
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def control() -> float:
        t0 = time.perf_counter()
        lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        lines.groupBy("l_partkey").agg({"l_extendedprice": "sum"}).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run(names[0])  # warm-up: JVM, file listing, codegen caches
    control()
    controls = [control() for _ in range(repeats)]
    timings: dict[str, float] = {}
    for name in names:
        timings[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)

    controls += [control() for _ in range(repeats)]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "repeats": repeats,
                "control_sec": round(statistics.median(controls), 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
