"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then five timed runs; the median counts.
A run executes the whole plan into the ``noop`` sink (no collect to the
driver, no output files), which is what a pipeline's write costs minus I/O.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "coalesce_upsert",
    "scd2_full",
    "load_incremental",
    "load_backfill",
    "stack_repeated_target",
    "dq_summary",
    "gold_cost_per_unit",
    "gold_profitability",
    "per_source_upsert",
    "dq_rejects",
    "multi_source_fold",
    "standardize_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tidemark.plans import registry
    from tidemark.session import build_session

    spark = build_session(f"local[{cpus}]", app="tidemark-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    registry.load_all()
    names = only or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        fn = registry.QUERIES[name]

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up: JIT, file listing caches, codegen
        times[name] = round(statistics.median(run() for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
