"""Benchmark: headline queries and the end-to-end pipeline at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPS (timed runs per query after one warm-up, default 3),
BENCH_QUERIES (optional comma list limiting the headline queries).
Each query is executed in full with the ``noop`` sink (no driver collect).
Prints ONE JSON line; ``value`` is the median end-to-end pipeline time
(Bronze -> Silver -> 3 Gold tables written + one quality-report run appended).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "silver_clean", "gold_hourly_stats", "gold_daily_health", "gold_anomalies",
    "rolling_zscore_bucketed", "expect_drop_metrics", "null_counts", "duplicate_ids",
    "anomaly_summary", "top_anomalies", "machine_health_overall", "quality_report",
    "row_flow", "key_findings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from sensorlake.plans.layers import Layers
    from sensorlake.plans.pipeline import run_pipeline, shared_dir
    from sensorlake.plans.registry import QUERIES
    from sensorlake.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="sensorlake-bench")

    def run_query(k: str) -> None:
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def run_pipe() -> None:
        ly = Layers.from_testdata(spark, sf_dir)
        run_pipeline(spark, ly.bronze, shared_dir(spark, "bench-wh"), "20240201_000000",
                     "2024-02-01 00:00:00", ly.cfg)

    def timed(fn) -> float:
        fn()  # warm-up
        ts = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t0)
        return round(statistics.median(ts), 3)

    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    keys = [k for k in HEADLINE if not only or k in only]
    # the headline pipeline first, before the per-query runs load the JVM
    pipe = timed(run_pipe)
    results = {k: timed(lambda k=k: run_query(k)) for k in keys}
    results["pipeline_end_to_end"] = pipe
    print(json.dumps({
        "metric": "pipeline_end_to_end_median",
        "value": results["pipeline_end_to_end"],
        "unit": "sec",
        "queries": results,
        "queries_total_sec": round(sum(v for k, v in results.items() if k != "pipeline_end_to_end"), 3),
        "sf": sf,
        "cpus": cpus,
        "reps": reps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
