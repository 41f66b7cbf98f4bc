"""Scaling run: the events table replicated N times inside Spark (ids offset
per copy, same 30 days, so every series and hour grows N-fold), then the
end-to-end pipeline. Prints one JSON line per N.

usage: python tools/scale_run.py [sf_dir] [N ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    ns = [int(a) for a in args if not a.startswith("/")] or [1, 10]
    from pyspark.sql import functions as F

    from sensorlake.config import FIXTURE
    from sensorlake.plans.pipeline import run_pipeline, shared_dir
    from sensorlake.session import local_session
    from sensorlake.sources.fixture import bronze_from_events
    from sensorlake.sources.tables import load

    spark = local_session(os.environ.get("BENCH_CPUS", "8"), 8, app="sensorlake-scale")
    events = load(spark, sf_dir, "events")
    for n in ns:
        rep = (events.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_r"))
                     .withColumn("event_id", F.col("event_id") + F.col("_r").cast("long") * F.lit(10**9))
                     .drop("_r"))
        bronze = bronze_from_events(rep, FIXTURE)
        t0 = time.perf_counter()
        out = run_pipeline(spark, bronze, shared_dir(spark, f"scale-{n}"), "20240201_000000",
                           "2024-02-01 00:00:00", FIXTURE)
        dt = time.perf_counter() - t0
        rows = spark.read.parquet(out["paths"]["silver_sensors"]).count()
        anoms = spark.read.parquet(out["paths"]["gold_anomalies"]).count()
        print(json.dumps({"copies": n, "silver_rows": rows, "anomalies": anoms,
                          "pipeline_sec": round(dt, 2)}), flush=True)


if __name__ == "__main__":
    main()
