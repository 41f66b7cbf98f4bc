"""End-to-end run: Bronze -> Silver -> Gold tables plus one quality-report run.

Every layer is written once as a partitioned Parquet table and the next layer
reads it back, so Silver (three consumers) is computed once and the Gold
builds and the report read pruned columns and partitions from storage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.predicates import anomaly_rules, daily_rules, drop_rules, hourly_rules
from ..operators.expectations import expectation_metrics, failure_mask, mask_histogram, mask_metrics
from ..operators.rolling import tasks_for
from ..session import scratch_dir
from ..sources.tables import LAYOUTS, append_run, publish, read_as, write_partitioned
from . import layers as L
from .quality import quality_report

RULE_METRICS = "rule_metrics"


#: What each published table is and who reads it. The quality and consumer properties.
ABOUT = {
    "bronze_sensors": ("Raw sensor readings as they came in.", {"quality": "bronze"}),
    "silver_sensors": ("Readings without duplicates, nulls and out-of-range values.", {"quality": "silver"}),
    "gold_hourly_stats": ("Hourly statistics per machine and sensor type.",
                          {"quality": "gold", "consumer": "operations-dashboard"}),
    "gold_daily_health": ("Daily health score per machine.",
                          {"quality": "gold", "consumer": "maintenance-dashboard"}),
    "gold_anomalies": ("Readings with a rolling z-score above the threshold.",
                       {"quality": "gold", "consumer": "alert-system"}),
}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder of this application; all of them are removed when the driver ends (not if it is killed)."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def run_pipeline(spark: SparkSession, source: DataFrame | str, warehouse: str, run_id: str, checked_at: str,
                 cfg: PipelineConfig = DEFAULT, strategy: str = "bucketed", database: str | None = None) -> dict:
    """Write all layers under ``warehouse`` and add the run's quality and rule rows (a repeated run replaces its own).

    ``source`` is a DataFrame or the name of a catalog table. With ``database`` the
    five layers are also catalog tables there, with comment and properties. The
    rule failures of the run are added to the ``rule_metrics`` table, counted
    from the stored layers (counters that ride along with a write may count the
    rows of a repeated task again). Returns the table paths.
    """
    t = cfg.tables
    source = spark.table(source) if isinstance(source, str) else source
    paths = {name: f"{warehouse.rstrip('/')}/{name}" for name in
             (t.bronze, t.silver, t.hourly, t.daily, t.anomalies, t.quality, RULE_METRICS)}

    def put(name: str, df: DataFrame, rebalance: bool = True) -> DataFrame:
        if database:
            comment, properties = ABOUT.get(name, ("", {}))
            publish(df, f"{database}.{name}", comment, properties, LAYOUTS.get(name, ()), path=paths[name],
                    rebalance=rebalance)
        else:
            write_partitioned(df, paths[name], LAYOUTS.get(name, ()), rebalance=rebalance)
        return read_as(spark, paths[name], df)

    # a Bronze task's rows have few sensor types: written without a shuffle
    bronze = put(t.bronze, L.bronze_ingest(source, cfg), rebalance=False)
    # deduplicated once, with each row's rule failures, for Silver and for the counts
    masked = L.deduplicated(bronze, cfg).withColumn("_failures", failure_mask(drop_rules(cfg)))
    store = shared_dir(spark, "deduplicated")
    masked.write.parquet(store)
    masked = read_as(spark, store, masked)
    silver = put(t.silver, masked.filter("_failures = 0").drop("_failures").withColumn("_silver_processed_at", F.current_timestamp()))

    def gold(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return put(name, build().withColumn("_gold_processed_at", F.current_timestamp()))

    # The three Gold tables only share the stored Silver: build them as
    # concurrent jobs so the scheduler can overlap their stages.
    with ThreadPoolExecutor(max_workers=3) as pool:
        futures = [pool.submit(gold, t.hourly, lambda: L.gold_hourly(silver, cfg)),
                   pool.submit(gold, t.daily, lambda: L.gold_daily(silver, cfg)),
                   pool.submit(gold, t.anomalies, lambda: L.gold_anomalies(silver, cfg, strategy, tasks_for(silver, cfg)))]
        hourly, daily, anomalies = [f.result() for f in futures]

    append_run(quality_report(bronze, silver, hourly, daily, anomalies, run_id, checked_at, cfg), paths[t.quality])
    append_run(rule_failures(masked, hourly, daily, anomalies, cfg).withColumn("run_id", F.lit(run_id)), paths[RULE_METRICS])
    return {"paths": paths, "tables": dict(zip((t.bronze, t.silver, t.hourly, t.daily, t.anomalies),
                                               (bronze, silver, hourly, daily, anomalies), strict=True))}


def rule_failures(masked: DataFrame, hourly: DataFrame, daily: DataFrame, anomalies: DataFrame,
                  cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Failure counts of every rule of Silver (drop; ``masked`` holds the masks) and the Gold tables (warn)."""
    t = cfg.tables
    parts = [mask_metrics(mask_histogram(masked, "_failures"), drop_rules(cfg), t.silver, "drop"),
             expectation_metrics(hourly, hourly_rules(), t.hourly, "warn"),
             expectation_metrics(daily, daily_rules(cfg), t.daily, "warn"),
             expectation_metrics(anomalies, anomaly_rules(cfg), t.anomalies, "warn")]
    return reduce(DataFrame.unionByName, parts)


def main(argv: list[str] | None = None) -> dict:
    """Command-line run for ``spark-submit``:

    spark-submit --py-files sensorlake.zip run_pipeline.py --bronze <parquet> --warehouse <dir>
    (``--events <parquet>`` derives the Bronze readings from an events table instead).
    """
    import argparse
    from datetime import datetime, timezone

    from ..config import DEFAULT, FIXTURE
    from ..sources.fixture import bronze_from_events

    ap = argparse.ArgumentParser(description="Bronze -> Silver -> Gold + quality report")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--bronze", help="Parquet table of raw readings")
    src.add_argument("--table", help="catalog table of raw readings")
    src.add_argument("--events", help="Parquet events table to derive readings from")
    ap.add_argument("--warehouse", required=True, help="shared output folder for the layer tables")
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--checked-at", default=None, help="wall-clock time of the run (UTC)")
    ap.add_argument("--expected-days", type=int, default=None)
    ap.add_argument("--strategy", default="bucketed", choices=["bucketed", "window"])
    ap.add_argument("--database", default=None, help="also publish the layers as tables of this database")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("sensorlake-pipeline").getOrCreate()
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    run_id = a.run_id or now.strftime("%Y%m%d_%H%M%S")
    checked_at = a.checked_at or now.strftime("%Y-%m-%d %H:%M:%S")
    cfg = FIXTURE if a.events else DEFAULT
    if a.expected_days:
        cfg = cfg.with_thresholds(expected_days=a.expected_days)
    source = (bronze_from_events(spark.read.parquet(a.events), cfg) if a.events
              else a.table or spark.read.parquet(a.bronze))
    return run_pipeline(spark, source, a.warehouse, run_id, checked_at, cfg, a.strategy, a.database)

