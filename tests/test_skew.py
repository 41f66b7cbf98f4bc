"""Hot keys: results stay whole and exact; the plans keep hot groups split."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sensorlake.config import DEFAULT
from sensorlake.operators.dedup import dedup
from sensorlake.operators.rolling import rolling_zscore
from tests.conftest import SCHEMA

T0 = datetime(2024, 1, 1)


def test_hot_id_dedup_keeps_preferred_copy(spark):
    # one id copied 30,000 times over 16 partitions (a third of the rows), the
    # only copy with a value sits in the middle; 60,000 other unique ids
    hot = (spark.range(30_000).repartition(16)
           .select(F.lit("HOT").alias("event_id"), F.lit("M1").alias("machine_id"),
                   F.lit("pressure").alias("sensor_type"),
                   F.when(F.col("id") == 12_345, F.lit(5.0)).alias("value"),
                   F.lit("bar").alias("unit"),
                   (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("timestamp"),
                   (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ingested_at")))
    rest = (spark.range(60_000)
            .select(F.concat(F.lit("E"), F.col("id").cast("string")).alias("event_id"),
                    F.lit("M2").alias("machine_id"), F.lit("pressure").alias("sensor_type"),
                    (F.col("id") % 7).cast("double").alias("value"), F.lit("bar").alias("unit"),
                    F.lit(T0).cast("timestamp_ntz").alias("timestamp"),
                    F.lit(T0).cast("timestamp_ntz").alias("ingested_at")))
    out = dedup(hot.unionByName(rest))
    assert out.count() == 60_001
    h = out.filter("event_id = 'HOT'").first()
    assert h.value == 5.0 and h.timestamp == T0 + timedelta(seconds=12_345)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan  # folded map-side before the shuffle


def test_hot_series_is_cut_into_buckets(spark):
    # one series holds 3/4 of the rows: the plan is the same as for any other
    # and matches the single-window result
    n_hot, n_other = 3_000, 1_000
    rows = spark.range(n_hot + n_other).select(
        F.concat(F.lit("e"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("event_id"),
        F.when(F.col("id") < n_hot, F.lit("HOT")).otherwise(
            F.concat(F.lit("M"), (F.col("id") % 4).cast("string"))).alias("machine_id"),
        F.lit("temperature").alias("sensor_type"),
        (F.lit(70.0) + (F.col("id") * 7919 % 101) / 10.0).alias("value"),
        F.lit("celsius").alias("unit"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("timestamp"),
        F.lit(T0).cast("timestamp_ntz").alias("ingested_at"))
    cfg = DEFAULT.with_anomaly(bucket_rows=400)
    out = rolling_zscore(rows, cfg)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_b" in plan
    ref = sorted(map(tuple, rolling_zscore(rows, cfg, "window").collect()))
    assert sorted(map(tuple, out.collect())) == ref


def test_any_frame_works_with_any_bucket_size(spark):
    rows = spark.range(120).select(
        F.lpad(F.col("id").cast("string"), 4, "0").alias("event_id"), F.lit("M").alias("machine_id"),
        F.lit("pressure").alias("sensor_type"), (F.col("id") % 9).cast("double").alias("value"),
        F.lit("bar").alias("unit"), F.lit(T0).cast("timestamp_ntz").alias("timestamp"),
        F.lit(T0).cast("timestamp_ntz").alias("ingested_at"))
    cfg = DEFAULT.with_anomaly(preceding=100, bucket_rows=80)
    ref = sorted(map(tuple, rolling_zscore(rows, cfg, "window").collect()))
    assert len(ref) == 120 and sorted(map(tuple, rolling_zscore(rows, cfg).collect())) == ref
