"""The rolling z-score's plan: buckets from a histogram, frames from merged states."""

import math
import statistics
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorlake.config import DEFAULT
from sensorlake.operators import rolling as R
from tests.conftest import SCHEMA

T0 = datetime(2024, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
STATS = ["event_id", "machine_id", "rolling_avg", "rolling_stddev", "z_score"]


def frame(spark, rows):
    """Rows of (id, machine, value, seconds or None)."""
    return spark.createDataFrame([(i, m, "pressure", v, "bar", None if s is None else T0 + timedelta(seconds=s), T0) for i, m, v, s in rows], SCHEMA)


def outcome(df, cfg, strategy):
    return sorted(map(repr, R.rolling_zscore(df, cfg, strategy).select(STATS).collect()))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["M1", "M2", None]), st.one_of(st.none(), st.integers(-50, 9000).map(lambda x: x / 8)),
                          st.one_of(st.none(), st.integers(0, 40_000))), max_size=160),
       st.integers(0, 12), st.integers(1, 40), st.sampled_from([1, 60, 3600]))
def test_any_series_and_bucket_equal_the_window_form(spark, rows, preceding, bucket, cell):
    # bursts, gaps of hours, null times, values and machines; buckets far smaller than an hour's rows
    df = frame(spark, [(f"e{k:04d}", *r) for k, r in enumerate(rows)])
    cfg = DEFAULT.with_anomaly(preceding=preceding, bucket_rows=bucket, cell_seconds=cell)
    assert outcome(df, cfg, "bucketed") == outcome(df, cfg, "window")


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_bursts_across_a_change_of_the_clock(spark, zone, kind):
    # an hour that local time skips lies among the readings
    start = (datetime(2024, 3, 30, 22) - T0).total_seconds()
    rows = [(f"e{k:05d}", "M1", float(k * 7919 % 101), start + k * 17) for k in range(1500)]
    rows += [(f"f{k:05d}", "M1", float(k % 7), start + 9000 + k // 200) for k in range(1500)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = frame(spark, rows).withColumn("timestamp", F.col("timestamp").cast(kind))
        cfg = DEFAULT.with_anomaly(preceding=20, bucket_rows=100)
        assert outcome(df, cfg, "bucketed") == outcome(df, cfg, "window")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hot_series_is_split_and_no_bucket_is_large(spark):
    rows = [(f"e{k:05d}", "HOT", float(k % 13), k) for k in range(6000)]  # one a second
    rows += [(f"h{k:05d}", "HOT", 1.0, 3000 + k // 50) for k in range(4000)]  # a burst of 50 a second in one hour
    rows += [(f"m{k:05d}", f"M{k % 9}", 2.0, k) for k in range(900)]
    cfg = DEFAULT.with_anomaly(preceding=50, bucket_rows=320, cell_seconds=1)
    sizes = R.bucketed(frame(spark, rows), cfg).groupBy("machine_id", "_b").agg(
        F.count_if(~F.col("_carry")).alias("own"), F.count("*").alias("n")).collect()
    hot = [r for r in sizes if r.machine_id == "HOT"]
    assert sum(r.own for r in sizes) == len(rows) and len(hot) > 20
    # a bucket ends with the cell that passes its size; the carried rows fill the frame and no more than some cells
    assert max(r.n for r in hot) < 2 * 320 and all(r.n - r.own <= 50 + 51 for r in hot)
    assert all(r._b == 0 for r in sizes if r.machine_id != "HOT")


def test_building_starts_no_job_and_shuffles_the_rows_once(spark):
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    df = frame(spark, [(f"e{k}", "M1", 1.0, k) for k in range(200)])
    before = jobs()
    out = R.rolling_zscore(df, DEFAULT.with_anomaly(bucket_rows=60))
    assert out.columns and jobs() == before
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate inline")]
    assert above.count("Exchange") == 1 and "hashpartitioning(machine_id" in above


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([1e12, 1e12 + 1, 0.1])), max_size=90), st.integers(0, 9))
def test_merged_states_are_the_frames(spark, values, preceding):
    rows = [(k, v) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, v double")
    for r in R.sliding_stats(df.withColumn("g", F.lit(1)), ["g"], ["k"], "v", preceding).collect():
        part = [v for v in values[max(0, r.k - preceding):r.k + 1] if v is not None]
        if not part:
            assert r._ravg is None and r._rstd is None
            continue
        scale = max(map(abs, part)) + 1e-9
        assert math.isclose(r._ravg, math.fsum(part) / len(part), rel_tol=1e-12, abs_tol=scale * 1e-13)
        if len(part) == 1:
            assert r._rstd is None
        else:
            assert math.isclose(r._rstd, statistics.stdev(part), rel_tol=1e-6, abs_tol=scale * 1e-7)


def test_long_series_lose_no_digits(spark):
    # a huge reading long ago must not disturb later frames
    rows = [(f"e{k:05d}", "M1", 1e15 if k == 3 else 1.0 + (k % 5) / 100, k) for k in range(3000)]
    cfg = DEFAULT.with_anomaly(bucket_rows=100_000)
    late = R.rolling_zscore(frame(spark, rows), cfg).filter("event_id > 'e00100'")
    want = R.rolling_zscore(frame(spark, rows), cfg, "window").filter("event_id > 'e00100'")
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, want.collect()))


def test_tasks_follow_the_rows_and_share_them(spark):
    # one hot series and some small ones: no task holds more than a few buckets, however many rows there are
    rows = [(f"e{k:05d}", "HOT", None if k % 9 == 0 else float(k % 13), k) for k in range(6000)]
    rows += [(f"m{k:05d}", None if k % 4 == 0 else f"M{k % 4}", 2.0, None if k % 50 == 0 else k) for k in range(400)]
    cfg = DEFAULT.with_anomaly(preceding=50, bucket_rows=100, cell_seconds=1, task_rows=200)
    df = frame(spark, rows)
    # a tenfold table gets tenfold the tasks
    assert R.tasks_for(df, cfg) == -(-6400 // 200) and R.tasks_for(spark.range(64_000), cfg) == 320
    assert R.tasks_for(df.limit(0), cfg) >= 1
    dealt = R.rolling_zscore(df, cfg, tasks=R.tasks_for(df, cfg))
    sizes = [r[1] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 8 * 200
    assert sorted(map(repr, dealt.select(STATS).collect())) == outcome(df, cfg, "window")


def test_kept_layers_deal_the_rolled_rows(spark, tmp_path):
    from sensorlake.plans.layers import Layers
    df = frame(spark, [(f"e{k:05d}", "HOT", 2.0 + k % 5, k) for k in range(3000)])
    cfg = DEFAULT.with_anomaly(bucket_rows=100, cell_seconds=1, task_rows=300)

    def keep(name, part):
        part.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    ly = Layers(df, cfg, keep=keep)
    assert ly.rolled.count() == 3000 and ly.tasks >= 10
    # coalescing joined all these small buckets in one task
    assert len(list(tmp_path.glob("rolled/part-*"))) > 3
