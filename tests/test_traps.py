"""Micro-tables for the semantic traps of the source pipeline."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorlake.config import DEFAULT, FIXTURE
from sensorlake.functions.predicates import drop_rules
from sensorlake.operators.aggregates import daily_health, hourly_stats
from sensorlake.operators.dedup import dedup
from sensorlake.operators.expectations import expect_all_or_drop, expectation_metrics
from sensorlake.operators.rolling import rolling_zscore
from sensorlake.plans import health_report as HR
from sensorlake.plans import quality as QR
from sensorlake.plans.layers import silver_clean


def test_below_min_inclusive_bounds(readings):
    df = readings([("a", "M1", "temperature", 59.99, 0), ("b", "M1", "temperature", 60.0, 1),
                   ("c", "M1", "temperature", 120.0, 2), ("d", "M1", "temperature", 120.01, 3),
                   ("e", "M1", "pressure", 0.99, 4), ("f", "M1", "pressure", 1.0, 5),
                   ("g", "M1", "vibration", 0.009, 6), ("h", "M1", "vibration", 0.01, 7)])
    kept = sorted(r.event_id for r in silver_clean(df, DEFAULT).collect())
    assert kept == ["b", "c", "f", "h"]


def test_null_counts_as_rule_failure(readings):
    df = readings([("a", "M1", "temperature", None, 0), ("b", "M1", "pressure", None, 1),
                   (None, "M1", "vibration", 1.0, 2), ("d", "M1", None, 5.0, 3),
                   ("e", "M1", "vibration", 1.0, 4)])
    m = {r.rule: r.failed_records for r in
         expectation_metrics(dedup(df), drop_rules(DEFAULT), "silver").collect()}
    assert m["value is not null"] == 2
    # a NULL reading fails its own sensor's range rule too; a NULL sensor type
    # makes a rule NULL (= failure) wherever the value lies outside that range
    assert m["valid temperature range"] == 2 and m["valid pressure range"] == 1
    assert m["valid vibration range"] == 1
    assert m["event_id not null"] == 1
    kept = sorted(r.event_id for r in silver_clean(df, DEFAULT).collect())
    assert kept == ["e"]


def test_nan_and_infinity_are_out_of_range(readings):
    df = readings([("a", "M1", "temperature", float("nan"), 0),
                   ("b", "M1", "temperature", float("inf"), 1),
                   ("c", "M1", "temperature", float("-inf"), 2),
                   ("d", "M1", "temperature", 80.0, 3)])
    assert [r.event_id for r in silver_clean(df, DEFAULT).collect()] == ["d"]


def test_unknown_sensor_passes_rules_but_is_unhealthy(readings):
    df = readings([("a", "M1", "humidity", 50.0, 0), ("b", "M1", "temperature", 80.0, 1)])
    assert silver_clean(df, DEFAULT).count() == 2
    d = daily_health(silver_clean(df, DEFAULT)).collect()[0]
    assert d.health_score_pct == 50.0 and d.machine_status == "CRITICAL" and d.active_sensors == 2


def test_dedup_orders(readings):
    df = readings([("x", "M1", "temperature", None, 0, 1),
                   ("x", "M1", "temperature", 70.0, 1, 2),
                   ("x", "M1", "temperature", 75.0, 2, 3)])
    assert dedup(df, DEFAULT, "prefer_value").collect()[0].value == 70.0
    assert dedup(df, DEFAULT, "first_arrival").collect()[0].value is None
    # NULL ids collapse to a single row
    n = readings([(None, "M1", "temperature", 70.0, 0), (None, "M1", "temperature", 71.0, 1)])
    assert dedup(n).count() == 1


def test_dedup_idempotent_and_partition_invariant(readings):
    rows = [(f"e{i % 7}", "M1", "pressure", float(i) if i % 3 else None, i) for i in range(40)]
    df = readings(rows)
    once = sorted(map(tuple, dedup(df).collect()), key=str)
    assert sorted(map(tuple, dedup(dedup(df)).collect()), key=str) == once
    assert sorted(map(tuple, dedup(df.repartition(5)).collect()), key=str) == once


def _brute_rolling(values, p=50):
    out = []
    for i, v in enumerate(values):
        w = values[max(0, i - p): i + 1]
        avg = sum(w) / len(w)
        sd = pd.Series(w).std() if len(w) > 1 else None
        ravg = math.floor(avg * 1e4 * (1 + 2**-48) + 0.5) / 1e4
        rsd = None if sd is None or math.isnan(sd) else math.floor(sd * 1e4 * (1 + 2**-48) + 0.5) / 1e4
        d = rsd if rsd is not None and rsd > 0 else 1.0
        out.append((ravg, rsd, math.floor(abs(v - ravg) / d * 1e4 * (1 + 2**-48) + 0.5) / 1e4))
    return out


@pytest.mark.parametrize("strategy", ["window", "bucketed"])
def test_frame_is_51_rows(readings, strategy):
    vals = [1000.0] + [float(i % 5) for i in range(52)]
    df = readings([(f"e{i:03d}", "M1", "temperature", v, i) for i, v in enumerate(vals)])
    cfg = DEFAULT.with_anomaly(bucket_rows=52)
    got = rolling_zscore(df, cfg, strategy).orderBy("timestamp").collect()
    exp = _brute_rolling(vals)
    assert [(r.rolling_avg, r.rolling_stddev, r.z_score) for r in got] == exp
    assert got[50].rolling_avg > 15 and got[51].rolling_avg < 5  # row 51 sees row 1, row 52 not


def test_time_ties_broken_by_event_id(readings):
    df = readings([("b", "M1", "pressure", 5.0, 0), ("a", "M1", "pressure", 1.0, 0)])
    got = {r.event_id: r for r in rolling_zscore(df, DEFAULT, "window").collect()}
    assert got["a"].rolling_stddev is None and got["a"].z_score == 0.0
    assert got["b"].rolling_avg == 3.0


def test_flat_series_uses_divisor_one(readings):
    vals = [5.0] * 60 + [5.5]
    df = readings([(f"e{i:03d}", "M1", "pressure", v, i) for i, v in enumerate(vals)])
    got = rolling_zscore(df, DEFAULT, "window").orderBy("timestamp").collect()
    assert got[10].rolling_stddev == 0.0 and got[10].z_score == 0.0
    assert got[-1].z_score == pytest.approx(abs(5.5 - got[-1].rolling_avg) / got[-1].rolling_stddev, abs=1e-4)


def test_single_row(readings):
    r = rolling_zscore(readings([("a", "M1", "vibration", 1.0, 0)]), DEFAULT, "bucketed").collect()[0]
    assert r.rolling_stddev is None and r.z_score == 0.0 and r.rolling_avg == 1.0


def test_status_edges_exact_vs_rounded(readings):
    # 2000 readings per day, share in range: 100%, 95%, 94.96%, 80%, 79.9%
    rows = []
    for day, bad in enumerate([0, 100, 101, 400, 402]):
        for i in range(2000):
            v = 200.0 if i < bad else 80.0
            rows.append((f"d{day}-{i}", "M1", "temperature", v, day * 1440 + i % 1440))
    d = daily_health(readings(rows), DEFAULT).orderBy("date").collect()
    assert [x.health_score_pct for x in d] == [100.0, 95.0, 95.0, 80.0, 79.9]
    assert [x.machine_status for x in d] == ["NORMAL", "NORMAL", "WARNING", "WARNING", "CRITICAL"]
    o = HR.machine_health_overall(daily_health(readings(rows[4000:6000]))).collect()[0]
    # 94.95 % shows as 95.0: WARNING on the exact share, NORMAL on the rounded score
    assert o.worst_day_score == 95.0 and o.overall_status == "NORMAL" and o.worst_daily_status == "WARNING"


def test_worst_status_by_severity_not_alphabet(readings):
    rows = [(f"a{i}", "M1", "temperature", 80.0, i) for i in range(20)]
    rows += [(f"b{i}", "M1", "temperature", 80.0 if i < 18 else 200.0, 1440 + i) for i in range(20)]
    r = HR.machine_health_avg(daily_health(readings(rows))).collect()[0]
    assert r.worst_status == "WARNING" and r.avg_health_score == 95.0


def _report(spark, readings_df, run_id="r1", at="2024-02-01 00:00:00", cfg=FIXTURE, step=1):
    from sensorlake.plans.layers import Layers
    ly = Layers(readings_df, cfg)
    return QR.quality_report(ly.bronze, ly.silver, ly.hourly, ly.daily, ly.anomalies, run_id, at, cfg,
                             step_seconds=step)


def test_empty_input_gives_null_rates_not_errors(spark, readings):
    empty = readings([])
    rep = {r.check_name + "/" + r.layer: r for r in _report(spark, empty).collect()}
    assert rep["null_rate_pct/bronze"].metric_value is None
    assert rep["null_rate_pct/bronze"].status == "FAIL"
    assert rep["retention_pct/silver"].status == "FAIL"
    assert rep["row_count/silver"].metric_value == 0.0


def test_trend_groups_by_run_and_counts_are_zero_not_null(spark, readings):
    df = readings([(f"e{i}", "M1", "temperature", 80.0, i) for i in range(30)])
    hist = _report(spark, df, "r1", "2024-01-01 00:00:00").unionByName(
        _report(spark, df, "r2", "2024-01-02 00:00:00"))
    trend = QR.quality_trend(hist).orderBy("run_id").collect()
    assert [t.run_id for t in trend] == ["r1", "r2"] and all(t.total_checks == 15 for t in trend)
    layers = {r.layer: r for r in QR.quality_by_layer(hist).collect()}
    # anomaly rate 0 % warns; a status with no checks counts 0, not NULL
    assert layers["lineage"].warned == 1 and layers["lineage"].failed == 0


def test_optional_bronze_range_check(spark, readings):
    df = readings([("a", "M1", "temperature", 500.0, 0), ("b", "M1", "temperature", 80.0, 1)])
    cfg = FIXTURE.with_thresholds(with_bronze_range_check=True)
    rep = {r.check_name: r for r in _report(spark, df, cfg=cfg).filter("layer = 'bronze'").collect()}
    assert rep["out_of_range_pct"].metric_value == 50.0 and rep["out_of_range_pct"].status == "FAIL"


def test_vacuous_warn_rule_after_filter(spark, readings):
    from sensorlake.functions.predicates import anomaly_rules
    from sensorlake.operators.rolling import anomalies
    vals = [1.0 + (i % 3) * 0.01 for i in range(60)] + [9.0]
    df = readings([(f"e{i:03d}", "M1", "pressure", v, i) for i, v in enumerate(vals)])
    a = anomalies(rolling_zscore(df, DEFAULT, "window"))
    m = {r.rule: r.failed_records for r in expectation_metrics(a, anomaly_rules(DEFAULT), "g", "warn").collect()}
    assert m["z_score exceeds threshold"] == 0 and a.count() >= 1


def test_hourly_single_reading_stddev_null(readings):
    h = hourly_stats(readings([("a", "M1", "pressure", 2.0, 0)])).collect()[0]
    assert h.stddev_value is None and h.reading_count == 1 and str(h.hour_window) == "2024-01-01 00:00:00"


def test_expect_all_or_drop_equivalence(readings):
    rows = [(f"e{i}", "M1", ["temperature", "pressure", "vibration"][i % 3],
             None if i % 11 == 0 else float(i % 130), i) for i in range(90)]
    df = dedup(readings(rows))
    kept = expect_all_or_drop(df, drop_rules(DEFAULT)).count()
    m = expectation_metrics(df, drop_rules(DEFAULT), "s").first()
    assert m.input_records - m.dropped_records == kept


@pytest.mark.parametrize("strategy", ["window", "bucketed"])
def test_null_machine_is_its_own_series(readings, strategy):
    rows = [(f"n{i:03d}", None, "pressure", 2.0 + (i % 4), i) for i in range(70)]
    rows += [(f"m{i:03d}", "M1", "pressure", 3.0, i) for i in range(70)]
    df = readings(rows)
    cfg = DEFAULT.with_anomaly(bucket_rows=60)
    got = rolling_zscore(df, cfg, strategy)
    assert got.count() == 140
    ref = sorted(map(tuple, rolling_zscore(df, cfg, "window").collect()), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == ref


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_rounding_equals_sparks(spark, digits):
    from sensorlake.functions.rounding import round_half_up
    vals = [0.0, float("nan"), float("inf"), float("-inf"), 1e15, 1e15 + 0.25, 1e300, 1.23454999995, 1.2345, 2.675, 1.005]
    vals += [float(f"{k}{tail}e-{digits + len(tail)}") for k in range(40) for tail in ("5", "4999999", "5000001")]
    vals += [-v for v in vals]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = df.select("v", round_half_up(F.col("v"), digits).alias("a"), F.round("v", digits).alias("b")).collect()
    assert [r for r in got if r.a != r.b and not (math.isnan(r.a) and math.isnan(r.b))] == []


def test_hourly_and_daily_keep_the_time_type(spark, readings):
    rows = [("a", "M1", "pressure", 2.0, 0), ("b", "M1", "pressure", 3.0, 61)]
    wall = readings(rows)
    instant = wall.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert dict(hourly_stats(wall).dtypes)["hour_window"] == "timestamp_ntz"
    assert dict(hourly_stats(instant).dtypes)["hour_window"] == "timestamp"
    strip = lambda df: sorted((str(r.hour_window), r.avg_value) for r in hourly_stats(df).collect())
    assert strip(wall) == strip(instant)
    assert sorted(map(str, daily_health(wall).collect())) == sorted(map(str, daily_health(instant).collect()))


def test_listings_are_sorted(spark, readings):
    from sensorlake.plans import summary as SM
    rows = [(f"e{m}{d}{h}", f"M{m}", "temperature", 80.0, d * 1440 + h * 60) for d in (2, 0, 1) for m in (2, 1) for h in (5, 1)]
    df = readings(rows)
    listed = [(r.date, r.machine_id) for r in HR.daily_health_listing(daily_health(df)).collect()]
    assert listed == sorted(listed)
    trend = [(r.machine_id, r.sensor_type, r.unit, r.hour_window) for r in SM.dash_hourly_trend(hourly_stats(df), 7).collect()]
    assert trend == sorted(trend) and len(trend) == 12
    hist = _report(spark, df, "r2", "2024-01-02 00:00:00").unionByName(_report(spark, df, "r1", "2024-01-01 00:00:00"))
    detail = [(r.layer, r.check_name) for r in QR.quality_detail(hist).collect()]
    assert detail == sorted(detail)
    assert [r.run_id for r in QR.quality_trend(hist).collect()] == ["r1", "r2"]


def test_dedup_carries_map_columns(spark, readings):
    df = readings([("a", "M1", "pressure", None, 0), ("a", "M1", "pressure", 2.0, 1), ("b", "M1", "pressure", 1.0, 0)]) \
        .withColumn("tags", F.create_map(F.lit("k"), F.col("value").cast("string")))
    got = {r.event_id: (r.value, r.tags) for r in dedup(df).collect()}
    assert got == {"a": (2.0, {"k": "2.0"}), "b": (1.0, {"k": "1.0"})}


def test_checks_of_a_layer_need_only_its_tables(spark, readings):
    df = readings([(f"e{i}", "M1", "temperature", 80.0, i) for i in range(30)])
    full = [tuple(r) for r in _report(spark, df).collect()]
    got = [tuple(r) for r in QR.layer_report("bronze", {"bronze": df}, "r1", "2024-02-01 00:00:00", FIXTURE, 1).collect()]
    assert got == [r for r in full if r[1] == "bronze"]


def test_empty_bronze_summary_has_no_nulls_in_counts(readings):
    from sensorlake.plans.explore import bronze_quality_summary
    r = bronze_quality_summary(readings([]), readings([])).first()
    assert (r.duplicate_rows, r.expected_clean_rows_naive) == (0, 0)


def test_failing_rows_name_their_rules(readings):
    from sensorlake.operators.expectations import failing_rows
    df = readings([("a", "M1", "temperature", None, 0), (None, "M1", "pressure", 50.0, 1), ("c", "M1", "pressure", 5.0, 2)])
    got = {r.event_id: r.failed_rules for r in failing_rows(df, drop_rules(DEFAULT)).collect()}
    assert got == {"a": "value is not null; valid temperature range", None: "valid pressure range; event_id not null"}
