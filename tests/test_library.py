"""Library functions not reached by the oracle queries."""

from sensorlake.config import DEFAULT
from sensorlake.functions.predicates import drop_rules
from sensorlake.operators.dedup import dedup
from sensorlake.operators.expectations import expectation_metrics, observe_rules
from sensorlake.plans.layers import Layers
from sensorlake.plans.summary import health_heatmap_wide
from sensorlake.sources.tables import schema_rows


def test_observed_rule_counts_equal_the_aggregate(readings):
    rows = [(f"e{i}", "M1", ["temperature", "pressure", "vibration"][i % 3],
             None if i % 9 == 0 else float(i % 150), i) for i in range(120)]
    df = dedup(readings(rows))
    observed, obs = observe_rules(df, drop_rules(DEFAULT), "rules")
    observed.write.format("noop").mode("overwrite").save()
    got = obs.get
    agg = {r.rule: r.failed_records for r in expectation_metrics(df, drop_rules(DEFAULT), "s").collect()}
    assert got["input_records"] == 120
    assert {k: v for k, v in got.items() if k != "input_records"} == agg


def test_schema_rows(readings):
    rows = schema_rows(readings([("a", "M1", "pressure", 2.0, 0)])).orderBy("position").collect()
    assert [(r.column_name, r.data_type) for r in rows][:4] == [
        ("event_id", "string"), ("machine_id", "string"), ("sensor_type", "string"), ("value", "double")]
    assert rows[5].data_type == "timestamp_ntz"


def test_heatmap_wide_has_one_column_per_day(spark):
    ly = Layers.from_testdata(spark, "/root/testdata/sf0.001")
    daily = ly.daily
    days = [f"2024-01-{d:02d}" for d in range(1, 31)]
    wide = health_heatmap_wide(daily, days)
    assert wide.columns == ["machine_id", *days] and wide.count() == 5
    long = {(r.machine_id, str(r.date)): r.health_score_pct for r in daily.collect()}
    assert {(r.machine_id, d): r[d] for r in wide.collect() for d in days if r[d] is not None} == long


def test_fixture_anchor_figures(spark):
    """Expected sizes listed for the fixture at sf0.001 (FIXTURES.md §2)."""
    from pyspark.sql import functions as F

    from sensorlake.plans.layers import gold_daily
    ly = Layers.from_testdata(spark, "/root/testdata/sf0.001")
    assert ly.bronze.count() == 1020
    assert ly.bronze.filter("value IS NULL").count() == 38
    assert ly.deduped.count() == 1000 and ly.deduped.filter("value IS NULL").count() == 28
    assert ly.silver.count() == 938
    assert ly.hourly.count() == 894
    assert ly.anomalies.count() == 34
    assert ly.anomalies.agg(F.max("z_score")).first()[0] == 3.2414
    d = gold_daily(ly.deduped, ly.cfg)
    assert d.count() == 149
    status = {r.machine_status: r["count"] for r in d.groupBy("machine_status").count().collect()}
    assert status == {"NORMAL": 93, "WARNING": 44, "CRITICAL": 12}
    assert tuple(d.agg(F.min("health_score_pct"), F.max("health_score_pct")).first()) == (60.0, 100.0)
    assert ly.daily.filter("health_score_pct <> 100.0").count() == 0  # Silver is always healthy
