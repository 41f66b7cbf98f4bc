"""Pipeline row flow, key findings and the dashboard datasets.

One-row results from different tables are combined without joins: each is a
global aggregate (partial per task, merged once), the pieces are unioned with
disjoint columns and folded into one row by ``max`` per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.rounding import pct, round_half_up
from .explore import tagged
from .health_report import avg_score_1dp


def row_flow(bronze: DataFrame, silver: DataFrame, hourly: DataFrame, daily: DataFrame,
             anomalies: DataFrame) -> DataFrame:
    u = tagged({"b": bronze, "s": silver, "h": hourly, "d": daily, "a": anomalies})
    t = F.col("_t")
    g = u.agg(*[F.count_if(t == k).alias(n) for k, n in
                [("b", "bronze_rows"), ("s", "silver_rows"), ("h", "hourly_rows"),
                 ("d", "daily_rows"), ("a", "anomaly_rows")]])
    retained = pct(F.col("silver_rows"), F.col("bronze_rows"), 1)
    return g.select("bronze_rows", (F.col("bronze_rows") - F.col("silver_rows")).alias("rows_removed"),
                    round_half_up(F.lit(100.0) - retained, 1).alias("removed_pct"),
                    "silver_rows", retained.alias("retained_pct"),
                    "hourly_rows", "daily_rows", "anomaly_rows")


def _fold(*pieces: DataFrame) -> DataFrame:
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def key_findings(counts: DataFrame, daily: DataFrame, anomalies: DataFrame,
                 report: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One wide row: raw and clean counts, retention, check pass rate, anomaly
    count, the machine with the lowest mean health score, the sensor type with
    most anomalies, and the single most extreme reading.

    ``counts`` is the one row of ``layer_counts`` that ``report`` was made from.
    """
    c = cfg.cols
    counts = counts.select(
        F.col("bronze_rows").alias("total_raw_readings"), F.col("silver_rows").alias("clean_readings"),
        F.col("anomaly_rows").alias("anomalies_detected"),
        pct(F.col("silver_rows"), F.col("bronze_rows"), 1).alias("retained_pct"))
    per_machine = daily.groupBy(c.machine).agg(avg_score_1dp(F.col("health_score_pct")).alias("s"))
    worst = per_machine.agg(F.min_by(F.struct(F.col(c.machine).alias("m"), F.col("s")),
                                     F.struct(F.col("s"), F.col(c.machine))).alias("w")).select(
        F.col("w.m").alias("worst_machine_id"), F.col("w.s").alias("worst_machine_avg_score"))
    # anomalies in one pass: per sensor type the count and its most extreme reading
    rz = round_half_up(F.col("z_score"), 2)
    extreme = F.struct((-rz).alias("o1"), (-F.col("z_score")).alias("o2"), F.col(c.event_id).alias("o3"))
    reading = F.struct(F.col(c.machine).alias("m"), F.col(c.sensor).alias("t"), rz.alias("z"))
    per_sensor = anomalies.groupBy(c.sensor).agg(
        F.count(F.lit(1)).alias("n"), F.min(extreme).alias("o"), F.min_by(reading, extreme).alias("x"))
    found = per_sensor.agg(
        F.min_by(F.struct(F.col(c.sensor).alias("t"), F.col("n")),
                 F.struct((-F.col("n")).alias("o"), F.col(c.sensor))).alias("most"),
        F.min_by("x", "o").alias("top")).select(
        F.col("most.t").alias("most_anomalous_sensor"), F.col("most.n").alias("most_anomalous_sensor_count"),
        F.col("top.m").alias("max_z_machine_id"), F.col("top.t").alias("max_z_sensor_type"),
        F.col("top.z").alias("max_z_score"))
    s = F.col("status")
    rate = report.agg(round_half_up(F.try_divide(F.count_if(s == "PASS").cast("double"),
                                                 F.count(F.lit(1)).cast("double")) * F.lit(100.0), 0)
                      .alias("quality_pass_rate"))
    return _fold(counts, rate, worst, found).select(
        "total_raw_readings", "clean_readings", "retained_pct", "quality_pass_rate", "anomalies_detected",
        "worst_machine_id", "worst_machine_avg_score", "most_anomalous_sensor",
        "most_anomalous_sensor_count", "max_z_machine_id", "max_z_sensor_type", "max_z_score")


# ---- dashboard datasets ----------------------------------------------------

def dash_hourly_trend(hourly: DataFrame, days: int = 7, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Hourly statistics of the last ``days`` days of data, in order.

    ``hourly`` is best the stored table, partitioned by date: the newest date
    comes from the partition values alone, and only the last partitions are read.
    """
    c = cfg.cols
    newest = hourly.agg(F.max("date")).scalar()
    recent = hourly.filter(F.col("date") >= F.date_sub(newest, days))
    last = recent.agg(F.max("hour_window")).scalar()
    return (recent.filter(F.col("hour_window") > last - F.make_dt_interval(days=F.lit(days)))
                  .orderBy(c.machine, c.sensor, c.unit, "hour_window")
                  .select(c.machine, c.sensor, c.unit, "hour_window", "reading_count",
                          "avg_value", "min_value", "max_value"))


def dash_health_heatmap(daily: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Long form (machine, date, score, status) — one cell per row."""
    return daily.select(cfg.cols.machine, "date", "health_score_pct", "machine_status")


def health_heatmap_wide(daily: DataFrame, dates: list[str], cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Machine x date matrix of scores, one column for each of ``dates`` (ISO text)."""
    day = F.col("date").cast("string")
    return daily.groupBy(cfg.cols.machine).agg(
        *[F.max(F.when(day == F.lit(d), F.col("health_score_pct"))).alias(d) for d in dates])


def dash_anomaly_points(anomalies: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    c = cfg.cols
    return anomalies.select(c.time, c.machine, c.sensor, c.value, "z_score")


def dash_drop_rate(rule_metrics: DataFrame) -> DataFrame:
    return rule_metrics.select("rule_index", "rule", "failed_records", "input_records",
                               pct(F.col("failed_records"), F.col("input_records"), 2).alias("drop_rate_pct"))
