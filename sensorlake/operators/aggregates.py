"""Gold aggregates: hourly statistics and daily machine health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.predicates import in_range
from ..functions.rounding import halfup_int_ratio, int_div, round_half_up
from ..functions.status import health_status_from_avg5


def hour_of(df: DataFrame, time: str) -> F.Column:
    """Hour bucket of the column's own type (truncation alone gives TIMESTAMP)."""
    return F.date_trunc("hour", F.col(time)).cast(df.schema[time].dataType)


def hourly_stats(df: DataFrame, cfg: PipelineConfig = DEFAULT, with_date: bool = True) -> DataFrame:
    """Per machine, sensor, unit and hour: count, mean, min, max, sample
    stddev (NULL for a single reading), rounded to 4 decimals."""
    c = cfg.cols
    v = F.col(c.value)
    out = (df.groupBy(c.machine, c.sensor, c.unit, hour_of(df, c.time).alias("hour_window"))
             .agg(F.count(F.lit(1)).alias("reading_count"),
                  round_half_up(F.avg(v), 4).alias("avg_value"),
                  round_half_up(F.min(v), 4).alias("min_value"),
                  round_half_up(F.max(v), 4).alias("max_value"),
                  round_half_up(F.stddev_samp(v), 4).alias("stddev_value")))
    if with_date:
        out = out.withColumn("date", F.to_date("hour_window"))
    return out


def daily_health(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Per machine and day: readings, distinct sensors, health score (share of
    in-range readings in %, 1 decimal), mean per sensor type (2 decimals,
    NULL when absent) and status.

    The score follows DECIMAL semantics exactly: the share is an average
    rounded half-up to 5 places, times 100, rounded to 1 place; the status
    compares the 5-place share. Both are integer arithmetic on counts.
    Unknown sensor types and NULL readings count as not healthy.
    """
    c = cfg.cols
    v, s = F.col(c.value), F.col(c.sensor)
    per_sensor = [round_half_up(F.avg(F.when(s == F.lit(x.name), v)), 2).alias(f"avg_{x.name}")
                  for x in cfg.sensors]
    g = (df.groupBy(c.machine, F.to_date(c.time).alias("date"))
           .agg(F.count(F.lit(1)).alias("total_readings"),
                F.countDistinct(s).alias("active_sensors"),
                F.count_if(in_range(cfg)).alias("_healthy"),
                *per_sensor))
    avg5 = halfup_int_ratio(F.col("_healthy"), F.col("total_readings"), 100_000)
    g = g.withColumn("_avg5", avg5)
    return g.select(
        c.machine, "date", "total_readings", "active_sensors",
        (int_div(F.col("_avg5") + F.lit(50), F.lit(100)) / F.lit(10.0)).alias("health_score_pct"),
        *[f"avg_{x.name}" for x in cfg.sensors],
        health_status_from_avg5(F.col("_avg5"), cfg).alias("machine_status"),
    )
