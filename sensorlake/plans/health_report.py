"""Machine-health roll-ups over the daily health table.

Averages of the 1-decimal daily scores follow DECIMAL semantics (average
rounded half-up to 5 places, then to 1) with integer arithmetic on the
score in tenths, so the result is exact in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.rounding import halfup_int_ratio, int_div, round_half_up
from ..functions.status import health_status_from_score, severity, status_of_severity


def _tenths(score: Column) -> Column:
    return F.round(score * F.lit(10.0)).cast("long")


def avg_score_1dp(score: Column) -> Column:
    """``round(avg(score), 1)`` for a 1-decimal score, exactly."""
    a5 = halfup_int_ratio(F.sum(_tenths(score)), F.count(score), 10_000)
    return int_div(a5 + F.lit(5000), F.lit(10_000)) / F.lit(10.0)


def machine_health_avg(daily: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Mean score per machine and the worst daily status by severity
    (CRITICAL > WARNING > NORMAL), not by alphabet."""
    m = cfg.cols.machine
    return daily.groupBy(m).agg(
        avg_score_1dp(F.col("health_score_pct")).alias("avg_health_score"),
        status_of_severity(F.max(severity(F.col("machine_status")))).alias("worst_status"))


def machine_health_overall(daily: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Mean, worst and best daily score per machine; status from the worst
    rounded score (< 80 CRITICAL, < 95 WARNING), the worst daily status by
    severity, and total readings."""
    m, s = cfg.cols.machine, F.col("health_score_pct")
    g = daily.groupBy(m).agg(
        avg_score_1dp(s).alias("avg_health_score"),
        F.min(s).alias("worst_day_score"), F.max(s).alias("best_day_score"),
        status_of_severity(F.max(severity(F.col("machine_status")))).alias("worst_daily_status"),
        F.sum("total_readings").cast("long").alias("total_readings"))
    return g.select(m, "avg_health_score", "worst_day_score", "best_day_score",
                    health_status_from_score(F.col("worst_day_score"), cfg).alias("overall_status"),
                    "worst_daily_status", "total_readings")


def worst_machine(daily: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    m = cfg.cols.machine
    return (daily.groupBy(m).agg(avg_score_1dp(F.col("health_score_pct")).alias("avg_score"))
                 .orderBy(F.col("avg_score").asc(), F.col(m)).limit(1))


def daily_health_listing(daily: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return daily.orderBy("date", cfg.cols.machine).select("date", cfg.cols.machine, "health_score_pct", "machine_status", "total_readings",
                        round_half_up(F.col("avg_temperature"), 2).alias("avg_temp"),
                        round_half_up(F.col("avg_pressure"), 2).alias("avg_pressure"),
                        round_half_up(F.col("avg_vibration"), 4).alias("avg_vibration"))


def daily_reading_counts(silver: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    c = cfg.cols
    return silver.groupBy(F.to_date(c.time).alias("date"), c.machine).agg(
        F.count(F.lit(1)).alias("readings"),
        F.countDistinct(c.sensor).alias("sensor_types_active"))


def sensor_profile(silver: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    c = cfg.cols
    v = F.col(c.value)
    return silver.groupBy(c.machine, c.sensor).agg(
        F.count(F.lit(1)).alias("readings"), round_half_up(F.avg(v), 3).alias("mean"),
        round_half_up(F.stddev_samp(v), 3).alias("stddev"),
        round_half_up(F.min(v), 3).alias("min_val"), round_half_up(F.max(v), 3).alias("max_val"))
