"""Summaries and top-k reports over scored readings and the anomaly table.

Top-k reports order by the rounded z-score as displayed, then the exact
z-score, then event id, so ties are broken the same way every run.
``TakeOrderedAndProject`` keeps only k rows per task before the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.rounding import round_half_up


def anomaly_summary(scored: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Per series: readings, anomalies, rate in % (2 dp), largest anomalous z."""
    c = cfg.cols
    a = F.col("is_anomaly")
    g = scored.groupBy(c.machine, c.sensor).agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.count_if(a).alias("anomaly_count"),
        round_half_up(F.max(F.when(a, F.col("z_score"))), 2).alias("max_z_score"))
    rate = round_half_up(F.col("anomaly_count") / F.col("total_readings") * F.lit(100.0), 2)
    return g.select(c.machine, c.sensor, "total_readings", "anomaly_count",
                    rate.alias("anomaly_rate_pct"), "max_z_score")


def anomaly_profile(anoms: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    c = cfg.cols
    z, v = F.col("z_score"), F.col(c.value)
    return anoms.groupBy(c.machine, c.sensor).agg(
        F.count(F.lit(1)).alias("anomaly_count"),
        round_half_up(F.max(z), 2).alias("max_z_score"),
        round_half_up(F.avg(z), 2).alias("avg_z_score"),
        round_half_up(F.min(v), 4).alias("min_anomalous_value"),
        round_half_up(F.max(v), 4).alias("max_anomalous_value"))


def _z_order(cfg: PipelineConfig):
    return [round_half_up(F.col("z_score"), 2).desc(), F.col("z_score").desc(),
            F.col(cfg.cols.event_id).asc()]


def top_anomalies(anoms: DataFrame, n: int = 10, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    c = cfg.cols
    return (anoms.orderBy(*_z_order(cfg)).limit(n)
                 .select(c.machine, c.sensor, round_half_up(F.col(c.value), 4).alias("value"), c.unit,
                         round_half_up(F.col("rolling_avg"), 4).alias("rolling_avg"),
                         round_half_up(F.col("z_score"), 2).alias("z_score"), c.time))


def anomalies_per_day(anoms: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    c = cfg.cols
    return anoms.groupBy(F.to_date(c.time).alias("date"), c.machine, c.sensor).agg(
        F.count(F.lit(1)).alias("anomaly_count"),
        round_half_up(F.avg("z_score"), 2).alias("avg_z_score"))


def most_anomalous_sensor(anoms: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    s = cfg.cols.sensor
    return (anoms.groupBy(s).agg(F.count(F.lit(1)).alias("n"))
                 .orderBy(F.col("n").desc(), F.col(s)).limit(1))


def max_anomaly(anoms: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    c = cfg.cols
    return (anoms.orderBy(*_z_order(cfg)).limit(1)
                 .select(c.machine, c.sensor, round_half_up(F.col("z_score"), 2).alias("z_score")))


def anomaly_headline(scored: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Anomaly count, share of Silver in %, mean and highest z of the flagged."""
    a = F.col("is_anomaly")
    g = scored.agg(F.count(F.lit(1)).alias("silver_rows"), F.count_if(a).alias("anomaly_count"),
                   F.avg(F.when(a, F.col("z_score"))).alias("_avg"),
                   F.max(F.when(a, F.col("z_score"))).alias("_max"))
    return g.select("anomaly_count", "silver_rows",
                    round_half_up(F.try_divide(F.col("anomaly_count").cast("double"),
                                               F.col("silver_rows").cast("double")) * F.lit(100.0), 2)
                    .alias("anomaly_rate_pct"),
                    round_half_up(F.col("_avg"), 2).alias("avg_z_score"),
                    round_half_up(F.col("_max"), 2).alias("max_z_score"))
