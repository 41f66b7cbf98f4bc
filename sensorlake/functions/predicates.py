"""Predicates generated from the one range configuration.

Three-valued logic is deliberate: a rule that evaluates to NULL (NULL value,
NULL id) is a failure, so callers wrap rules in ``coalesce(rule, false)``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PipelineConfig


def sensor_out_of_range(cfg: PipelineConfig, name: str) -> Column:
    """``sensor = name AND (value < low OR value > high)`` (NULL for NULL value)."""
    s, c = cfg.sensor(name), cfg.cols
    v = F.col(c.value)
    return (F.col(c.sensor) == F.lit(s.name)) & ((v < F.lit(s.low)) | (v > F.lit(s.high)))


def out_of_range(cfg: PipelineConfig) -> Column:
    """OR over all configured sensor types of their out-of-range test."""
    return reduce(or_, [sensor_out_of_range(cfg, s.name) for s in cfg.sensors])


def in_range(cfg: PipelineConfig) -> Column:
    """True when the reading lies in its sensor's closed range; unknown
    sensor types and NULL values are never in range (result is never NULL)."""
    c = cfg.cols
    v = F.col(c.value)
    conds = [(F.col(c.sensor) == F.lit(s.name)) & v.between(F.lit(s.low), F.lit(s.high))
             for s in cfg.sensors]
    return F.coalesce(reduce(or_, conds), F.lit(False))


# Names of the Silver rules.
def drop_rules(cfg: PipelineConfig) -> list[tuple[str, Column]]:
    """The five Silver rules, in order: value present, one range rule per
    sensor type, event id present."""
    c = cfg.cols
    rules = [("value is not null", F.col(c.value).isNotNull())]
    rules += [(f"valid {s.name} range", ~sensor_out_of_range(cfg, s.name)) for s in cfg.sensors]
    rules.append(("event_id not null", F.col(c.event_id).isNotNull()))
    return rules


# Names of the Gold warn rules (hourly, daily, anomalies).
def hourly_rules() -> list[tuple[str, Column]]:
    return [("reading_count is positive", F.col("reading_count") > 0),
            ("avg_value is not null", F.col("avg_value").isNotNull())]


def daily_rules(cfg: PipelineConfig) -> list[tuple[str, Column]]:
    return [("health_score is valid", F.col("health_score_pct").between(0, 100)),
            ("machine_id is not null", F.col(cfg.cols.machine).isNotNull())]


def anomaly_rules(cfg: PipelineConfig) -> list[tuple[str, Column]]:
    t = cfg.anomaly.threshold
    return [("z_score is positive", F.col("z_score") > 0),
            ("z_score exceeds threshold", F.col("z_score") > F.lit(t))]
