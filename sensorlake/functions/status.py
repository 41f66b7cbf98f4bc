"""Status bands as CASE columns (no driver-side Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PipelineConfig

# Health statuses ordered by severity.
SEVERITY = {"NORMAL": 0, "WARNING": 1, "CRITICAL": 2}


def health_status_from_avg5(avg5, cfg: PipelineConfig) -> Column:
    """Status from the in-range share held as an integer ``share * 1e5``.

    ``share * 100 >= 95`` is ``avg5 >= 95000`` — exact, no float involved.
    """
    b = cfg.health
    return (F.when(avg5 >= F.lit(b.normal_pct * 1000), F.lit("NORMAL"))
             .when(avg5 >= F.lit(b.warning_pct * 1000), F.lit("WARNING"))
             .otherwise(F.lit("CRITICAL")))


def health_status_from_score(score, cfg: PipelineConfig) -> Column:
    """Status from an already rounded percentage (overall roll-up form)."""
    b = cfg.health
    return (F.when(score < F.lit(b.warning_pct), F.lit("CRITICAL"))
             .when(score < F.lit(b.normal_pct), F.lit("WARNING"))
             .otherwise(F.lit("NORMAL")))


def severity(status) -> Column:
    expr = F.when(F.lit(False), F.lit(None).cast("int"))
    for name, rank in SEVERITY.items():
        expr = expr.when(status == F.lit(name), F.lit(rank))
    return expr


def status_of_severity(rank) -> Column:
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, r in SEVERITY.items():
        expr = expr.when(rank == F.lit(r), F.lit(name))
    return expr


def min_status(metric, threshold) -> Column:
    """PASS when ``metric >= threshold``; NULL metric fails."""
    return F.when(metric >= threshold, F.lit("PASS")).otherwise(F.lit("FAIL"))


def max_status(metric, threshold) -> Column:
    return F.when(metric <= threshold, F.lit("PASS")).otherwise(F.lit("FAIL"))


def eq_status(metric, target, miss: str = "FAIL") -> Column:
    return F.when(metric == target, F.lit("PASS")).otherwise(F.lit(miss))


def retention_status(p, cfg: PipelineConfig) -> Column:
    t = cfg.thresholds
    return (F.when(p >= F.lit(t.retention_pass_pct), F.lit("PASS"))
             .when(p >= F.lit(t.retention_warn_pct), F.lit("WARN"))
             .otherwise(F.lit("FAIL")))


def anomaly_rate_status(p, cfg: PipelineConfig) -> Column:
    t = cfg.thresholds
    return (F.when(p.between(F.lit(t.anomaly_low_pct), F.lit(t.anomaly_high_pct)), F.lit("PASS"))
             .when(p < F.lit(t.anomaly_low_pct), F.lit("WARN"))
             .otherwise(F.lit("FAIL")))
