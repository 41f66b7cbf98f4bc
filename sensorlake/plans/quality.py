"""Per-run quality report (15 checks over Bronze, Silver, Gold, lineage) and
the summaries read from its history.

All counts come from ONE job: the layers are projected to
``(tag, key, flags)``, unioned, aggregated per (tag, key) — the key is the
event id for Bronze/Silver so surplus duplicates are ``rows - groups``,
the machine for daily health, the date for hourly stats — and then summed
into one row. Partial aggregation keeps hot keys (a third of the rows under
one id) to one row per map task. Statuses are CASE columns; the one-row
result is unpivoted into metric rows with ``inline``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.predicates import out_of_range
from ..functions.rounding import pct, round_half_up
from ..functions.status import (anomaly_rate_status, eq_status, max_status, min_status,
                                retention_status)
from .explore import tagged

REPORT_COLUMNS = ["run_id", "layer", "table_name", "check_name", "metric_value", "threshold",
                  "status", "checked_at"]


def layer_counts(bronze: DataFrame | None = None, silver: DataFrame | None = None,
                 hourly: DataFrame | None = None, daily: DataFrame | None = None,
                 anomalies: DataFrame | None = None, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row with the counts of the given layers (0 for a layer that is not given)."""
    c = cfg.cols
    no, null_key = F.lit(False), F.lit(None).cast("string")
    score = F.col("health_score_pct")
    frames = {
        "b": lambda: bronze.select(F.col(c.event_id).alias("k"), F.col(c.value).isNull().alias("nul"),
                           no.alias("rv"), no.alias("inv"), F.col(c.value).isNotNull().alias("oor_ok"),
                           F.coalesce(out_of_range(cfg), F.lit(False)).alias("oor")),
        "s": lambda: silver.select(F.col(c.event_id).alias("k"), F.col(c.value).isNull().alias("nul"),
                           F.coalesce(out_of_range(cfg), F.lit(False)).alias("rv"), no.alias("inv"),
                           no.alias("oor_ok"), no.alias("oor")),
        "d": lambda: daily.select(F.col(c.machine).alias("k"), no.alias("nul"), no.alias("rv"),
                          F.coalesce((score < 0) | (score > 100), F.lit(False)).alias("inv"),
                          no.alias("oor_ok"), no.alias("oor")),
        "h": lambda: hourly.select(F.col("date").cast("string").alias("k"), no.alias("nul"), no.alias("rv"),
                           no.alias("inv"), no.alias("oor_ok"), no.alias("oor")),
        "a": lambda: anomalies.select(null_key.alias("k"), no.alias("nul"), no.alias("rv"), no.alias("inv"),
                              no.alias("oor_ok"), no.alias("oor")),
    }
    given = {"b": bronze, "s": silver, "d": daily, "h": hourly, "a": anomalies}
    u = tagged({t: f() for t, f in frames.items() if given[t] is not None}, "k", "nul", "rv", "inv", "oor_ok", "oor")
    per_key = u.groupBy("_t", "k").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("nul").alias("nul"), F.count_if("rv").alias("rv"),
        F.count_if("inv").alias("inv"), F.count_if(F.col("oor") & F.col("oor_ok")).alias("oor"))

    def tot(tag: str, col: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_t") == tag, F.col(col))), F.lit(0)).cast("long")

    def groups(tag: str, non_null: bool = False) -> Column:
        cond = F.col("_t") == tag
        if non_null:
            cond = cond & F.col("k").isNotNull()
        return F.count_if(cond)

    return per_key.agg(
        tot("b", "n").alias("bronze_rows"), tot("b", "nul").alias("bronze_nulls"),
        (tot("b", "n") - groups("b")).alias("bronze_surplus"), tot("b", "oor").alias("bronze_out_of_range"),
        tot("s", "n").alias("silver_rows"), tot("s", "nul").alias("silver_nulls"),
        (tot("s", "n") - groups("s")).alias("silver_surplus"), tot("s", "rv").alias("silver_range_violations"),
        groups("d", True).alias("gold_machines"), tot("d", "inv").alias("gold_invalid_scores"),
        tot("d", "n").alias("daily_rows"),
        groups("h", True).alias("gold_days"), tot("h", "n").alias("hourly_rows"),
        tot("a", "n").alias("anomaly_rows"))


def _check(i, layer, table, name, metric, threshold, status) -> Column:
    return F.struct(F.lit(i).alias("check_index"), F.lit(layer).alias("layer"),
                    F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
                    metric.cast("double").alias("metric_value"),
                    (F.lit(None) if threshold is None else F.lit(threshold)).cast("double").alias("threshold"),
                    status.alias("status"))


#: The layers that the checks of each part of the report read.
CHECKED = {"bronze": ("bronze",), "silver": ("bronze", "silver"),
           "gold": ("silver", "hourly", "daily", "anomalies"), "lineage": ("bronze", "silver", "anomalies")}


def quality_report(bronze: DataFrame, silver: DataFrame, hourly: DataFrame, daily: DataFrame,
                   anomalies: DataFrame, run_id: str, checked_at: str,
                   cfg: PipelineConfig = DEFAULT, step_seconds: int = 0) -> DataFrame:
    """Metric rows of one run over all layers."""
    counts = layer_counts(bronze, silver, hourly, daily, anomalies, cfg)
    return report_rows(counts, run_id, checked_at, cfg, step_seconds)


def layer_report(layer: str, frames: dict[str, DataFrame], run_id: str, checked_at: str,
                 cfg: PipelineConfig = DEFAULT, step_seconds: int = 0) -> DataFrame:
    """The checks of one layer; ``frames`` needs the layers in ``CHECKED[layer]`` only."""
    counts = layer_counts(**{k: frames[k] for k in CHECKED[layer]}, cfg=cfg)
    return report_rows(counts, run_id, checked_at, cfg, step_seconds, layer)


def report_rows(k: DataFrame, run_id: str, checked_at: str, cfg: PipelineConfig = DEFAULT,
                step_seconds: int = 0, only: str | None = None) -> DataFrame:
    """Metric rows from ``layer_counts``: (run_id, layer, table_name, check_name,
    metric_value, threshold, status, checked_at).

    ``checked_at`` is a wall-clock string; row i is stamped
    ``checked_at + i * step_seconds`` (the source stamps every row separately).
    """
    t, n = cfg.thresholds, cfg.tables
    col = F.col
    null_pct = pct(col("bronze_nulls"), col("bronze_rows"), 2)
    dup_pct = pct(col("bronze_surplus"), col("bronze_rows"), 2)
    retention = pct(col("silver_rows"), col("bronze_rows"), 2)
    anomaly_rate = pct(col("anomaly_rows"), col("silver_rows"), 2)
    removed = col("bronze_rows") - col("silver_rows")
    # Layer and check names of the source quality report, in its order.
    checks = [
        ("bronze", n.bronze, "row_count", col("bronze_rows"), t.bronze_min_rows,
         min_status(col("bronze_rows"), F.lit(t.bronze_min_rows))),
        ("bronze", n.bronze, "null_rate_pct", null_pct, t.bronze_max_null_pct,
         max_status(null_pct, F.lit(t.bronze_max_null_pct))),
        ("bronze", n.bronze, "duplicate_rate_pct", dup_pct, t.bronze_max_dup_pct,
         max_status(dup_pct, F.lit(t.bronze_max_dup_pct))),
    ]
    if t.with_bronze_range_check:
        oor_pct = pct(col("bronze_out_of_range"), col("bronze_rows"), 2)
        checks.append(("bronze", n.bronze, "out_of_range_pct", oor_pct, t.bronze_max_out_of_range_pct,
                       max_status(oor_pct, F.lit(t.bronze_max_out_of_range_pct))))
    checks += [
        ("silver", n.silver, "row_count", col("silver_rows"), None, F.lit("PASS")),
        ("silver", n.silver, "null_count", col("silver_nulls"), 0, eq_status(col("silver_nulls"), F.lit(0))),
        ("silver", n.silver, "duplicate_count", col("silver_surplus"), 0,
         eq_status(col("silver_surplus"), F.lit(0))),
        ("silver", n.silver, "range_violations", col("silver_range_violations"), 0,
         eq_status(col("silver_range_violations"), F.lit(0))),
        ("silver", n.silver, "retention_pct", retention, t.retention_pass_pct, retention_status(retention, cfg)),
        ("gold", n.daily, "distinct_machines", col("gold_machines"), t.expected_machines,
         eq_status(col("gold_machines"), F.lit(t.expected_machines))),
        ("gold", n.daily, "invalid_scores", col("gold_invalid_scores"), 0,
         eq_status(col("gold_invalid_scores"), F.lit(0))),
        ("gold", n.anomalies, "anomaly_rate_pct", anomaly_rate, t.anomaly_high_pct,
         anomaly_rate_status(anomaly_rate, cfg)),
        ("gold", n.hourly, "days_covered", col("gold_days"), t.expected_days,
         eq_status(col("gold_days"), F.lit(t.expected_days), miss="WARN")),
        ("lineage", n.lineage, "bronze_to_silver_retention_pct", retention, t.retention_pass_pct,
         retention_status(retention, cfg)),
        ("lineage", n.lineage, "rows_removed_cleaning", removed, None, F.lit("PASS")),
        ("lineage", n.lineage, "anomaly_rate_pct", anomaly_rate, t.anomaly_high_pct,
         anomaly_rate_status(anomaly_rate, cfg)),
    ]
    rows = F.array(*[_check(i + 1, *ch) for i, ch in enumerate(checks) if only in (None, ch[0])])
    base_ts = F.lit(checked_at).cast("timestamp_ntz")
    out = k.select(F.inline(rows))
    stamp = base_ts + F.make_dt_interval(secs=((F.col("check_index") - 1) * step_seconds).cast("decimal(18,6)"))
    return out.select(F.lit(run_id).alias("run_id"), "layer", "table_name", "check_name",
                      "metric_value", "threshold", "status", stamp.alias("checked_at"))


# ---- summaries over the report history --------------------------------------

def _counts_by_status() -> list[Column]:
    s = F.col("status")
    return [F.count(F.lit(1)).alias("total_checks"), F.count_if(s == "PASS").alias("passed"),
            F.count_if(s == "WARN").alias("warned"), F.count_if(s == "FAIL").alias("failed")]


def latest_run(history: DataFrame) -> DataFrame:
    """Rows of the most recent run (``run_id`` sorts by time), in one job via
    a scalar subquery rather than a collect followed by a second query."""
    return history.filter(F.col("run_id") == history.agg(F.max("run_id")).scalar())


def quality_by_layer(history: DataFrame) -> DataFrame:
    """PASS/WARN/FAIL counts per layer (0, never NULL, when none)."""
    return latest_run(history).groupBy("layer").agg(*_counts_by_status())


def quality_detail(history: DataFrame) -> DataFrame:
    return (latest_run(history).orderBy("layer", "check_name")
            .select("layer", "check_name", round_half_up(F.col("metric_value"), 2).alias("metric_value"),
                    "threshold", "status"))


def check_failures(history: DataFrame) -> DataFrame:
    return (latest_run(history).filter(F.col("status").isin("FAIL", "WARN"))
            .select("layer", "check_name", "metric_value", "threshold", "status"))


def check_failure_count(history: DataFrame) -> DataFrame:
    return latest_run(history).agg(F.count_if(F.col("status").isin("FAIL", "WARN")).alias("failures"))


def quality_trend(history: DataFrame) -> DataFrame:
    """One row per run. Grouped by run id (rows of a run carry different
    check times), showing the run's last check time."""
    return (history.groupBy("run_id").agg(F.max("checked_at").alias("checked_at"), *_counts_by_status())
            .orderBy("checked_at", "run_id"))


def _pass_rate(passed: Column, total: Column) -> Column:
    return round_half_up(F.try_divide(passed.cast("double"), total.cast("double")) * F.lit(100.0), 0)


def quality_scorecard(history: DataFrame) -> DataFrame:
    g = latest_run(history).groupBy("layer").agg(*_counts_by_status())
    rate = _pass_rate(F.col("passed"), F.col("total_checks"))
    return g.select("layer", "total_checks", "passed", "warned", "failed",
                    F.concat(rate.cast("string"), F.lit("%")).alias("pass_rate"),
                    rate.alias("pass_rate_pct"))


def quality_pass_rate(history: DataFrame) -> DataFrame:
    s = F.col("status")
    return latest_run(history).agg(_pass_rate(F.count_if(s == "PASS"), F.count(F.lit(1))).alias("pass_rate"))
