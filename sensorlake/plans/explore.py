"""Exploration profiles of a sensor table (any layer).

All are single aggregates; multi-table figures (Bronze vs Silver) come from
one aggregate over a tagged union instead of joining one-row results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.predicates import out_of_range
from ..functions.rounding import pct, round_half_up
from ..operators.dedup import surplus_expr


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def time_coverage(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    c = cfg.cols
    return df.agg(F.min(c.time).alias("earliest_reading"),
                  F.max(c.time).alias("latest_reading"),
                  F.countDistinct(F.to_date(c.time)).alias("distinct_days"),
                  F.min(c.ingested).alias("first_ingested"),
                  F.max(c.ingested).alias("last_ingested"))


def value_describe(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Typed five-number summary (``describe`` returns strings)."""
    v = F.col(cfg.cols.value)
    return df.agg(F.count(v).alias("count"), round_half_up(F.avg(v), 4).alias("mean"),
                  round_half_up(F.stddev_samp(v), 4).alias("stddev"),
                  F.min(v).alias("min"), F.max(v).alias("max"))


def value_stats_by_sensor(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    v = F.col(cfg.cols.value)
    return df.groupBy(cfg.cols.sensor).agg(
        F.count(v).alias("count_non_null"), round_half_up(F.avg(v), 4).alias("mean"),
        round_half_up(F.stddev_samp(v), 4).alias("stddev"),
        round_half_up(F.min(v), 4).alias("min"), round_half_up(F.max(v), 4).alias("max"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: NULL count, share of rows (1 decimal), OK/PROBLEM.
    One scan for all columns, then the single result row is unpivoted."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(x).isNull()).alias(f"_c{i}") for i, x in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(x).alias("column_name"),
                              F.col(f"_c{i}").alias("null_count")) for i, x in enumerate(cols)])
    out = agg.select("_n", F.inline(rows))
    return out.select("position", "column_name", "null_count",
                      pct(F.col("null_count"), F.col("_n"), 1).alias("null_pct"),
                      F.when(F.col("null_count") > 0, F.lit("PROBLEM")).otherwise(F.lit("OK")).alias("status"))


def out_of_range_rows(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Rows whose value is outside its sensor's range (NULL values excluded)."""
    return df.filter(out_of_range(cfg))


def out_of_range_rate(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    bad = F.count_if(F.coalesce(out_of_range(cfg), F.lit(False)) & F.col(cfg.cols.value).isNotNull())
    return (df.agg(F.count(F.lit(1)).alias("total_rows"), bad.alias("out_of_range_count"))
              .withColumn("out_of_range_pct", pct(F.col("out_of_range_count"), F.col("total_rows"), 2)))


def out_of_range_by_sensor(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    v = F.col(cfg.cols.value)
    return (out_of_range_rows(df, cfg).groupBy(cfg.cols.sensor)
              .agg(F.count(F.lit(1)).alias("out_of_range_count"),
                   round_half_up(F.min(v), 2).alias("min_bad_value"),
                   round_half_up(F.max(v), 2).alias("max_bad_value")))


def tagged(frames: dict[str, DataFrame], *cols: Column | str) -> DataFrame:
    """Union of several frames projected to the same columns plus a ``_t`` tag."""
    out = None
    for tag, df in frames.items():
        part = df.select(F.lit(tag).alias("_t"), *cols)
        out = part if out is None else out.unionByName(part)
    return out


def _on(tag: str, col) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.when(F.col("_t") == F.lit(tag), col)


def bronze_quality_summary(bronze: DataFrame, silver: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Raw-layer summary: nulls, surplus duplicates, out-of-range readings,
    the naive expected clean count (total minus the three, overlaps counted
    twice) and the exact clean count."""
    c = cfg.cols
    u = tagged({"b": bronze, "s": silver}, F.col(c.event_id).alias("id"),
               F.col(c.value).isNull().alias("is_null"),
               (F.coalesce(out_of_range(cfg), F.lit(False)) & F.col(c.value).isNotNull()).alias("oor"))
    b = F.col("_t") == "b"
    g = u.agg(
        F.count_if(b).alias("total_rows"),
        F.count_if(b & F.col("is_null")).alias("null_values"),
        F.coalesce((F.count_if(b) - F.countDistinct(_on("b", "id"))
                    - F.max(F.when(b & F.col("id").isNull(), 1).otherwise(0))).cast("long"), F.lit(0))
        .alias("duplicate_rows"),
        F.count_if(b & F.col("oor")).alias("out_of_range"),
        F.count_if(F.col("_t") == "s").alias("clean_rows"))
    t = F.col("total_rows")
    return g.select(
        "total_rows", "null_values", pct(F.col("null_values"), t, 1).alias("null_pct"),
        "duplicate_rows", pct(F.col("duplicate_rows"), t, 1).alias("duplicate_pct"),
        "out_of_range", pct(F.col("out_of_range"), t, 1).alias("out_of_range_pct"),
        (t - F.col("null_values") - F.col("duplicate_rows") - F.col("out_of_range")).alias("expected_clean_rows_naive"),
        "clean_rows")


def layer_retention(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    u = tagged({"b": bronze, "s": silver})
    g = u.agg(F.count_if(F.col("_t") == "b").alias("bronze_rows"),
              F.count_if(F.col("_t") == "s").alias("silver_rows"))
    removed = F.col("bronze_rows") - F.col("silver_rows")
    return g.select("bronze_rows", "silver_rows", removed.alias("rows_removed"),
                    pct(removed, F.col("bronze_rows"), 1).alias("removed_pct"),
                    pct(F.col("silver_rows"), F.col("bronze_rows"), 1).alias("retained_pct"))


def silver_stats_by_sensor(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    v = F.col(cfg.cols.value)
    return df.groupBy(cfg.cols.sensor).agg(
        F.count(F.lit(1)).alias("row_count"), round_half_up(F.min(v), 4).alias("min_value"),
        round_half_up(F.max(v), 4).alias("max_value"), round_half_up(F.avg(v), 4).alias("mean_value"))


def range_violation_count(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return df.agg(F.count_if(F.coalesce(out_of_range(cfg), F.lit(False))).alias("n"))


__all__ = ["count_by", "time_coverage", "value_describe", "value_stats_by_sensor", "null_counts",
           "out_of_range_rows", "out_of_range_rate", "out_of_range_by_sensor", "tagged",
           "bronze_quality_summary", "layer_retention", "silver_stats_by_sensor",
           "range_violation_count", "surplus_expr"]
