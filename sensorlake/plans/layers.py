"""Bronze -> Silver -> Gold as plain functions of DataFrames.

Each function returns an unexecuted DataFrame; composition is function
application. Wall-clock audit columns are optional so that compared outputs
stay deterministic.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, FIXTURE, PipelineConfig
from ..functions.predicates import drop_rules
from ..operators.aggregates import daily_health, hourly_stats
from ..operators.dedup import dedup, preferred
from ..operators.expectations import expect_all_or_drop, expectation_metrics
from ..operators.rolling import anomalies, flag_anomalies, rolling_zscore, tasks_for
from ..sources.fixture import bronze_from_events
from ..sources.tables import load

BRONZE_AUDIT = ("_ingested_at", "_source")


def bronze_ingest(src: DataFrame, cfg: PipelineConfig = DEFAULT, audit_time: bool = True) -> DataFrame:
    """Raw rows plus lineage: processing time and source name. No filtering."""
    out = src
    if audit_time:
        out = out.withColumn("_ingested_at", F.current_timestamp())
    return out.withColumn("_source", F.lit(cfg.source_name))


def deduplicated(bronze: DataFrame, cfg: PipelineConfig = DEFAULT, order: str | None = None) -> DataFrame:
    return dedup(bronze.drop(*BRONZE_AUDIT), cfg, order)


def silver_clean(bronze: DataFrame, cfg: PipelineConfig = DEFAULT, order: str | None = None,
                 audit_time: bool = False) -> DataFrame:
    """Dedup, then keep rows passing all five rules (NULL = failure)."""
    out = expect_all_or_drop(deduplicated(bronze, cfg, order), drop_rules(cfg))
    if audit_time:
        out = out.withColumn("_silver_processed_at", F.current_timestamp())
    return out


def silver_rule_metrics(bronze: DataFrame, cfg: PipelineConfig = DEFAULT, order: str | None = None) -> DataFrame:
    return expectation_metrics(deduplicated(bronze, cfg, order), drop_rules(cfg),
                               cfg.tables.silver, action="drop")


def gold_hourly(silver: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return hourly_stats(silver, cfg)


def gold_daily(silver: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return daily_health(silver, cfg)


def scored(silver: DataFrame, cfg: PipelineConfig = DEFAULT, strategy: str = "bucketed", tasks: int | None = None) -> DataFrame:
    return flag_anomalies(rolling_zscore(silver, cfg, strategy, tasks), cfg)


def gold_anomalies(silver: DataFrame, cfg: PipelineConfig = DEFAULT, strategy: str = "bucketed",
                   tasks: int | None = None) -> DataFrame:
    return anomalies(rolling_zscore(silver, cfg, strategy, tasks), cfg)


@dataclass
class Layers:
    """Lazily built layers over one input; each property is a DataFrame."""

    bronze: DataFrame
    cfg: PipelineConfig = FIXTURE
    order: str | None = None
    strategy: str = "bucketed"
    #: Stores a table of a name and gives it back read from storage; without it every table is computed where it is read.
    keep: Callable[[str, DataFrame], DataFrame] | None = None
    #: Bronze folded by id (``fold_ids``), if it is stored: one fold for every order of preference.
    folds: DataFrame | None = None

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, cfg: PipelineConfig = FIXTURE,
                      order: str | None = None, strategy: str = "bucketed",
                      keep: Callable[[str, DataFrame], DataFrame] | None = None) -> "Layers":
        return cls(bronze_from_events(load(spark, sf_dir, "events"), cfg), cfg, order, strategy, keep)

    def _kept(self, name: str, df: DataFrame) -> DataFrame:
        return df if self.keep is None else self.keep(name, df)

    @property
    def deduped(self) -> DataFrame:
        if self.folds is not None:
            return preferred(self.folds, self.order or self.cfg.dedup_order)
        return deduplicated(self.bronze, self.cfg, self.order)

    @cached_property
    def silver(self) -> DataFrame:
        return self._kept("silver", expect_all_or_drop(self.deduped, drop_rules(self.cfg)))

    @cached_property
    def hourly(self) -> DataFrame:
        return self._kept("hourly", gold_hourly(self.silver, self.cfg))

    @cached_property
    def daily(self) -> DataFrame:
        return self._kept("daily", gold_daily(self.silver, self.cfg))

    @cached_property
    def rolled(self) -> DataFrame:
        """Silver plus rolling statistics."""
        return self._kept("rolled", rolling_zscore(self.silver, self.cfg, self.strategy, self.tasks))

    @cached_property
    def tasks(self) -> int | None:
        """Tasks that share the rolling windows: a stored Silver is counted from its footers."""
        return None if self.keep is None else tasks_for(self.silver, self.cfg)

    @property
    def scored(self) -> DataFrame:
        return flag_anomalies(self.rolled, self.cfg)

    @property
    def anomalies(self) -> DataFrame:
        return anomalies(self.rolled, self.cfg)
