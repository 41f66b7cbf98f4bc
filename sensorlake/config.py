"""One configuration for ranges, thresholds and column names.

Every predicate, status band and window in the library is generated from a
``PipelineConfig``; nothing restates the constants as SQL literals.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class SensorSpec:
    """Valid closed interval ``[low, high]`` and unit of one sensor type."""

    name: str
    low: float
    high: float
    unit: str


# Valid sensor ranges and units of the source pipeline
# (both ends inclusive).
DEFAULT_SENSORS: tuple[SensorSpec, ...] = (
    SensorSpec("temperature", 60.0, 120.0, "celsius"),
    SensorSpec("pressure", 1.0, 10.0, "bar"),
    SensorSpec("vibration", 0.01, 2.0, "mm/s"),
)


@dataclass(frozen=True)
class Columns:
    """Column names of a keyed sensor series, so any such table can be used."""

    event_id: str = "event_id"
    machine: str = "machine_id"
    sensor: str = "sensor_type"
    value: str = "value"
    unit: str = "unit"
    time: str = "timestamp"
    ingested: str = "ingested_at"

    @property
    def series_keys(self) -> tuple[str, str]:
        return (self.machine, self.sensor)


@dataclass(frozen=True)
class Thresholds:
    """Quality-report thresholds (the code's values, not the prose's)."""

    # Thresholds of the source quality report.
    bronze_min_rows: int = 9000
    bronze_max_null_pct: float = 5.0
    bronze_max_dup_pct: float = 3.0
    retention_pass_pct: float = 85.0
    retention_warn_pct: float = 70.0
    anomaly_low_pct: float = 1.0
    anomaly_high_pct: float = 20.0
    expected_machines: int = 5
    expected_days: int = 7
    # Optional extra bronze check described in prose only (off by default).
    bronze_max_out_of_range_pct: float = 10.0
    with_bronze_range_check: bool = False


@dataclass(frozen=True)
class HealthBands:
    """Daily health status bands on the percentage of in-range readings."""

    # NORMAL at >= 95 %, WARNING at >= 80 %, else CRITICAL.
    normal_pct: int = 95
    warning_pct: int = 80


@dataclass(frozen=True)
class AnomalyConfig:
    """Rolling z-score: frame of ``preceding`` rows plus the current row."""

    preceding: int = 50
    threshold: float = 2.0
    # Rows per bucket of a series (raised to more than ``preceding`` if smaller).
    bucket_rows: int = 100_000
    # Rows of buckets that a task gets, on average, of a table whose size is known.
    task_rows: int = 500_000
    # Seconds of a series that are counted together to find the buckets.
    cell_seconds: int = 60


@dataclass(frozen=True)
class TableNames:
    bronze: str = "bronze_sensors"
    silver: str = "silver_sensors"
    hourly: str = "gold_hourly_stats"
    daily: str = "gold_daily_health"
    anomalies: str = "gold_anomalies"
    quality: str = "quality_report"
    lineage: str = "cross_layer"


@dataclass(frozen=True)
class PipelineConfig:
    sensors: tuple[SensorSpec, ...] = DEFAULT_SENSORS
    cols: Columns = field(default_factory=Columns)
    thresholds: Thresholds = field(default_factory=Thresholds)
    health: HealthBands = field(default_factory=HealthBands)
    anomaly: AnomalyConfig = field(default_factory=AnomalyConfig)
    tables: TableNames = field(default_factory=TableNames)
    source_name: str = "sensors.bronze_sensors"
    # Which copy of a duplicated event survives: "prefer_value" keeps the
    # earliest copy that carries a reading, "first_arrival" the earliest copy.
    dedup_order: str = "prefer_value"

    def sensor(self, name: str) -> SensorSpec:
        for s in self.sensors:
            if s.name == name:
                return s
        raise KeyError(name)

    def with_thresholds(self, **kw) -> "PipelineConfig":
        return replace(self, thresholds=replace(self.thresholds, **kw))

    def with_anomaly(self, **kw) -> "PipelineConfig":
        return replace(self, anomaly=replace(self.anomaly, **kw))


DEFAULT = PipelineConfig()

# The supplied test tables span 30 days (2024-01-01 .. 2024-01-30).
FIXTURE = DEFAULT.with_thresholds(expected_days=30)
