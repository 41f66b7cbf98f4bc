"""Deterministic Bronze sensor readings derived from the supplied ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` is clean, so the
readings, NULLs and duplicate copies the pipeline must handle are made by rule
(no randomness). One scan of ``events``; the duplicate copies come from a
per-row ``explode`` instead of re-reading the table for each copy set.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig

# Event type -> sensor type, and the linear maps from the
# event value v (as DECIMAL(12,2)) to a reading: (offset, factor).
EVENT_SENSOR = {
    "click": "temperature",
    "signup": "temperature",
    "view": "pressure",
    "error": "pressure",
    "purchase": "vibration",
}
READING_MAP = {
    "temperature": ("60", "0.4"),
    "pressure": ("1", "0.06"),
    "vibration": ("0.01", "0.01"),
}
MACHINES = 5            # MACHINE_01 .. MACHINE_05 from user_id % 5
NULL_EVERY = 37         # value is NULL when event_id % 37 = 0
EARLY_EMPTY_COPY = 7    # event_id % 100 = 7: extra copy, NULL value, 90 s earlier
LATE_COPY = 57          # event_id % 100 = 57: extra identical copy, 90 s later
COPY_SHIFT_SECONDS = 90
INGEST_DELAY_MINUTES = 5


def _sensor_of(event_type: Column) -> Column:
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for et, st in EVENT_SENSOR.items():
        expr = expr.when(event_type == F.lit(et), F.lit(st))
    return expr


def _reading(sensor: Column, v: Column) -> Column:
    expr = F.when(F.lit(False), F.lit(None).cast("double"))
    for st, (off, fac) in READING_MAP.items():
        dec = F.lit(Decimal(off)) + v * F.lit(Decimal(fac))
        expr = expr.when(sensor == F.lit(st), dec.cast("double"))
    return expr


def bronze_from_events(events: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Bronze readings with schema (event_id, machine_id, sensor_type, value,
    unit, timestamp, ingested_at), including NULL readings and duplicates."""
    c = cfg.cols
    k = F.col("event_id")
    sensor = _sensor_of(F.col("event_type"))
    value = F.when(k % NULL_EVERY == 0, F.lit(None).cast("double")).otherwise(
        _reading(sensor, F.col("value").cast("decimal(12,2)")))
    unit = F.when(F.lit(False), F.lit(None).cast("string"))
    for s in cfg.sensors:
        unit = unit.when(sensor == F.lit(s.name), F.lit(s.unit))

    # copy 0 = original, 1 = early empty copy, 2 = late identical copy
    copies = F.array_compact(F.array(
        F.lit(0),
        F.when(k % 100 == EARLY_EMPTY_COPY, F.lit(1)),
        F.when(k % 100 == LATE_COPY, F.lit(2)),
    ))
    base = events.select(
        k.alias("_k"), F.col("ts").alias("_ts"), F.col("user_id"),
        sensor.alias("_sensor"), value.alias("_value"), unit.alias("_unit"),
        F.explode(copies).alias("_copy"),
    )
    shift = F.make_dt_interval(secs=F.when(F.col("_copy") == 1, -COPY_SHIFT_SECONDS)
                               .when(F.col("_copy") == 2, COPY_SHIFT_SECONDS)
                               .otherwise(0).cast("decimal(10,0)"))
    ts = F.col("_ts") + shift
    return base.select(
        F.concat(F.lit("EVT-"), F.col("_k").cast("string")).alias(c.event_id),
        F.concat(F.lit("MACHINE_0"), (F.col("user_id") % MACHINES + 1).cast("string")).alias(c.machine),
        F.col("_sensor").alias(c.sensor),
        F.when(F.col("_copy") == 1, F.lit(None).cast("double")).otherwise(F.col("_value")).alias(c.value),
        F.col("_unit").alias(c.unit),
        ts.alias(c.time),
        (ts + F.make_dt_interval(mins=F.lit(INGEST_DELAY_MINUTES))).alias(c.ingested),
    )
