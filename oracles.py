"""DuckDB SQL oracles, written independently of the Spark code.

Every statement starts from the base tables the checker registers
(``events`` ...) and rebuilds the layers as CTEs: fixture Bronze -> dedup ->
Silver -> Gold. ``rhu`` rounds by decimals, not by the library's formula.
"""

from __future__ import annotations


def rhu(e: str, n: int) -> str:
    """Half-up rounding by way of a decimal with twelve places."""
    return f"CAST(round(CAST({e} AS DECIMAL(38, 12)), {n}) AS DOUBLE)"


def pct(num: str, den: str, n: int = 2) -> str:
    return rhu(f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100.0)", n)


# Valid range of each sensor type (inclusive) and the names of the Silver rules.
RANGES = {"temperature": (60.0, 120.0), "pressure": (1.0, 10.0), "vibration": (0.01, 2.0)}
_TABLE = "MAP {" + ", ".join(f"'{k}': [{lo}, {hi}]" for k, (lo, hi) in RANGES.items()) + "}"
_LIMITS = f"({_TABLE})[sensor_type]"
IN_RANGE = f"COALESCE(value BETWEEN {_LIMITS}[1] AND {_LIMITS}[2], FALSE)"
OUT_OF_RANGE = f"(value NOT BETWEEN {_LIMITS}[1] AND {_LIMITS}[2])"
RULES = [("value is not null", "value IS NOT NULL"),
         *[(f"valid {k} range", f"(sensor_type <> '{k}' OR value BETWEEN {lo} AND {hi})") for k, (lo, hi) in RANGES.items()],
         ("event_id not null", "event_id IS NOT NULL")]

SILVER_COLS = 'event_id, machine_id, sensor_type, value, unit, "timestamp", ingested_at'


def _dedup_cte(name: str, order: str) -> str:
    return f"""{name} AS (
  SELECT {SILVER_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {order}) AS rn FROM bronze)
  WHERE rn = 1)"""


def _silver_cte(name: str, src: str) -> str:
    conds = "\n    AND ".join(f"COALESCE({r}, FALSE)" for _, r in RULES)
    return f"""{name} AS (
  SELECT * FROM {src}
  WHERE {conds})"""


def _hourly_cte(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT machine_id, sensor_type, unit, date_trunc('hour', "timestamp") AS hour_window,
         COUNT(*) AS reading_count,
         {rhu('AVG(value)', 4)} AS avg_value,
         {rhu('MIN(value)', 4)} AS min_value,
         {rhu('MAX(value)', 4)} AS max_value,
         {rhu('STDDEV_SAMP(value)', 4)} AS stddev_value,
         CAST(date_trunc('hour', "timestamp") AS DATE) AS "date"
  FROM {src}
  GROUP BY machine_id, sensor_type, unit, date_trunc('hour', "timestamp"))"""


def _daily_cte(name: str, src: str) -> str:
    return f"""{name}_base AS (
  SELECT machine_id, CAST("timestamp" AS DATE) AS "date",
         COUNT(*) AS total_readings,
         COUNT(DISTINCT sensor_type) AS active_sensors,
         CAST(SUM(CASE WHEN {IN_RANGE} THEN 1 ELSE 0 END) AS BIGINT) AS healthy,
         {rhu("AVG(CASE WHEN sensor_type = 'temperature' THEN value END)", 2)} AS avg_temperature,
         {rhu("AVG(CASE WHEN sensor_type = 'pressure' THEN value END)", 2)} AS avg_pressure,
         {rhu("AVG(CASE WHEN sensor_type = 'vibration' THEN value END)", 2)} AS avg_vibration
  FROM {src}
  GROUP BY machine_id, CAST("timestamp" AS DATE)),
{name}_a5 AS (
  SELECT *, (healthy * 200000 + total_readings) // (2 * total_readings) AS avg5 FROM {name}_base),
{name} AS (
  SELECT machine_id, "date", total_readings, active_sensors,
         CAST((avg5 + 50) // 100 AS DOUBLE) / 10.0 AS health_score_pct,
         avg_temperature, avg_pressure, avg_vibration,
         CASE WHEN avg5 >= 95000 THEN 'NORMAL' WHEN avg5 >= 80000 THEN 'WARNING'
              ELSE 'CRITICAL' END AS machine_status
  FROM {name}_a5)"""


def _scored_cte(name: str, src: str) -> str:
    w = ('(PARTITION BY machine_id, sensor_type ORDER BY "timestamp", event_id '
         'ROWS BETWEEN 50 PRECEDING AND CURRENT ROW)')
    return f"""{name}_stats AS (
  SELECT *, {rhu(f'AVG(value) OVER {w}', 4)} AS rolling_avg,
            {rhu(f'STDDEV_SAMP(value) OVER {w}', 4)} AS rolling_stddev
  FROM {src}),
{name} AS (
  SELECT *, {rhu('abs(value - rolling_avg) / CASE WHEN rolling_stddev > 0 THEN rolling_stddev ELSE 1.0 END', 4)} AS z_score
  FROM {name}_stats)"""


FIXTURE = """ev AS (
  SELECT event_id AS k, ts, user_id, event_type, CAST(value AS DECIMAL(12,2)) AS v FROM events),
reading AS (
  SELECT k, ts, user_id, sensor_type,
         CASE WHEN k % 37 = 0 THEN NULL
              WHEN sensor_type = 'temperature' THEN CAST(60 + v * 0.4 AS DOUBLE)
              WHEN sensor_type = 'pressure' THEN CAST(1 + v * 0.06 AS DOUBLE)
              WHEN sensor_type = 'vibration' THEN CAST(0.01 + v * 0.01 AS DOUBLE) END AS value,
         CASE sensor_type WHEN 'temperature' THEN 'celsius' WHEN 'pressure' THEN 'bar'
              WHEN 'vibration' THEN 'mm/s' END AS unit
  FROM (SELECT *, CASE event_type WHEN 'click' THEN 'temperature' WHEN 'signup' THEN 'temperature'
                                  WHEN 'view' THEN 'pressure' WHEN 'error' THEN 'pressure'
                                  WHEN 'purchase' THEN 'vibration' END AS sensor_type FROM ev)),
copies AS (
  SELECT *, 0 AS copy FROM reading
  UNION ALL SELECT *, 1 AS copy FROM reading WHERE k % 100 = 7
  UNION ALL SELECT *, 2 AS copy FROM reading WHERE k % 100 = 57),
bronze AS (
  SELECT 'EVT-' || CAST(k AS VARCHAR) AS event_id,
         'MACHINE_0' || CAST(user_id % 5 + 1 AS VARCHAR) AS machine_id,
         sensor_type,
         CASE WHEN copy = 1 THEN NULL ELSE value END AS value,
         unit,
         ts + to_seconds(CASE copy WHEN 1 THEN -90 WHEN 2 THEN 90 ELSE 0 END) AS "timestamp",
         ts + to_seconds(CASE copy WHEN 1 THEN -90 WHEN 2 THEN 90 ELSE 0 END) + INTERVAL 5 MINUTE AS ingested_at
  FROM copies)"""

PREFIX = "WITH " + ",\n".join([
    FIXTURE,
    _dedup_cte("deduped", 'value IS NULL, "timestamp", ingested_at'),
    _dedup_cte("deduped_fa", 'ingested_at, "timestamp"'),
    _silver_cte("silver", "deduped"),
    _silver_cte("silver_fa", "deduped_fa"),
    _hourly_cte("hourly", "silver"),
    _daily_cte("daily", "silver"),
    _daily_cte("daily_bronze", "deduped"),
    _scored_cte("scored", "silver"),
    """anomalies AS (SELECT * FROM scored WHERE z_score > 2.0)""",
    _hourly_cte("hourly_fa", "silver_fa"),
    _daily_cte("daily_fa", "silver_fa"),
    _scored_cte("scored_fa", "silver_fa"),
    """anomalies_fa AS (SELECT * FROM scored_fa WHERE z_score > 2.0)""",
]) + "\n"


def q(body: str) -> str:
    return PREFIX + body


ORACLES: dict[str, str] = {}


def register(name: str, body: str) -> None:
    ORACLES[name] = q(body)


# ---- sources / layers ------------------------------------------------------
register("bronze_ingest", f"SELECT *, 'sensors.bronze_sensors' AS _source FROM bronze")
register("typed_records", "SELECT * FROM bronze")
register("dedup_prefer_value", "SELECT * FROM deduped")
register("dedup_first_arrival", "SELECT * FROM deduped_fa")
register("silver_clean", "SELECT * FROM silver")
register("silver_clean_first_arrival", "SELECT * FROM silver_fa")
_FAILED = "array_to_string([x FOR x IN [" + ", ".join(
    f"CASE WHEN NOT COALESCE({r}, FALSE) THEN '{n}' END" for n, r in RULES) + "] IF x IS NOT NULL], '; ')"
register("expect_drop_rows", f"SELECT * FROM (SELECT *, {_FAILED} AS failed_rules FROM deduped) WHERE failed_rules <> ''")
register("gold_hourly_stats", "SELECT * FROM hourly")
register("gold_daily_health", "SELECT * FROM daily")
register("daily_health_deduped_bronze", "SELECT * FROM daily_bronze")
register("rolling_zscore", "SELECT * FROM scored")
register("rolling_zscore_bucketed", "SELECT * FROM scored")
register("anomaly_flags", "SELECT *, z_score > 2.0 AS is_anomaly FROM scored")
register("gold_anomalies", "SELECT * FROM anomalies")

# ---- exploration -------------------------------------------------------------
register("count_by_machine", 'SELECT machine_id, COUNT(*) AS "count" FROM bronze GROUP BY machine_id')
register("count_by_sensor", 'SELECT sensor_type, COUNT(*) AS "count" FROM bronze GROUP BY sensor_type')
register("count_by_machine_sensor",
         'SELECT machine_id, sensor_type, COUNT(*) AS "count" FROM bronze GROUP BY machine_id, sensor_type')
register("time_coverage", """SELECT MIN("timestamp") AS earliest_reading, MAX("timestamp") AS latest_reading,
  COUNT(DISTINCT CAST("timestamp" AS DATE)) AS distinct_days,
  MIN(ingested_at) AS first_ingested, MAX(ingested_at) AS last_ingested FROM bronze""")
register("value_describe", f"""SELECT COUNT(value) AS "count", {rhu('AVG(value)', 4)} AS mean,
  {rhu('STDDEV_SAMP(value)', 4)} AS stddev, MIN(value) AS "min", MAX(value) AS "max" FROM bronze""")
register("value_stats_by_sensor", f"""SELECT sensor_type, COUNT(value) AS count_non_null,
  {rhu('AVG(value)', 4)} AS mean, {rhu('STDDEV_SAMP(value)', 4)} AS stddev,
  {rhu('MIN(value)', 4)} AS "min", {rhu('MAX(value)', 4)} AS "max" FROM bronze GROUP BY sensor_type""")

_NULL_COLS = ["event_id", "machine_id", "sensor_type", "value", "unit", "timestamp", "ingested_at"]
register("null_counts", "\nUNION ALL\n".join(
    f"""SELECT {i + 1} AS position, '{c}' AS column_name, nc AS null_count, {pct('nc', 'n', 1)} AS null_pct,
  CASE WHEN nc > 0 THEN 'PROBLEM' ELSE 'OK' END AS status
FROM (SELECT COUNT(*) FILTER (WHERE "{c}" IS NULL) AS nc, COUNT(*) AS n FROM bronze)"""
    for i, c in enumerate(_NULL_COLS)))
register("duplicate_ids", 'SELECT event_id, COUNT(*) AS "count" FROM bronze GROUP BY event_id HAVING COUNT(*) > 1')
register("top_duplicate_ids", '''SELECT event_id, COUNT(*) AS "count" FROM bronze GROUP BY event_id
  HAVING COUNT(*) > 1 ORDER BY "count" DESC, event_id LIMIT 10''')
register("duplicate_surplus", """SELECT COUNT(*) AS total_rows, COUNT(DISTINCT event_id) AS distinct_ids,
  COALESCE(COUNT(*) - COUNT(DISTINCT event_id) - MAX(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END), 0) AS surplus_rows
  FROM bronze""")
for _name, _same in {"stored_dedup_prefer_value": "dedup_prefer_value", "stored_dedup_first_arrival": "dedup_first_arrival",
                     "stored_duplicate_ids": "duplicate_ids", "stored_duplicate_surplus": "duplicate_surplus"}.items():
    ORACLES[_name] = ORACLES[_same]
register("out_of_range_rows", f"SELECT * FROM bronze WHERE {OUT_OF_RANGE}")
register("out_of_range_rate", f"""SELECT total_rows, out_of_range_count,
  {pct('out_of_range_count', 'total_rows', 2)} AS out_of_range_pct FROM (
  SELECT COUNT(*) AS total_rows,
         COUNT(*) FILTER (WHERE COALESCE({OUT_OF_RANGE}, FALSE) AND value IS NOT NULL) AS out_of_range_count
  FROM bronze)""")
register("out_of_range_by_sensor", f"""SELECT sensor_type, COUNT(*) AS out_of_range_count,
  {rhu('MIN(value)', 2)} AS min_bad_value, {rhu('MAX(value)', 2)} AS max_bad_value
  FROM bronze WHERE {OUT_OF_RANGE} GROUP BY sensor_type""")
register("bronze_quality_summary", f"""SELECT total_rows, null_values, {pct('null_values', 'total_rows', 1)} AS null_pct,
  duplicate_rows, {pct('duplicate_rows', 'total_rows', 1)} AS duplicate_pct,
  out_of_range, {pct('out_of_range', 'total_rows', 1)} AS out_of_range_pct,
  total_rows - null_values - duplicate_rows - out_of_range AS expected_clean_rows_naive, clean_rows
FROM (SELECT COUNT(*) AS total_rows,
             COUNT(*) FILTER (WHERE value IS NULL) AS null_values,
             COALESCE(COUNT(*) - COUNT(DISTINCT event_id) - MAX(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END), 0) AS duplicate_rows,
             COUNT(*) FILTER (WHERE COALESCE({OUT_OF_RANGE}, FALSE) AND value IS NOT NULL) AS out_of_range,
             (SELECT COUNT(*) FROM silver) AS clean_rows
      FROM bronze)""")
register("layer_retention", f"""SELECT bronze_rows, silver_rows, bronze_rows - silver_rows AS rows_removed,
  {pct('bronze_rows - silver_rows', 'bronze_rows', 1)} AS removed_pct,
  {pct('silver_rows', 'bronze_rows', 1)} AS retained_pct
FROM (SELECT (SELECT COUNT(*) FROM bronze) AS bronze_rows, (SELECT COUNT(*) FROM silver) AS silver_rows)""")
register("silver_stats_by_sensor", f"""SELECT sensor_type, COUNT(*) AS row_count,
  {rhu('MIN(value)', 4)} AS min_value, {rhu('MAX(value)', 4)} AS max_value, {rhu('AVG(value)', 4)} AS mean_value
  FROM silver GROUP BY sensor_type""")
register("check_silver_range", f"SELECT COUNT(*) FILTER (WHERE COALESCE({OUT_OF_RANGE}, FALSE)) AS n FROM silver")

# ---- expectations --------------------------------------------------------------


def _metrics_sql(dataset: str, action: str, src: str, rules) -> str:
    all_pass = " AND ".join(f"COALESCE({r}, FALSE)" for _, r in rules)
    dropped = f"COUNT(*) FILTER (WHERE NOT ({all_pass}))" if action == "drop" else "CAST(0 AS BIGINT)"
    fails = ", ".join(f"COUNT(*) FILTER (WHERE NOT COALESCE({r}, FALSE)) AS f{i}" for i, (_, r) in enumerate(rules))
    agg = f"(SELECT COUNT(*) AS n, {dropped} AS d, {fails} FROM {src})"
    return "\nUNION ALL\n".join(
        f"""SELECT '{dataset}' AS dataset, '{action}' AS action, n AS input_records, d AS dropped_records,
  {i + 1} AS rule_index, '{name}' AS rule, f{i} AS failed_records FROM {agg}"""
        for i, (name, _) in enumerate(rules))


register("expect_drop_metrics", _metrics_sql("silver_sensors", "drop", "deduped", RULES))
HOURLY_RULES = [("reading_count is positive", "reading_count > 0"), ("avg_value is not null", "avg_value IS NOT NULL")]
DAILY_RULES = [("health_score is valid", "health_score_pct BETWEEN 0 AND 100"),
               ("machine_id is not null", "machine_id IS NOT NULL")]
ANOMALY_RULES = [("z_score is positive", "z_score > 0"), ("z_score exceeds threshold", "z_score > 2.0")]
register("expect_warn_metrics", "\nUNION ALL\n".join([
    _metrics_sql("gold_hourly_stats", "warn", "hourly", HOURLY_RULES),
    _metrics_sql("gold_daily_health", "warn", "daily", DAILY_RULES),
    _metrics_sql("gold_anomalies", "warn", "anomalies", ANOMALY_RULES)]))

# ---- anomaly analytics ------------------------------------------------------------
register("anomaly_summary", f"""SELECT machine_id, sensor_type, total_readings, anomaly_count,
  {rhu('anomaly_count / total_readings * 100.0', 2)} AS anomaly_rate_pct, max_z_score
FROM (SELECT machine_id, sensor_type, COUNT(*) AS total_readings,
             COUNT(*) FILTER (WHERE z_score > 2.0) AS anomaly_count,
             {rhu('MAX(CASE WHEN z_score > 2.0 THEN z_score END)', 2)} AS max_z_score
      FROM scored GROUP BY machine_id, sensor_type)""")
register("anomaly_profile", f"""SELECT machine_id, sensor_type, COUNT(*) AS anomaly_count,
  {rhu('MAX(z_score)', 2)} AS max_z_score, {rhu('AVG(z_score)', 2)} AS avg_z_score,
  {rhu('MIN(value)', 4)} AS min_anomalous_value, {rhu('MAX(value)', 4)} AS max_anomalous_value
  FROM anomalies GROUP BY machine_id, sensor_type""")
register("top_anomalies", f"""SELECT machine_id, sensor_type, {rhu('value', 4)} AS value, unit,
  {rhu('rolling_avg', 4)} AS rolling_avg, {rhu('z_score', 2)} AS z_score, "timestamp"
  FROM anomalies ORDER BY {rhu('z_score', 2)} DESC, anomalies.z_score DESC, event_id LIMIT 10""")
register("anomalies_per_day", f"""SELECT CAST("timestamp" AS DATE) AS "date", machine_id, sensor_type,
  COUNT(*) AS anomaly_count, {rhu('AVG(z_score)', 2)} AS avg_z_score
  FROM anomalies GROUP BY CAST("timestamp" AS DATE), machine_id, sensor_type""")
register("most_anomalous_sensor", """SELECT sensor_type, COUNT(*) AS n FROM anomalies GROUP BY sensor_type
  ORDER BY n DESC, sensor_type LIMIT 1""")
register("max_anomaly", f"""SELECT machine_id, sensor_type, {rhu('z_score', 2)} AS z_score FROM anomalies
  ORDER BY {rhu('anomalies.z_score', 2)} DESC, anomalies.z_score DESC, event_id LIMIT 1""")
register("anomaly_headline", f"""SELECT anomaly_count, silver_rows,
  {rhu('CAST(anomaly_count AS DOUBLE) / NULLIF(silver_rows, 0) * 100.0', 2)} AS anomaly_rate_pct,
  {rhu('a', 2)} AS avg_z_score, {rhu('m', 2)} AS max_z_score
FROM (SELECT COUNT(*) AS silver_rows, COUNT(*) FILTER (WHERE z_score > 2.0) AS anomaly_count,
             AVG(CASE WHEN z_score > 2.0 THEN z_score END) AS a, MAX(CASE WHEN z_score > 2.0 THEN z_score END) AS m
      FROM scored)""")

# ---- health roll-ups -------------------------------------------------------------------


def _avg1(score: str) -> str:
    s = f"SUM(CAST(round({score} * 10.0) AS BIGINT))"
    a5 = f"(({s}) * 20000 + COUNT({score})) // (2 * COUNT({score}))"
    return f"(CAST(({a5} + 5000) // 10000 AS DOUBLE) / 10.0)"


_WORST = """CASE MAX(CASE machine_status WHEN 'NORMAL' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'CRITICAL' THEN 2 END)
    WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'CRITICAL' END"""


def _health_avg(src):
    return f"""SELECT machine_id, {_avg1('health_score_pct')} AS avg_health_score, {_WORST} AS worst_status
  FROM {src} GROUP BY machine_id"""


def _health_overall(src):
    return f"""SELECT machine_id, {_avg1('health_score_pct')} AS avg_health_score,
  MIN(health_score_pct) AS worst_day_score, MAX(health_score_pct) AS best_day_score,
  CASE WHEN MIN(health_score_pct) < 80 THEN 'CRITICAL' WHEN MIN(health_score_pct) < 95 THEN 'WARNING'
       ELSE 'NORMAL' END AS overall_status,
  {_WORST} AS worst_daily_status, CAST(SUM(total_readings) AS BIGINT) AS total_readings
  FROM {src} GROUP BY machine_id"""


def _worst_machine(src):
    return f"""SELECT machine_id, {_avg1('health_score_pct')} AS avg_score FROM {src}
  GROUP BY machine_id ORDER BY avg_score ASC, machine_id LIMIT 1"""


register("machine_health_avg", _health_avg("daily"))
register("machine_health_avg_deduped_bronze", _health_avg("daily_bronze"))
register("machine_health_overall", _health_overall("daily"))
register("machine_health_overall_deduped_bronze", _health_overall("daily_bronze"))
register("worst_machine", _worst_machine("daily"))
register("worst_machine_deduped_bronze", _worst_machine("daily_bronze"))
register("daily_health_listing", f"""SELECT "date", machine_id, health_score_pct, machine_status, total_readings,
  {rhu('avg_temperature', 2)} AS avg_temp, {rhu('avg_pressure', 2)} AS avg_pressure,
  {rhu('avg_vibration', 4)} AS avg_vibration FROM daily""")
register("daily_reading_counts", """SELECT CAST("timestamp" AS DATE) AS "date", machine_id, COUNT(*) AS readings,
  COUNT(DISTINCT sensor_type) AS sensor_types_active FROM silver GROUP BY CAST("timestamp" AS DATE), machine_id""")
register("sensor_profile", f"""SELECT machine_id, sensor_type, COUNT(*) AS readings, {rhu('AVG(value)', 3)} AS mean,
  {rhu('STDDEV_SAMP(value)', 3)} AS stddev, {rhu('MIN(value)', 3)} AS min_val, {rhu('MAX(value)', 3)} AS max_val
  FROM silver GROUP BY machine_id, sensor_type""")

# ---- quality report --------------------------------------------------------------------


def _report_sql(run_id, at, deduped, silver, hourly, daily, anomalies, days_expected):
    counts = f"""(SELECT
  (SELECT COUNT(*) FROM bronze) AS br,
  (SELECT COUNT(*) FROM bronze WHERE value IS NULL) AS bn,
  (SELECT COUNT(*) - COUNT(DISTINCT event_id) - MAX(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END) FROM bronze) AS bd,
  (SELECT COUNT(*) FROM {silver}) AS sr,
  (SELECT COUNT(*) FROM {silver} WHERE value IS NULL) AS sn,
  (SELECT COUNT(*) - COUNT(DISTINCT event_id) - COALESCE(MAX(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END), 0)
     FROM {silver}) AS sd,
  (SELECT COUNT(*) FROM {silver} WHERE {OUT_OF_RANGE}) AS sv,
  (SELECT COUNT(DISTINCT machine_id) FROM {daily}) AS gm,
  (SELECT COUNT(*) FROM {daily} WHERE health_score_pct < 0 OR health_score_pct > 100) AS gi,
  (SELECT COUNT(DISTINCT "date") FROM {hourly}) AS gd,
  (SELECT COUNT(*) FROM {anomalies}) AS ga)"""
    ret, anom = pct("sr", "br", 2), pct("ga", "sr", 2)
    ret_st = f"CASE WHEN {ret} >= 85.0 THEN 'PASS' WHEN {ret} >= 70.0 THEN 'WARN' ELSE 'FAIL' END"
    an_st = f"CASE WHEN {anom} BETWEEN 1.0 AND 20.0 THEN 'PASS' WHEN {anom} < 1.0 THEN 'WARN' ELSE 'FAIL' END"
    rows = [
        ("bronze", "bronze_sensors", "row_count", "br", "9000", "CASE WHEN br >= 9000 THEN 'PASS' ELSE 'FAIL' END"),
        ("bronze", "bronze_sensors", "null_rate_pct", pct("bn", "br", 2), "5.0",
         f"CASE WHEN {pct('bn', 'br', 2)} <= 5.0 THEN 'PASS' ELSE 'FAIL' END"),
        ("bronze", "bronze_sensors", "duplicate_rate_pct", pct("bd", "br", 2), "3.0",
         f"CASE WHEN {pct('bd', 'br', 2)} <= 3.0 THEN 'PASS' ELSE 'FAIL' END"),
        ("silver", "silver_sensors", "row_count", "sr", "NULL", "'PASS'"),
        ("silver", "silver_sensors", "null_count", "sn", "0", "CASE WHEN sn = 0 THEN 'PASS' ELSE 'FAIL' END"),
        ("silver", "silver_sensors", "duplicate_count", "sd", "0", "CASE WHEN sd = 0 THEN 'PASS' ELSE 'FAIL' END"),
        ("silver", "silver_sensors", "range_violations", "sv", "0", "CASE WHEN sv = 0 THEN 'PASS' ELSE 'FAIL' END"),
        ("silver", "silver_sensors", "retention_pct", ret, "85.0", ret_st),
        ("gold", "gold_daily_health", "distinct_machines", "gm", "5", "CASE WHEN gm = 5 THEN 'PASS' ELSE 'FAIL' END"),
        ("gold", "gold_daily_health", "invalid_scores", "gi", "0", "CASE WHEN gi = 0 THEN 'PASS' ELSE 'FAIL' END"),
        ("gold", "gold_anomalies", "anomaly_rate_pct", anom, "20.0", an_st),
        ("gold", "gold_hourly_stats", "days_covered", "gd", str(days_expected),
         f"CASE WHEN gd = {days_expected} THEN 'PASS' ELSE 'WARN' END"),
        ("lineage", "cross_layer", "bronze_to_silver_retention_pct", ret, "85.0", ret_st),
        ("lineage", "cross_layer", "rows_removed_cleaning", "br - sr", "NULL", "'PASS'"),
        ("lineage", "cross_layer", "anomaly_rate_pct", anom, "20.0", an_st),
    ]
    return "\nUNION ALL\n".join(
        f"""SELECT '{run_id}' AS run_id, '{layer}' AS layer, '{table}' AS table_name, '{name}' AS check_name,
  CAST({metric} AS DOUBLE) AS metric_value, CAST({thr} AS DOUBLE) AS threshold, {status} AS status,
  TIMESTAMP '{at}' + to_seconds({i}) AS checked_at FROM {counts}"""
        for i, (layer, table, name, metric, thr, status) in enumerate(rows))


REPORT_LATEST = _report_sql("20240201_000000", "2024-02-01 00:00:00", "deduped", "silver", "hourly", "daily",
                            "anomalies", 7)
REPORT_PREV = _report_sql("20240131_000000", "2024-01-31 00:00:00", "deduped_fa", "silver_fa", "hourly_fa",
                          "daily_fa", "anomalies_fa", 30)
HISTORY = f"(\n{REPORT_PREV}\nUNION ALL\n{REPORT_LATEST}\n)"
LATEST = f"(SELECT * FROM {HISTORY} h WHERE run_id = (SELECT MAX(run_id) FROM {HISTORY} h2))"
_STATUS_COUNTS = """COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE status = 'PASS') AS passed,
  COUNT(*) FILTER (WHERE status = 'WARN') AS warned, COUNT(*) FILTER (WHERE status = 'FAIL') AS failed"""

register("quality_report", REPORT_LATEST)
register("latest_run_checks", f"SELECT * FROM {LATEST} x")
register("quality_by_layer", f"SELECT layer, {_STATUS_COUNTS} FROM {LATEST} x GROUP BY layer")
register("quality_detail", f"""SELECT layer, check_name, {rhu('metric_value', 2)} AS metric_value, threshold, status
  FROM {LATEST} x""")
register("check_failures", f"""SELECT layer, check_name, metric_value, threshold, status FROM {LATEST} x
  WHERE status IN ('FAIL', 'WARN')""")
register("check_failure_count", f"SELECT COUNT(*) FILTER (WHERE status IN ('FAIL', 'WARN')) AS failures FROM {LATEST} x")
register("quality_trend", f"SELECT run_id, MAX(checked_at) AS checked_at, {_STATUS_COUNTS} FROM {HISTORY} x GROUP BY run_id")
_RATE = rhu("CAST(passed AS DOUBLE) / NULLIF(total_checks, 0) * 100.0", 0)
register("quality_scorecard", f"""SELECT layer, total_checks, passed, warned, failed,
  CAST({_RATE} AS VARCHAR) || '%' AS pass_rate, {_RATE} AS pass_rate_pct
  FROM (SELECT layer, {_STATUS_COUNTS} FROM {LATEST} x GROUP BY layer)""")
register("quality_pass_rate", f"SELECT {_RATE} AS pass_rate FROM (SELECT {_STATUS_COUNTS} FROM {LATEST} x)")

# ---- flow, findings, dashboards --------------------------------------------------------------
register("row_flow", f"""SELECT br AS bronze_rows, br - sr AS rows_removed,
  {rhu('100.0 - ' + pct('sr', 'br', 1), 1)} AS removed_pct, sr AS silver_rows,
  {pct('sr', 'br', 1)} AS retained_pct, hr AS hourly_rows, dr AS daily_rows, ar AS anomaly_rows
FROM (SELECT (SELECT COUNT(*) FROM bronze) AS br, (SELECT COUNT(*) FROM silver) AS sr,
             (SELECT COUNT(*) FROM hourly) AS hr, (SELECT COUNT(*) FROM daily) AS dr,
             (SELECT COUNT(*) FROM anomalies) AS ar)""")
register("key_findings", f"""SELECT
  (SELECT COUNT(*) FROM bronze) AS total_raw_readings,
  (SELECT COUNT(*) FROM silver) AS clean_readings,
  {pct('(SELECT COUNT(*) FROM silver)', '(SELECT COUNT(*) FROM bronze)', 1)} AS retained_pct,
  (SELECT {_RATE} FROM (SELECT {_STATUS_COUNTS} FROM ({REPORT_LATEST}) r)) AS quality_pass_rate,
  (SELECT COUNT(*) FROM anomalies) AS anomalies_detected,
  w.machine_id AS worst_machine_id, w.avg_score AS worst_machine_avg_score,
  m.sensor_type AS most_anomalous_sensor, m.n AS most_anomalous_sensor_count,
  x.machine_id AS max_z_machine_id, x.sensor_type AS max_z_sensor_type, x.z_score AS max_z_score
FROM ({_worst_machine('daily')}) w,
     (SELECT sensor_type, COUNT(*) AS n FROM anomalies GROUP BY sensor_type ORDER BY n DESC, sensor_type LIMIT 1) m,
     (SELECT machine_id, sensor_type, {rhu('z_score', 2)} AS z_score FROM anomalies
      ORDER BY {rhu('anomalies.z_score', 2)} DESC, anomalies.z_score DESC, event_id LIMIT 1) x""")
register("dash_hourly_trend", """SELECT machine_id, sensor_type, unit, hour_window, reading_count, avg_value,
  min_value, max_value FROM hourly WHERE hour_window > (SELECT MAX(hour_window) FROM hourly) - INTERVAL 7 DAY""")
register("dash_health_heatmap", 'SELECT machine_id, "date", health_score_pct, machine_status FROM daily_bronze')
register("dash_anomaly_points", 'SELECT "timestamp", machine_id, sensor_type, value, z_score FROM anomalies')
register("dash_drop_rate", f"""SELECT rule_index, rule, failed_records, input_records,
  {pct('failed_records', 'input_records', 2)} AS drop_rate_pct
  FROM ({_metrics_sql('silver_sensors', 'drop', 'deduped', RULES)}) m""")

# ---- tables --------------------------------------------------------------------------
register("write_partitioned_roundtrip", "SELECT * FROM silver")
register("partition_pruned_read", "SELECT * FROM silver WHERE sensor_type = 'temperature'")
register("quality_report_append", f"SELECT * FROM {HISTORY} x")
register("row_and_column_count", "SELECT COUNT(*) AS row_count, 7 AS column_count FROM bronze")
register("sample_rows", "SELECT * FROM silver ORDER BY event_id LIMIT 20")
register("publish_roundtrip", "SELECT * FROM daily")
for _name in ("gold_hourly_stats", "gold_daily_health", "gold_anomalies"):
    ORACLES[f"pipeline_{_name}"] = ORACLES[_name]
register("pipeline_rule_metrics", "SELECT *, '20240201_000000' AS run_id FROM (" + "\nUNION ALL\n".join([
    _metrics_sql("silver_sensors", "drop", "deduped", RULES),
    _metrics_sql("gold_hourly_stats", "warn", "hourly", HOURLY_RULES),
    _metrics_sql("gold_daily_health", "warn", "daily", DAILY_RULES),
    _metrics_sql("gold_anomalies", "warn", "anomalies", ANOMALY_RULES)]) + ") m")
register("table_detail", "SELECT sensor_type, 'parquet' AS format, COUNT(*) AS row_count, TRUE AS has_files, "
         "TRUE AS has_bytes FROM bronze GROUP BY sensor_type")
ORACLES["published_properties"] = """SELECT * FROM (VALUES ('quality', 'gold'), ('consumer', 'maintenance-dashboard'),
  ('note', 'it''s the maintenance team''s')) t(key, value)"""
for _layer in ("bronze", "silver", "gold", "lineage"):
    register(f"check_{_layer}", f"SELECT * FROM ({REPORT_LATEST}) r WHERE layer = '{_layer}'")
register("anomaly_summary_sql", """SELECT machine_id, COUNT(*) AS sensor_types, CAST(SUM(n) AS BIGINT) AS anomalies,
  MAX(z) AS highest_z FROM (SELECT machine_id, sensor_type, COUNT(*) AS n, """ + rhu("MAX(z_score)", 2) + """ AS z
  FROM anomalies GROUP BY machine_id, sensor_type) s GROUP BY machine_id HAVING COUNT(*) > 1""")
register("dash_health_heatmap_wide", "SELECT machine_id, " + ", ".join(
    f"MAX(health_score_pct) FILTER (WHERE \"date\" = DATE '2024-01-{d:02d}') AS \"2024-01-{d:02d}\""
    for d in range(1, 31)) + " FROM daily_bronze GROUP BY machine_id")

# ---- rule masks, repeated runs, rewritten days, listings ------------------------------
_FAILS = [f"NOT COALESCE({r}, FALSE)" for _, r in RULES]
_MASKED = "SELECT " + ", ".join(f"({f}) AS f{i}" for i, f in enumerate(_FAILS)) + " FROM deduped"
register("rule_failure_masks", "SELECT CAST(" + " + ".join(f"{1 << i} * CAST(f{i} AS BIGINT)" for i in range(len(RULES)))
         + " AS BIGINT) AS mask, concat_ws('; ', " + ", ".join(f"CASE WHEN f{i} THEN '{n}' END" for i, (n, _) in enumerate(RULES))
         + ") AS failed_rules, CAST(" + " + ".join(f"CAST(f{i} AS INTEGER)" for i in range(len(RULES)))
         + f" AS INTEGER) AS rules_failed, COUNT(*) AS records FROM ({_MASKED}) m GROUP BY ALL")
register("rule_overlaps", "\nUNION ALL\n".join(
    f"SELECT '{RULES[i][0]}' AS rule_a, '{RULES[j][0]}' AS rule_b, COUNT(*) FILTER (WHERE f{i}) AS failed_a, "
    f"COUNT(*) FILTER (WHERE f{j}) AS failed_b, COUNT(*) FILTER (WHERE f{i} AND f{j}) AS failed_both FROM ({_MASKED}) m{i}{j}"
    for i in range(len(RULES)) for j in range(i + 1, len(RULES))))
ORACLES["quality_report_rerun"] = ORACLES["quality_report_append"]
register("hourly_days_rewritten", """SELECT * FROM hourly WHERE "date" <= (SELECT MAX("date") FROM hourly) - 2
UNION ALL SELECT * FROM hourly_fa WHERE "date" > (SELECT MAX("date") FROM hourly) - 2""")
register("table_files", "SELECT DISTINCT sensor_type, 'parquet' AS format, TRUE AS has_files, TRUE AS has_bytes FROM bronze")
ORACLES["schema_rows"] = """SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name,
  CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type
FROM (DESCRIBE """ + q("SELECT * FROM bronze") + ")"
