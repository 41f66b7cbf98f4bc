"""Write layouts, append history, publish with properties, table detail."""

import os

import pytest
from pyspark.sql import functions as F

from sensorlake.config import DEFAULT
from sensorlake.operators import dedup as D
from sensorlake.plans import quality as QR
from sensorlake.plans import registry as R
from sensorlake.plans.layers import Layers
from sensorlake.plans.pipeline import run_pipeline, shared_dir
from sensorlake.sources import tables as T

SF = "/root/testdata/sf0.001"


def test_partitioned_write_prunes_partitions(spark):
    ly = Layers.from_testdata(spark, SF)
    path = shared_dir(spark, "t-silver")
    T.write_partitioned(ly.silver, path, T.LAYOUTS["silver_sensors"])
    back = spark.read.parquet(path).filter("sensor_type = 'pressure'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sensor_type" in plan
    assert back.count() == ly.silver.filter("sensor_type = 'pressure'").count()


def test_publish_sets_comment_and_properties(spark):
    ly = Layers.from_testdata(spark, SF)
    T.publish(ly.daily, "sensors_test.gold_daily_health", comment="Daily health per machine",
              properties={"quality": "gold", "consumer": "maintenance-dashboard"}, partition_by=("date",))
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES sensors_test.gold_daily_health").collect()}
    assert props["quality"] == "gold" and props["consumer"] == "maintenance-dashboard"
    assert spark.table("sensors_test.gold_daily_health").count() == ly.daily.count()


def _walk(path):
    local = path.removeprefix("file:")
    return [os.path.join(d, f) for d, _, names in os.walk(local) for f in names if f.endswith(".parquet")]


def test_table_detail_is_the_folder_listing(spark):
    path = shared_dir(spark, "t-odd")
    rows = [("a b", 1), ("x+y", 2), ("50%", 3), ("ü/z", 4), (None, 5), ("a b", 6)]
    T.write_partitioned(spark.createDataFrame(rows, "sensor_type string, n int"), path, ("sensor_type",))
    files = _walk(path)
    all_ = T.table_detail(spark, path)
    assert "FileScan parquet" not in all_._jdf.queryExecution().executedPlan().toString()
    assert "content" not in all_._jdf.queryExecution().executedPlan().toString()
    d = all_.first()
    assert (d.format, d.num_files, d.size_in_bytes) == ("parquet", len(files), sum(map(os.path.getsize, files)))
    per = {r.sensor_type: r.num_files for r in T.table_detail(spark, path, ("sensor_type",)).collect()}
    assert set(per) == {"a b", "x+y", "50%", "ü/z", None} and sum(per.values()) == len(files)
    assert T.partition_values(spark, path, "sensor_type") == sorted(["a b", "x+y", "50%", "ü/z"])
    detail = T.partition_detail(spark, path, spark.read.schema("sensor_type string, n int").parquet(path), "sensor_type")
    assert {(r.sensor_type, r.row_count, r.has_files, r.has_bytes) for r in detail.collect()} == {
        ("a b", 2, True, True), ("x+y", 1, True, True), ("50%", 1, True, True), ("ü/z", 1, True, True), (None, 1, True, True)}


def test_only_the_given_partitions_are_overwritten(spark):
    path = shared_dir(spark, "t-days")
    day = lambda *rows: spark.createDataFrame(rows, "date string, n int")
    T.overwrite_partitions(day(("d1", 1), ("d2", 2), ("d3", 3)), path, ("date",))
    before = {f for f in _walk(path) if "date=d1" in f}
    for _ in range(2):  # again changes nothing
        T.overwrite_partitions(day(("d2", 20), ("d2", 21), ("d4", 4)), path, ("date",))
        got = sorted(tuple(r) for r in spark.read.schema("n int, date string").parquet(path).collect())
        assert got == [(1, "d1"), (3, "d3"), (4, "d4"), (20, "d2"), (21, "d2")]
    assert before == {f for f in _walk(path) if "date=d1" in f}
    T.overwrite_partitions(day(("d1", 1)).limit(0), path, ("date",))
    assert spark.read.parquet(path).count() == 5


def test_a_repeated_run_replaces_itself(spark):
    path = shared_dir(spark, "t-runs")
    run = lambda i, n: spark.range(n).withColumn("run_id", F.lit(i))
    for i, n in (("r1", 15), ("r2", 15), ("r1", 15), ("r2", 3)):
        T.append_run(run(i, n), path)
    assert {(r.run_id, r["count"]) for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {("r1", 15), ("r2", 3)}


def test_each_written_layer_has_one_audit_time_of_the_run(spark):
    ly = Layers.from_testdata(spark, SF)
    begin = spark.range(1).select(F.current_timestamp()).first()[0]
    out = run_pipeline(spark, ly.bronze, shared_dir(spark, "t-audit"), "r1", "2024-01-01 00:00:00", ly.cfg)
    end = spark.range(1).select(F.current_timestamp()).first()[0]
    last = begin
    for name, column in (("bronze_sensors", "_ingested_at"), ("silver_sensors", "_silver_processed_at"), ("gold_hourly_stats", "_gold_processed_at"),
                         ("gold_daily_health", "_gold_processed_at"), ("gold_anomalies", "_gold_processed_at")):
        stamps = [r[0] for r in out["tables"][name].select(column).distinct().collect()]
        assert len(stamps) == 1 and last <= stamps[0] <= end
        last = stamps[0] if name != "gold_hourly_stats" and not name.startswith("gold") else last


def test_queries_leave_the_catalog_as_it_was(spark):
    from sensorlake.plans.registry import QUERIES
    names = lambda: sorted(r[0] for r in spark.sql("SHOW DATABASES").collect())
    before = names()
    assert QUERIES["publish_roundtrip"](spark, SF).count() == QUERIES["gold_daily_health"](spark, SF).count()
    assert QUERIES["published_properties"](spark, SF).count() == 3 and names() == before


def test_heatmap_has_the_days_of_the_data(spark, tmp_path):
    from sensorlake.plans.registry import QUERIES
    events = spark.read.parquet(f"{SF}/events.parquet")
    later = events.withColumn("ts", (F.col("ts") + F.expr("INTERVAL '400' DAY")).cast(dict(events.dtypes)["ts"])).orderBy("event_id").limit(30) \
        .withColumn("event_id", F.col("event_id") + 1_000_000)
    events.orderBy("event_id").limit(300).unionByName(later).write.parquet(f"{tmp_path}/events.parquet")
    wide = QUERIES["dash_health_heatmap_wide"](spark, str(tmp_path))
    days = {str(r[0]) for r in QUERIES["daily_health_deduped_bronze"](spark, str(tmp_path)).select("date").distinct().collect()}
    assert set(wide.columns) == days | {"machine_id"} and any(d > "2025" for d in days)


def test_stored_layers_start_no_job_for_reports(spark):
    from sensorlake.plans.registry import QUERIES
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    reports = ("row_flow", "quality_report", "key_findings", "expect_warn_metrics", "anomaly_summary")
    for name in reports:
        QUERIES[name](spark, SF)  # the layers are stored with the first
    before = jobs()
    plans = [QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString() for name in reports]
    assert jobs() == before and all("ExistingRDD" not in p and "events.parquet" not in p for p in plans)


def test_rule_masks(spark):
    from sensorlake.operators.expectations import expectation_metrics, failure_mask, failure_masks, mask_histogram, rule_overlaps
    df = spark.createDataFrame([(1, 1), (-1, 1), (None, 1), (-1, None), (5, -2)], "a int, b int")
    rules = [("a > 0", F.col("a") > 0), ("b > 0", F.col("b") > 0), ("a < 5", F.col("a") < 5)]
    hist = mask_histogram(df.select(failure_mask(rules).alias("mask")))
    got = {r.mask: (r.failed_rules, r.rules_failed, r.records) for r in failure_masks(hist, rules).collect()}
    assert got == {0: ("", 0, 1), 1: ("a > 0", 1, 1), 5: ("a > 0; a < 5", 2, 1), 3: ("a > 0; b > 0", 2, 1), 6: ("b > 0; a < 5", 2, 1)}
    both = {(r.rule_a, r.rule_b): (r.failed_a, r.failed_b, r.failed_both) for r in rule_overlaps(hist, rules).collect()}
    assert both == {("a > 0", "b > 0"): (3, 2, 1), ("a > 0", "a < 5"): (3, 2, 1), ("b > 0", "a < 5"): (2, 2, 1)}
    m = expectation_metrics(df, rules, "t").collect()
    assert [(r.failed_records, r.input_records, r.dropped_records) for r in m] == [(3, 5, 4), (2, 5, 4), (2, 5, 4)]
    none = expectation_metrics(df.limit(0), rules, "t").collect()
    assert [(r.failed_records, r.input_records, r.dropped_records) for r in none] == [(0, 0, 0)] * 3
    with pytest.raises(ValueError, match="63"):
        failure_mask(rules * 22)


def test_pipeline_run_and_two_appends_make_two_runs(spark):
    ly = Layers.from_testdata(spark, SF)
    wh = shared_dir(spark, "wh")
    out = run_pipeline(spark, ly.bronze, wh, "20240101_000000", "2024-01-01 00:00:00", ly.cfg)
    run_pipeline(spark, ly.bronze, wh, "20240102_000000", "2024-01-02 00:00:00", ly.cfg)
    hist = spark.read.parquet(out["paths"]["quality_report"])
    trend = QR.quality_trend(hist).collect()
    assert len(trend) == 2 and all(t.total_checks == 15 for t in trend)
    rules = spark.read.parquet(out["paths"]["rule_metrics"])
    assert rules.groupBy("run_id").count().collect()[0]["count"] == 11
    silver = rules.filter("dataset = 'silver_sensors' AND run_id = '20240102_000000'").collect()
    assert {r.input_records for r in silver} == {ly.deduped.count()}
    assert spark.read.parquet(out["paths"]["gold_anomalies"]).count() == 34


def _same(stored, direct):
    cols = direct.columns
    rows = lambda df: sorted(map(repr, df.select(cols).collect()))
    assert [f.dataType for f in stored.select(cols).schema] == [f.dataType for f in direct.schema]
    assert rows(stored) == rows(direct)


@pytest.mark.parametrize("kind", ["digits", "clean", "empty"])
def test_pipeline_tables_equal_the_direct_functions(spark, readings, kind):
    rows = []
    if kind == "digits":  # machine names that look like numbers stay apart
        rows = [(f"{m}-{i}", m, "temperature", 80.0 + i % 5 + (25.0 if i == 55 else 0), i) for m in ("007", "7") for i in range(60)]
    if kind == "clean":  # no anomalies: nothing is written for them
        rows = [(f"e{i}", "M1", "pressure", 5.0, i) for i in range(5)]
    bronze = readings(rows)
    out = run_pipeline(spark, bronze, shared_dir(spark, f"t-{kind}"), "r1", "2024-01-01 00:00:00")
    direct = Layers(bronze, DEFAULT)
    for name, df in (("silver_sensors", direct.silver), ("gold_hourly_stats", direct.hourly),
                     ("gold_daily_health", direct.daily), ("gold_anomalies", direct.anomalies)):
        _same(out["tables"][name], df)
    assert spark.read.parquet(out["paths"]["quality_report"]).count() == 15
    if kind == "digits":
        daily = {r.machine_id: r.total_readings for r in out["tables"]["gold_daily_health"].collect()}
        assert daily == {"007": 60, "7": 60}


def test_pipeline_publishes_catalog_tables(spark, readings):
    bronze = readings([(f"e{i}", "M1", "pressure", 5.0, i) for i in range(5)])
    bronze.createOrReplaceTempView("raw_readings")
    wh = shared_dir(spark, "t-catalog")
    run_pipeline(spark, "raw_readings", wh, "r1", "2024-01-01 00:00:00", database="sensors_run")
    for name in ("bronze_sensors", "silver_sensors", "gold_hourly_stats", "gold_daily_health", "gold_anomalies"):
        props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES sensors_run.{name}").collect()}
        assert props["quality"] == name.split("_")[0]
    assert spark.table("sensors_run.silver_sensors").count() == 5
    spark.sql("DROP DATABASE sensors_run CASCADE")


def test_properties_are_quoted(spark):
    T.publish(spark.range(1).toDF("n"), "sensors_quoted.t", properties={"o'key": "it's \\ here"})
    got = {r.key: r.value for r in T.table_properties(spark, "sensors_quoted.t", ["o'key"]).collect()}
    assert got == {"o'key": "it's \\ here"}
    spark.sql("DROP DATABASE sensors_quoted CASCADE")


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from sensorlake.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_scratch_folder_is_removed_with_the_driver(spark):
    from sensorlake.session import scratch_dir
    path = scratch_dir(spark)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert shared_dir(spark, "x").startswith(path)
    assert fs.cancelDeleteOnExit(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))
    scratch_dir(spark)  # marked again


def test_cluster_conf_sizes_partitions_by_volume():
    from sensorlake.session import cluster_conf
    c = cluster_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and 100 * 2**40 / parts <= 256 << 20
    assert int(cluster_conf(10 << 20, 2, 4)["spark.sql.shuffle.partitions"]) == 8


def test_pipeline_command_line(spark):
    from sensorlake.plans.pipeline import main
    wh = shared_dir(spark, "cli")
    out = main(["--events", f"{SF}/events.parquet", "--warehouse", wh, "--run-id", "20240301_000000",
                "--checked-at", "2024-03-01 00:00:00"])
    rep = spark.read.parquet(out["paths"]["quality_report"])
    assert rep.count() == 15
    # 1,020 Bronze rows at sf0.001 are below the 9,000-row minimum: the only failure
    failed = [(r.layer, r.check_name) for r in rep.filter("status <> 'PASS'").collect()]
    assert failed == [("bronze", "row_count")]
    assert spark.read.parquet(out["paths"]["silver_sensors"]).count() == 938


def test_typed_records(spark):
    lines = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "no", "c": 2}',), (None,), ("{",)], "line string")
    got = [tuple(r) for r in T.typed_records(lines, "line", "a int, b string").collect()]
    assert got == [(1, "x"), (None, None), (None, None), (None, None)]


def test_building_a_plan_starts_no_job(spark):
    from sensorlake.plans import health_report as HR
    events = Layers.from_testdata(spark, SF)
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    for df in (events.silver, events.hourly, events.daily, HR.machine_health_overall(events.daily),
               Layers(events.bronze, events.cfg, strategy="window").scored):
        assert df.columns
    assert jobs() == before


def _copies(make):
    rows = [("a", "m1", "pressure", None, 1), ("a", "m1", "pressure", 2.0, 9), ("a", "m1", "pressure", 2.0, 9), ("b", "m1", "pressure", 3.0, 2),
            (None, "m2", "pressure", 1.0, 3), (None, "m2", "pressure", None, 1), ("c", None, None, None, 4)]
    return make(rows + [("hot", "m3", "pressure", float(k % 7), 5000 - k) for k in range(2000)])


@pytest.mark.parametrize("order", ["prefer_value", "first_arrival"])
def test_folded_ids_answer_as_the_rows_do(spark, readings, order):
    for df in (_copies(readings), _copies(readings).limit(0)):
        folds = D.fold_ids(df)
        same = lambda a, b: sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
        assert D.preferred(folds, order).columns == df.columns
        assert same(D.preferred(folds, order), D.dedup(df, order=order))
        assert same(D.copied_ids(folds), D.duplicate_ids(df))
        assert same(D.copies_surplus(folds), D.duplicate_surplus(df))


def test_stored_folds_are_read_without_an_exchange_on_ids(spark):
    ly = R.kept_layers(spark, SF)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(ly.deduped) and "Exchange" not in plan(D.copied_ids(ly.folds))
    assert "Exchange hashpartitioning" not in plan(D.copies_surplus(ly.folds))
    # only the counts of the copies are read, not the rows
    assert "ReadSchema: struct<id:string,copies:bigint>" in plan(D.copied_ids(ly.folds))
    # both orders read one stored fold
    assert R.kept_layers(spark, SF, order="first_arrival").folds.inputFiles() == ly.folds.inputFiles()


def test_layers_of_both_orders_read_one_stored_bronze(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").limit(300).write.parquet(f"{tmp_path}/events.parquet")
    kept = [R.kept_layers(spark, str(tmp_path), order=o) for o in D.ORDERS]
    files = [set(ly.bronze.inputFiles()) for ly in kept]
    assert files[0] and files[0] == files[1]
    assert kept[0].bronze.count() == R.layers(spark, str(tmp_path)).bronze.count()


def test_folds_carry_a_row_once(spark):
    rows = [("a", "M2", "s", None, "u", 1), ("a", "M1", "s", 2.0, "u", 3), ("a", "M1", "s", 2.0, "t", 3), (None, "M1", None, 1.0, None, 2),
            (None, "M0", None, 1.0, None, 2), ("b", None, "s", None, None, 5)]
    df = spark.createDataFrame(rows, "event_id string, machine_id string, sensor_type string, value double, unit string, t int") \
        .select("event_id", "machine_id", "sensor_type", "value", "unit", F.timestamp_seconds("t").cast("timestamp_ntz").alias("timestamp"),
                F.timestamp_seconds(F.when(F.col("t") < 9, F.col("t"))).cast("timestamp_ntz").alias("ingested_at"))
    folds = D.fold_ids(df)
    plan = folds._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan
    best = {o: {r.event_id: (r.machine_id, r.value, r.unit) for r in D.preferred(folds, o).collect()} for o in D.ORDERS}
    assert best["prefer_value"] == {"a": ("M1", 2.0, "t"), None: ("M0", 1.0, None), "b": (None, None, None)}
    assert best["first_arrival"] == {"a": ("M2", None, "u"), None: ("M0", 1.0, None), "b": (None, None, None)}
    assert D.preferred(folds, "prefer_value").schema == df.schema
