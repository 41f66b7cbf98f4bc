"""Reading, writing and describing tables.

Parquet is the storage format (no Delta jars here); ``saveAsTable`` gives
catalog names. Writes partition by the layouts the layers are queried by so
that readers get partition pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Partition layouts of the published layers.
LAYOUTS = {
    "bronze_sensors": ("sensor_type",),
    "silver_sensors": ("sensor_type", "machine_id"),
    "gold_hourly_stats": ("date",),
    "gold_daily_health": ("date",),
    "gold_anomalies": ("machine_id", "sensor_type"),
    "quality_report": (),
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def typed_records(lines: DataFrame, column: str, schema: str | StructType) -> DataFrame:
    """A typed table from records in JSON, one a row, by an explicit schema (a field that is
    missing or of another type is NULL; a NULL or unreadable record is a row of NULLs)."""
    parsed = F.from_json(F.col(column), schema, {"timestampNTZFormat": NTZ_FORMAT})
    return lines.select(parsed.alias("_r")).select("_r.*")


def read_as(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a folder table back with the columns and types it was written with.

    Partition values keep their type (``007`` stays a string), and a table
    without rows, hence without files, reads as empty.
    """
    return spark.read.schema(like.schema).parquet(path).select(*[F.col(f"`{c}`") for c in like.columns])


def write_partitioned(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite",
                      fmt: str = "parquet", rebalance: bool = True) -> None:
    """Overwrite (or append) a directory table partitioned by ``partition_by``.

    A REBALANCE on the partition columns clusters rows so each task writes
    few files, and lets AQE split a partition value that holds a large share
    of the rows over several tasks (a plain ``repartition(col)`` would send
    all rows of one sensor type, a third of the table, to one task) and merge
    small ones. Without ``rebalance`` the rows are written where they are, which
    spares the shuffle when a task's rows have few partition values.
    """
    w = df
    if partition_by and rebalance:
        w = df.hint("rebalance", *partition_by)
    writer = w.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by, rebalance: bool = True) -> None:
    """Replace the partition values that ``df`` has rows of, and leave the rest of the table as it is.

    Running it again with the same rows changes nothing. A partition value without rows in
    ``df`` stays; a table that isn't there yet is written whole. The files take the
    place of the old ones when the job commits, so a job that fails leaves the table as it was.
    """
    w = df.hint("rebalance", *partition_by) if rebalance else df
    w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def append_run(df: DataFrame, path: str, run: str = "run_id") -> None:
    """Add the rows of a run to a history that is partitioned by run: a run that is repeated replaces itself,
    never another one, so that no row counts twice."""
    overwrite_partitions(df, path, (run,), rebalance=False)


def publish(df: DataFrame, name: str, comment: str | None = None,
            properties: dict[str, str] | None = None, partition_by=(),
            mode: str = "overwrite", path: str | None = None, rebalance: bool = True) -> None:
    """Save as a catalog table with a comment and table properties.

    With ``path`` the table's files live there (a shared location) and the
    catalog only records the name, comment and properties.
    """
    spark = df.sparkSession
    db = name.split(".")[0] if "." in name else None
    if db:
        loc = f" LOCATION {_quoted(path.rstrip('/').rpartition('/')[0] + '/_db_' + db)}" if path else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    w = df.hint("rebalance", *partition_by) if partition_by and rebalance else df
    writer = w.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if comment:
        writer = writer.option("comment", comment)
    writer.saveAsTable(name)
    if properties:
        props = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def table_properties(spark: SparkSession, name: str, keys: list[str]) -> DataFrame:
    """(key, value) of the named properties of a catalog table."""
    return spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key").isin(keys))


def file_listing(spark: SparkSession, path: str, partition_by=()) -> DataFrame:
    """One row per data file of a folder table: its partition values (as text), path and bytes.

    A listing of the folder: no file is opened, however many rows the table has.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet") \
        .load(path).select("path", "length")

    def value(column: str) -> Column:
        raw = F.regexp_extract("path", f"/{column}=([^/]*)/", 1)
        # folder names escape special characters only; a plus sign is a plus sign
        return F.when(raw != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).alias(column)

    return files.select(*[value(c) for c in partition_by], F.col("path"), F.col("length").alias("bytes"))


def table_detail(spark: SparkSession, path: str, partition_by=()) -> DataFrame:
    """Format, file count and bytes of a folder table, or of each of its partition values, from the listing."""
    files = file_listing(spark, path, partition_by)
    return files.groupBy(*partition_by).agg(F.lit("parquet").alias("format"), F.count(F.lit(1)).alias("num_files"),
                                            F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("size_in_bytes"))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partition column that the table has, in order (NULL left out), from the listing."""
    found = file_listing(spark, path, (column,)).select(column).distinct().collect()
    return sorted(r[0] for r in found if r[0] is not None)


def partition_detail(spark: SparkSession, path: str, rows: DataFrame, *partition_by: str) -> DataFrame:
    """Per partition value of a folder table: format, rows, and whether it has files and bytes.

    Rows are counted by the partition value alone (no column is read); files come from the listing.
    """
    counted = rows.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("row_count"))
    files = table_detail(spark, path, partition_by).withColumnsRenamed({c: f"_{c}" for c in partition_by})
    same = [counted[c].cast("string").eqNullSafe(files[f"_{c}"]) for c in partition_by]
    return counted.join(files, same).select(*partition_by, "format", "row_count", (F.col("num_files") > 0).alias("has_files"),
                                            (F.col("size_in_bytes") > 0).alias("has_bytes"))


def row_and_column_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.lit(len(df.columns)).alias("column_count"))


def schema_rows(df: DataFrame) -> DataFrame:
    """``(position, column_name, data_type)`` rows of a table's schema."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def sample_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows by an explicit order (a plain limit is not deterministic)."""
    return df.orderBy(*order).limit(n)
