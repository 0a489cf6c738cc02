"""Batch writers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators.reconcile import STORED_KEYS, stored_keys
from tallyward.schemas import HOUR

# The accepted dispositions and the write mode each stands for.
DISPOSITIONS = {
    "WRITE_TRUNCATE": "overwrite",
    "WRITE_APPEND": "append",
    "WRITE_EMPTY": "errorifexists",
}
# Buckets of a label table: a power of two near its size in units of 128 MB, a few years ahead.
LABEL_BUCKETS = 512
# Where the labels are counted first, a bucket gets at most this many of them, and there are at least so many buckets.
LABELS_A_BUCKET, LEAST_BUCKETS = 100_000, 8
_LISTED = "spark.sql.hive.manageFilesourcePartitions"


def compact(df: DataFrame, files: int | None = None, *by: str) -> DataFrame:
    """Fewer output files. With ``files``, at most that many (per folder); otherwise Spark brings rows together by ``by``,
    merges small partitions and cuts large ones to its advisory size."""
    if files is None:
        return df.hint("rebalance", *map(F.col, by))
    if files < 1:
        raise ValueError("files must be >= 1")
    return df.coalesce(files)


def clear_hours(spark: SparkSession, path: str, hours: list[datetime], schema: T.StructType, by: str = HOUR) -> None:
    """Empty the partitions of ``hours``, which a run has processed without any output for them."""
    empty = spark.createDataFrame([], schema).drop(by)
    for hour in hours:
        folder = f"{by}={hour:%Y-%m-%d %H:%M:%S}".replace(":", "%3A")
        empty.write.mode("overwrite").parquet(f"{path}/{folder}")


def write_hourly(df: DataFrame, path: str, by: str = HOUR) -> None:
    """Replace only the hours present in ``df``. Rows are brought together by hour, and a
    large hour is written by several tasks."""
    (df.hint("rebalance", F.col(by)).write.partitionBy(by).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def ensure_database(spark: SparkSession, name: str, create: bool = True, location: str | None = None) -> None:
    if spark.catalog.databaseExists(name):
        return
    if not create:
        raise ValueError(f"Database not found: {name}")
    at = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{at}")


def clean_table_names(tables: Iterable[str]) -> list[str]:
    names = list(dict.fromkeys(t.strip() for t in tables if t.strip()))
    if not names:
        raise ValueError("Name at least one table to load.")
    return names


def _create_table(spark: SparkSession, df: DataFrame, table: str, location: str, partition_by: str | None) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    cut = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    # Partitions are found in the folder and not listed in the catalog, so that one change of the location replaces all.
    before = spark.conf.get(_LISTED)
    spark.conf.set(_LISTED, "false")
    try:
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{cut} LOCATION '{location}'")
    finally:
        spark.conf.set(_LISTED, before)


def label_buckets(rows: int) -> int:
    """Buckets of a table for ``rows`` labels: a power of two that grows with them, so that a task's share does not."""
    return max(LEAST_BUCKETS, 1 << max(0, -(-rows // LABELS_A_BUCKET) - 1).bit_length())


def store_labels(labels: DataFrame, table: str, buckets: int = LABEL_BUCKETS) -> None:
    """Add labels (business key, ``isFraud``) to a table in buckets of the key, sorted by ``step`` so that Parquet skips other
    steps. The table is made if it is missing; repeats and conflicts are left to ``dedup_labels``. The number of
    buckets is that of the first call; another one is refused by Spark."""
    # One task per bucket, so that a load adds one file to each.
    rows = labels.withColumns(stored_keys()).select(*STORED_KEYS, "isFraud").repartition(buckets, *STORED_KEYS)
    rows.write.mode("append").format("parquet").bucketBy(buckets, *STORED_KEYS).sortBy("step").saveAsTable(table)


def table_location(spark: SparkSession, table: str) -> str:
    """The folder that a table's rows are in now."""
    return next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location")


def load_table(
    df: DataFrame, table: str, disposition: str = "WRITE_TRUNCATE", partition_by: str | None = None,
) -> None:
    """Save ``df`` as a warehouse table, replacing, extending or only creating it.

    Rows of a replacement are written to a folder of their own under that of the database; then one change of the catalog
    points the table there. Readers see the old rows or the new ones, and a load that fails while it writes leaves the old
    ones. Only a replacement with other columns drops the table and creates it again. Folders of earlier loads stay, for
    queries that still read them, until the user removes them; ``table_location`` tells the one in use.
    """
    if disposition not in DISPOSITIONS:
        raise ValueError(f"Unknown disposition {disposition!r}; choose one of {sorted(DISPOSITIONS)}")
    spark = df.sparkSession
    there = spark.catalog.tableExists(table)
    if there and disposition != "WRITE_TRUNCATE":
        writer = df.write.mode(DISPOSITIONS[disposition]).format("parquet")
        (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(table)
        return
    database, _, name = table.rpartition(".")
    root = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    staged = f"{root.rstrip('/')}/{name}_loads/{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(staged)
    held = {f.name: f.dataType for f in spark.table(table).schema.fields} if there else None
    cut = [c.name for c in spark.catalog.listColumns(table) if c.isPartition] if there else []
    if held == {f.name: f.dataType for f in df.schema.fields} and cut == ([partition_by] if partition_by else []):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{staged}'")
        spark.catalog.refreshTable(table)
        return
    if there:
        spark.sql(f"DROP TABLE {table}")
    _create_table(spark, df, table, staged, partition_by)
