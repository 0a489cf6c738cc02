"""Batch readers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators.reconcile import filter_hour, parse_hour
from tallyward.operators.scoring import VELOCITY_SECONDS, VELOCITY_THRESHOLD, add_velocity, apply_velocity_rule, coerce_keys
from tallyward.schemas import CURATED, JOIN_KEYS, LABELLED_CSV, MODEL_INPUT, SILVER, SILVER_FOLDERS, SOURCE_ID

FORMATS = ["parquet", "json", "csv"]


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
              **options: str) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format {fmt!r}; choose one of {FORMATS}")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_labels(spark: SparkSession, path: str, coerce_labels: bool = True) -> DataFrame:
    """Business key and label from a labelled CSV. Coercion as on the scored side makes
    blank fields match there; without it they stay null and match nothing."""
    raw = spark.read.schema(LABELLED_CSV).option("header", True).csv(path)
    label = F.col("isFraud").try_cast("double").alias("isFraud")
    if coerce_labels:
        return coerce_keys(raw).select(*JOIN_KEYS, label)
    types = {f.name: f.dataType for f in CURATED.fields}
    return raw.select(*[F.col(c).try_cast(types[c]).alias(c) for c in JOIN_KEYS], label)


def read_silver(
    spark: SparkSession, path: str, hour: str | None = None,
    velocity_seconds: int = VELOCITY_SECONDS, velocity_threshold: float = VELOCITY_THRESHOLD,
) -> DataFrame:
    """Scored rows with ``event_ts`` as a timestamp, whichever columns the lake holds.

    Rows that the scoring stream wrote carry the velocity known when they arrived. Here they get that of
    all rows stored since, and the alert flags that follow from it; velocity counts within a run of the stream.
    With ``hour``, only the folders of that hour and, for buckets across its borders, of its neighbours are read.
    """
    silver = spark.read.parquet(path)
    if "event_ts" in silver.columns and not isinstance(silver.schema["event_ts"].dataType, T.TimestampType):
        silver = silver.withColumn("event_ts", F.col("event_ts").try_cast("timestamp"))
    if not set(SILVER_FOLDERS) <= set(silver.columns):
        return filter_hour(silver, hour).drop("run", "ingest_batch_id")
    if hour:
        near = [parse_hour(hour) + timedelta(hours=h) for h in (-1, 0, 1)]
        silver = silver.where(F.col("event_hour").isin([int(f"{h:%Y%m%d%H}") for h in near]))
    settled = apply_velocity_rule(
        add_velocity(silver.drop("velocity_5min"), velocity_seconds, by=["run"]), velocity_threshold)
    return filter_hour(settled, hour).select(*[c for c in silver.columns if c not in [*SILVER_FOLDERS, "slot"]])


def stored_hours(spark: SparkSession, path: str, hours: Iterable[int], run: str) -> DataFrame | None:
    """Silver rows of one run in the folders of some hours; None where there are none yet. Only these folders are
    listed, so the cost does not grow with the table's age."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    paths = [f"{path}/event_hour={hour}/run={run}" for hour in hours]
    there = [p for p in paths if hadoop(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop(p))]
    if not there:
        return None
    schema = T.StructType([*SILVER.fields, T.StructField("slot", T.LongType()), T.StructField("event_hour", T.LongType()),
                           T.StructField("run", T.StringType()), T.StructField("ingest_batch_id", T.LongType())])
    return spark.read.schema(schema).option("basePath", path).parquet(*there)


def stored_periods(spark: SparkSession, path: str, by: str) -> list[datetime]:
    """The values of the time column ``by`` that a table is partitioned by, from the names of its folders."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop):
        return []
    names = [unquote(s.getPath().getName()) for s in files.listStatus(hadoop) if s.isDirectory()]
    values = [n.removeprefix(f"{by}=") for n in names if n.startswith(f"{by}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]
    return [datetime.fromisoformat(v).replace(tzinfo=timezone.utc) for v in values]


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alert rows, each in its last version: velocity can put a flag on a row that was written before. The schema is
    given because the path stays empty until the first alert."""
    schema = T.StructType(SILVER.fields + [T.StructField("run", T.StringType()), T.StructField("ingest_batch_id", T.LongType())])
    # Without alerts there are no folders to take the partition columns from.
    try:
        written = spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], SILVER)
    identified = F.lit(True)
    for c in SOURCE_ID:
        identified = identified & F.col(c).isNotNull()
    key = ["run", *SOURCE_ID]
    last = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("ingest_batch_id")))
    latest = written.where(identified).withColumn("_last", last).where("_last = 1").drop("_last")
    return latest.unionByName(written.where(~identified)).select(*SILVER.fieldNames())


def read_retraining(spark: SparkSession, table_or_path: str) -> DataFrame:
    """Labelled rows typed for training, from a table name or a Parquet path. The stored
    split comes along where there is one."""
    is_path = "/" in table_or_path
    source = spark.read.parquet(table_or_path) if is_path else spark.table(table_or_path)
    extra = [c for c in ["dataset_split"] if c in source.columns]
    typed = source.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in MODEL_INPUT.fields], *extra)
    return typed.where(F.col("isFraud").isNotNull())


def read_table_layout(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A lake table stored by hour partition, in nested folders or flat."""
    path = f"{base.rstrip('/')}/{table}"
    try:
        return spark.read.parquet(path)
    except AnalysisException as partitioned:
        try:
            return spark.read.option("recursiveFileLookup", "true").parquet(path)
        except AnalysisException:
            raise ValueError(f"No parquet files found for table {table!r} under {path}") from partitioned
