"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Hours, buckets and keys are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Partition counts, broadcast sides and skewed partitions are settled from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A join whose measured build partitions are this small is hashed and needs no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # HotSpot leaves longer methods uncompiled; wide rows run faster outside such a stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_spark(app_name: str = "tallyward", shuffle_partitions: int | None = None) -> SparkSession:
    """Session for a job. Master, memory and storage come from spark-submit and its defaults;
    a run without any master uses the local cores."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        if shuffle_partitions < 1:
            raise ValueError("shuffle_partitions must be >= 1")
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
