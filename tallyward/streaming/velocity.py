"""Event-time velocity and deduplication on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions import coercion as C
from tallyward.operators.scoring import VELOCITY_SECONDS, time_slot
from tallyward.schemas import SOURCE_ID

# Copies of each per-account count, over which a hot account's rows are spread.
SALTS = 4


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Start a stateful stream inside this block to give its state one partition per core, or
    ``partitions``. A stream keeps the number it starts with, so the general shuffle setting,
    which adaptive execution trims for batches, would stay with it as many small stores."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(partitions or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stream_dedup(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One row per source message while its repeats arrive within ``delay``."""
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(SOURCE_ID)


def stream_velocity(
    events: DataFrame, seconds: int = VELOCITY_SECONDS, delay: str = "10 minutes", salts: int = SALTS, watermarked: bool = False,
) -> DataFrame:
    """Add ``velocity_5min`` once the watermark has passed the end of a row's bucket.

    The value is that of the batch operator, however the stream was cut into batches. Rows
    later than ``delay`` are dropped and counted in the query progress as
    ``numRowsDroppedByWatermark``; use micro-batch velocity to alert at once. Counts are
    combined map-side, and the join back is keyed by account, bucket and salt. Null accounts
    count as one account named ``UNKNOWN``, as in the batch operator. ``watermarked`` tells
    that ``events`` carry a watermark already, as after ``stream_dedup``; it stays the only one.
    """
    marked = events if watermarked else events.withWatermark("event_ts", delay)
    account = F.coalesce(F.col("nameOrig"), F.lit(C.UNKNOWN))
    counts = (
        marked.groupBy(F.window("event_ts", f"{seconds} seconds").alias("w"), account.alias("_account"))
        .agg(F.count(F.lit(1)).cast("double").alias("velocity_5min"))
        .select(
            "_account",
            F.col("w.start").alias("_start"),
            F.col("w.end").alias("_end"),
            "velocity_5min",
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_copy"),
        )
    )
    rows = marked.withColumns({
        "_slot": time_slot(F.col("event_ts"), seconds),
        "_salt": F.pmod(F.xxhash64(*[F.col(c) for c in SOURCE_ID]), F.lit(salts)).cast("int"),
    })
    same_bucket = (
        (account == F.col("_account"))
        & (F.col("_slot") == time_slot(F.col("_start"), seconds))
        & (F.col("_salt") == F.col("_copy"))
    )
    # The range lets Spark drop join state behind the watermark.
    in_range = (F.col("event_ts") >= F.col("_start")) & (F.col("event_ts") < F.col("_end"))
    return rows.join(counts, same_bucket & in_range).select(*events.columns, "velocity_5min")

