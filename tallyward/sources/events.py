"""Streaming source of event messages, and its pacing."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyward.schemas import MESSAGE

# Fixed value: default pause between triggers of the scoring stream.
IDLE_SECONDS = 10
FILE_FORMATS = ["parquet", "json", "orc", "csv"]


def read_events(
    spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
    path: str | None = None, schema: T.StructType = MESSAGE,
) -> DataFrame:
    """Messages as a stream: ``value``, ``topic``, ``partition``, ``offset``, ``timestamp``.
    File formats take a path; brokers such as Kafka take their own options."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt in FILE_FORMATS:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def pacing_options(fmt: str, per_trigger: int | None = None, starting_offsets: str | None = None) -> dict[str, str]:
    """How much one trigger reads: files from a file source, messages from a broker."""
    options: dict[str, str] = {}
    if fmt in FILE_FORMATS:
        if per_trigger is not None:
            options["maxFilesPerTrigger"] = str(per_trigger)
    else:
        if per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(per_trigger)
        if starting_offsets:
            options["startingOffsets"] = starting_offsets
    return options


def trigger(seconds: int = IDLE_SECONDS, available_now: bool = False) -> dict[str, Any]:
    return {"availableNow": True} if available_now else {"processingTime": f"{max(seconds, 1)} seconds"}
