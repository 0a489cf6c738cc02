"""A table of a stream's progress, and what became of its input."""

from __future__ import annotations

import logging
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tallyward.streaming.score import QUERY_NAME, Sinks

log = logging.getLogger(__name__)

# One row per micro-batch. dropped_rows were behind the watermark of a stateful operator.
PROGRESS = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("ingest_batch_id", T.LongType()),
    T.StructField("started_at", T.TimestampType()), T.StructField("input_rows", T.LongType()),
    T.StructField("input_rows_per_second", T.DoubleType()), T.StructField("rows_per_second", T.DoubleType()),
    T.StructField("dropped_rows", T.LongType()), T.StructField("durations_ms", T.MapType(T.StringType(), T.LongType()))])


class ProgressTable(StreamingQueryListener):
    """Writes a row for each micro-batch of the query ``name`` that starts next. The row has a folder of its own, written with
    overwrite, so a micro-batch that is done again after a failure replaces its row. A row that cannot be written
    is logged and does not stop the stream."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.run: str | None = None
        self.over = threading.Event()

    def onQueryStarted(self, event) -> None:
        if self.run is None and event.name == self.name:
            self.run = str(event.id)

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.run:
            try:
                self._write(event.progress)
            except Exception:
                log.exception("progress of micro-batch %s is not recorded", event.progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.run:
            self.over.set()

    def _write(self, p) -> None:
        values = {
            "started_at": F.lit(p.timestamp).cast("timestamp"), "input_rows": F.lit(p.numInputRows).cast("long"),
            "input_rows_per_second": F.lit(p.inputRowsPerSecond).cast("double"),
            "rows_per_second": F.lit(p.processedRowsPerSecond).cast("double"),
            "dropped_rows": F.lit(sum(s.numRowsDroppedByWatermark for s in p.stateOperators)).cast("long"),
            "durations_ms": F.create_map(*[F.lit(v) for kv in p.durationMs.items() for v in kv]).cast("map<string,bigint>")}
        row = self.spark.range(1).coalesce(1).select(*[v.alias(k) for k, v in values.items()])
        row.write.mode("overwrite").parquet(f"{self.path}/run={self.run}/ingest_batch_id={p.batchId}")


@contextmanager
def recorded_progress(spark: SparkSession, path: str, name: str = QUERY_NAME, wait_seconds: float = 60.0) -> Iterator[ProgressTable]:
    """Record the query ``name`` that is started inside. Reports come after the fact, so at the end those of a query that has
    stopped are waited for."""
    table = ProgressTable(spark, path, name)
    spark.streams.addListener(table)
    try:
        yield table
    finally:
        if table.run is not None and all(str(q.id) != table.run for q in spark.streams.active):
            table.over.wait(wait_seconds)
        spark.streams.removeListener(table)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The recorded micro-batches; none where nothing was recorded yet."""
    try:
        return spark.read.schema(PROGRESS).parquet(path).select(*PROGRESS.fieldNames())
    except AnalysisException:
        return spark.createDataFrame([], PROGRESS)


def accounted(progress: DataFrame, sinks: Sinks) -> DataFrame:
    """For each recorded micro-batch, where its input went: rows in bronze, set aside as undecodable or as late, left out as
    repeats, in silver, and ``missing_rows``, which is 0 if the tables hold all of it. Only footers of the tables are read."""
    spark, batch = progress.sparkSession, ["run", "ingest_batch_id"]
    keys = T.StructType([f for f in PROGRESS.fields if f.name in batch])

    def stored(name: str, path: str | None) -> DataFrame:
        try:
            rows = spark.read.schema(keys).parquet(path) if path else spark.createDataFrame([], keys)
        except AnalysisException:  # nothing was written there yet
            rows = spark.createDataFrame([], keys)
        return rows.groupBy(*batch).agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(name))

    tables = {"bronze_rows": sinks.bronze, "silver_rows": sinks.silver, "undecodable_rows": sinks.quarantine, "late_rows": sinks.late}
    counts = reduce(DataFrame.unionByName, [stored(name, path) for name, path in tables.items()])
    by_table = counts.groupBy(*batch).agg(*[
        F.coalesce(F.sum(F.when(F.col("table_name") == name, F.col("n"))), F.lit(0)).alias(name) for name in tables])
    held = progress.join(by_table, batch, "left").na.fill(0, list(tables))
    return held.withColumns({
        "repeated_rows": F.col("bronze_rows") - F.col("silver_rows"),
        "missing_rows": F.col("input_rows") - F.col("bronze_rows") - F.col("undecodable_rows") - F.col("late_rows")})
