"""The message log and the event log: bounds, restarts, failures, repeats."""

from __future__ import annotations

import glob
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallyward.sources.event_log import EventLog, publish, read_event_log
from tallyward.sources.message_log import MessageLogReader, append_segment, read_message_log


def messages(spark, begin, end):
    return spark.range(begin, end, numPartitions=2).select(
        F.col("id").cast("string").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.lit(None).cast("string").alias("timestamp"))


def test_offsets_advance_by_the_limit_and_not_past_the_end(spark, path):
    append_segment(messages(spark, 0, 10), f"{path}/log", 1)
    append_segment(messages(spark, 10, 13).coalesce(1), f"{path}/log", 2)
    reader = MessageLogReader(f"{path}/log", 4, f"{path}/progress")
    at, seen, sizes = reader.initialOffset(), [], []
    while (end := reader.latestOffset()) != at:
        rows = [v for part in reader.partitions(at, end) for batch in reader.read(part) for v in batch.column("value").to_pylist()]
        seen, at = seen + rows, end
        sizes.append(len(rows))
        # As after a restart, with nothing but the progress file.
        reader = MessageLogReader(f"{path}/log", 4, f"{path}/progress")
    assert sizes == [4, 4, 4, 1] and sorted(map(int, seen)) == list(range(13))
    append_segment(messages(spark, 13, 15).coalesce(1), f"{path}/log", 3)
    assert reader.latestOffset() != at
    with pytest.raises(ValueError):
        MessageLogReader("x", 0, "y")


def test_an_unfinished_segment_is_not_read(spark, path):
    append_segment(messages(spark, 0, 3), f"{path}/log", 1)
    reader = MessageLogReader(f"{path}/log", 10, f"{path}/progress")
    before = reader.latestOffset()
    import os

    os.makedirs(f"{path}/log/000000000002")
    os.link(glob.glob(f"{path}/log/000000000001/*.parquet")[0], f"{path}/log/000000000002/part.parquet")
    assert reader.latestOffset() == before
    assert MessageLogReader(f"{path}/nowhere", 10, f"{path}/progress").latestOffset() == reader.initialOffset()


def test_a_stream_that_fails_and_restarts_reads_every_message_once(spark, path):
    append_segment(messages(spark, 0, 50), f"{path}/log", 1)
    failed = []

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")
        if batch_id == 2 and not failed:
            failed.append(1)
            raise RuntimeError("lost")

    def start():
        return (read_message_log(spark, f"{path}/log", f"{path}/progress", 8).writeStream.foreachBatch(write)
                .option("checkpointLocation", f"{path}/cp").trigger(processingTime="0 seconds").start())

    with pytest.raises(StreamingQueryException):
        start().awaitTermination(120)
    query = start()
    query.processAllAvailable()
    append_segment(messages(spark, 50, 60), f"{path}/log", 2)
    query.processAllAvailable()
    query.stop()
    rows = spark.read.parquet(f"{path}/out")
    assert sorted(int(r["value"]) for r in rows.collect()) == list(range(60))
    assert rows.groupBy("batch").count().agg(F.max("count")).first()[0] <= 8


def events(spark, begin, end):
    return spark.range(begin, end, numPartitions=3).select(
        F.col("id").cast("string").alias("key"), F.to_json(F.struct("id")).alias("value"))


def ids(spark, path):
    return sorted(json.loads(r["value"])["id"] for r in read_event_log(spark, path).collect())


def test_a_batch_is_published_once_and_a_failed_one_not_at_all(spark, path):
    assert ids(spark, f"{path}/events") == []
    publish(events(spark, 0, 5), f"{path}/events", "a")
    publish(events(spark, 0, 5), f"{path}/events", "a")
    assert ids(spark, f"{path}/events") == [0, 1, 2, 3, 4]
    # One task fails after others have written.
    broken = events(spark, 5, 9).withColumn("value", F.when(F.col("key") == "8", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        publish(broken, f"{path}/events", "b")
    assert ids(spark, f"{path}/events") == [0, 1, 2, 3, 4]
    publish(events(spark, 5, 9), f"{path}/events", "b")
    assert ids(spark, f"{path}/events") == list(range(9))
    publish(events(spark, 0, 0), f"{path}/events", "c")
    assert ids(spark, f"{path}/events") == list(range(9))


def test_a_stream_into_the_event_log_survives_a_lost_commit(spark, path):
    spark.dataSource.register(EventLog)
    append_segment(messages(spark, 0, 12), f"{path}/log", 1)

    def drain():
        stream = read_message_log(spark, f"{path}/log", f"{path}/progress", 5)
        query = (stream.select(F.col("offset").alias("key"), F.to_json(F.struct(F.col("offset").cast("long").alias("id"))).alias("value"))
                 .writeStream.format("event_log").option("path", f"{path}/events").option("query", "q")
                 .option("checkpointLocation", f"{path}/cp").trigger(processingTime="0 seconds").start())
        query.processAllAvailable()
        query.stop()

    drain()
    assert ids(spark, f"{path}/events") == list(range(12))
    # The stream forgets that its last micro-batch is done and repeats it.
    import os

    last = max(glob.glob(f"{path}/cp/commits/[0-9]*"), key=lambda p: int(p.rsplit("/", 1)[1]))
    os.remove(last)
    for crc in glob.glob(f"{path}/cp/commits/.*crc"):
        if last.rsplit("/", 1)[1] in crc:
            os.remove(crc)
    drain()
    assert ids(spark, f"{path}/events") == list(range(12))
