from __future__ import annotations

import glob
import json
import os
from dataclasses import replace

import pytest
from frames import at, scored
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallyward.plans import fixture
from tallyward.schemas import MESSAGE, SILVER, SOURCE_ID
from tallyward.sources import events, lake
from tallyward.streaming.metrics import PROGRESS, accounted, read_progress, recorded_progress
from tallyward.streaming.score import Settings, Sinks, progress_metrics, score_stream
from tallyward.streaming.velocity import stream_dedup, stream_velocity


def sinks_at(path, events_path=True):
    return Sinks(*[f"{path}/{n}" for n in ["bronze", "silver", "gold", "quarantine", "checkpoint"]],
                 events=f"{path}/events" if events_path else None)


def run(spark, path, settings, per_trigger=1, scorer=fixture.surrogate_score):
    stream = events.read_events(spark, "json", events.pacing_options("json", per_trigger), f"{path}/in")
    query = score_stream(stream, scorer, sinks_at(path), settings)
    query.awaitTermination()
    return query


def feed(spark, sf, path, files=4):
    """One file per remainder of the offset, so that every velocity bucket is cut into as many pieces."""
    rows = fixture.messages(spark, sf)
    for i in range(files):
        rows.where(F.col("offset").cast("int") % files == i).coalesce(1).write.mode("append").json(f"{path}/in")


def silver_rows(spark, path):
    return lake.read_silver(spark, f"{path}/silver").select(*SILVER.fieldNames())


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def expected(spark, sf):
    from tallyward.operators.envelope import decode_envelopes
    from tallyward.operators.scoring import coerce
    from tallyward.streaming.score import score_rows

    valid, _ = decode_envelopes(fixture.messages(spark, sf))
    typed = coerce(valid, fixture.AS_OF)
    return score_rows(typed, fixture.surrogate_score, Settings()).select(*SILVER.fieldNames())


def test_stream_over_several_batches_equals_the_batch_operators(spark, sf, path):
    feed(spark, sf, path)
    timings = []
    query = run(spark, path, Settings(available_now=True, as_of=fixture.AS_OF, on_batch=timings.append))
    assert len(timings) == 4 and all("silver_seconds" in t for t in timings)
    progress = progress_metrics(query)
    assert sum(p["input_rows"] for p in progress) == 1000 and "duration_ms" in progress[0]
    silver = silver_rows(spark, path)
    same(silver, expected(spark, sf))
    # As written, an alert has the velocity of its moment.
    gold = lake.read_alerts(spark, f"{path}/gold")
    same(gold.drop("velocity_5min"), silver.where("is_alert").drop("velocity_5min"))
    assert gold.where("rule_high_velocity and not rule_high_score and not rule_high_amount_transfer").count() > 0
    bronze = spark.read.parquet(f"{path}/bronze")
    assert bronze.count() == silver.count() == 985 and len(bronze.drop("run", "ingest_batch_id").columns) == 15
    assert spark.read.parquet(f"{path}/quarantine").count() == 15
    published = [json.loads(r["value"]) for r in spark.read.option("recursiveFileLookup", "true").text(f"{path}/events").collect()]
    assert len(published) == silver.where("is_alert").count()
    assert len({p["event_id"] for p in published}) == len(published)


@pytest.mark.parametrize("sink", ["silver", "bronze", "gold", "events"])
def test_a_batch_that_fails_after_a_sink_is_written_once(spark, sf, path, monkeypatch, sink):
    """The second batch breaks off right after one of its sinks and is then repeated."""
    import tallyward.streaming.score as module

    feed(spark, sf, path, files=2)
    settings = Settings(available_now=True, as_of=fixture.AS_OF)
    real, real_events, calls = module.compact, module._write_events, []

    def compact(df, files):
        # Per batch: silver, bronze, gold. The write after the chosen sink fails once.
        calls.append(1)
        if len(calls) == 3 + {"silver": 2, "bronze": 3}.get(sink, 99):
            raise RuntimeError("lost")
        return real(df, files)

    def write_events(alerts, sinks, at):
        if sink == "gold" and at.endswith("=1"):
            raise RuntimeError("lost")
        real_events(alerts, sinks, at)
        if sink == "events" and at.endswith("=1"):
            raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(module, "compact", compact)
        broken.setattr(module, "_write_events", write_events)
        with pytest.raises(StreamingQueryException):
            run(spark, path, settings)
    run(spark, path, settings)
    silver = silver_rows(spark, path)
    assert silver.count() == 985 and silver.select(*SOURCE_ID).distinct().count() == 985
    assert spark.read.parquet(f"{path}/bronze").count() == 985
    alerts = silver.where("is_alert").count()
    assert lake.read_alerts(spark, f"{path}/gold").count() == alerts
    assert spark.read.option("recursiveFileLookup", "true").text(f"{path}/events").count() == alerts
    assert len({os.path.basename(p) for p in glob.glob(f"{path}/silver/*/run=*")}) == 1


def message(offset, at_second, account="C1", amount=5, kind="PAYMENT", stamp="2024-01-01 00:00:00"):
    body = {"type": kind, "amount": str(amount), "nameOrig": account}
    if at_second is not None:
        body["event_emitted_at_utc"] = at(at_second).isoformat()
    return json.dumps({"payload": body}), "t", "0", None if offset is None else str(offset), stamp


def turns(spark, path, *deliveries, **settings):
    """Each delivery as one micro-batch; the timings of each."""
    for rows in deliveries:
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").json(f"{path}/in")
    seen = []
    stream = events.read_events(spark, "json", events.pacing_options("json", 1), f"{path}/in")
    sinks = replace(sinks_at(path), late=f"{path}/late")
    score_stream(stream, fixture.surrogate_score, sinks,
                 Settings(available_now=True, as_of=at(5000), on_batch=seen.append, **settings)).awaitTermination()
    return seen


def published(spark, path):
    return sorted(json.loads(r["value"])["payload"]["source_offset"]
                  for r in spark.read.option("recursiveFileLookup", "true").text(f"{path}/events").collect())


def test_earlier_rows_alert_once_their_account_reaches_the_threshold(spark, path):
    first = [message(i, 10 * i) for i in range(3)] + [message(3, 40, amount=250_000, kind="TRANSFER")]
    second = [message(4, 299), message(5, 300)]
    third = [message(6, 200), message(7, 201)]
    turns(spark, path, first)
    assert published(spark, path) == ["3"]
    turns(spark, path, second)
    # The fifth row of the first bucket: all four before it are due now; the one that was an alert is not published again.
    assert published(spark, path) == ["0", "1", "2", "3", "4"]
    turns(spark, path, third)
    assert published(spark, path) == ["0", "1", "2", "3", "4", "6", "7"]
    gold = {r["source_offset"]: r for r in lake.read_alerts(spark, f"{path}/gold").collect()}
    assert set(gold) == {"0", "1", "2", "3", "4", "6", "7"} and all(r["rule_high_velocity"] for r in gold.values())
    assert gold["3"]["rule_high_amount_transfer"] and gold["0"]["velocity_5min"] == 5 and gold["6"]["velocity_5min"] == 7
    silver = {r["source_offset"]: r["velocity_5min"] for r in silver_rows(spark, path).collect()}
    assert silver == {**{str(i): 7.0 for i in (0, 1, 2, 3, 4, 6, 7)}, "5": 1.0}


def test_repeats_of_other_micro_batches_are_left_out(spark, path):
    # A message without an event time is stamped when it is read; one without an offset has no identity.
    first = [message(1, 10), message(1, 10, stamp="2024-01-01 00:00:01"), message(2, None), message(None, 20)]
    turns(spark, path, first, [message(1, 10, stamp="2024-01-01 00:01:00"), message(2, None), message(None, 20), message(3, 30)])
    rows = silver_rows(spark, path).collect()
    assert sorted((r["source_offset"] or "", r["kafka_ingest_ts"]) for r in rows) == [
        ("", "2024-01-01 00:00:00"), ("", "2024-01-01 00:00:00"), *((str(i), "2024-01-01 00:00:00") for i in (1, 2, 3))]
    assert {r["velocity_5min"] for r in rows if r["source_offset"] != "2"} == {4.0}
    # Bronze has every delivery.
    assert spark.read.parquet(f"{path}/bronze").count() == 8


def test_an_untimed_repeat_is_found_in_the_buckets_before(spark, path):
    turns(spark, path, [message(2, None)])
    stream = events.read_events(spark, "json", events.pacing_options("json", 1), f"{path}/in")
    spark.createDataFrame([message(2, None), message(3, None)], MESSAGE).coalesce(1).write.mode("append").json(f"{path}/in")
    score_stream(stream, fixture.surrogate_score, sinks_at(path), Settings(available_now=True, as_of=at(7000))).awaitTermination()
    assert sorted(r["source_offset"] for r in silver_rows(spark, path).collect()) == ["2", "3"]


def test_rows_behind_the_watermark_go_to_the_late_table(spark, path):
    late = [message(10, 5), message(11, 299), message(12, 300), message(13, None), message(14, 2000)]
    turns(spark, path, [message(0, 0)], [message(1, 1200)], late, late_seconds=900)
    # 1200 - 900 closes the first bucket and no other. Untimed rows are never late.
    aside = spark.read.parquet(f"{path}/late")
    assert sorted(r["source_offset"] for r in aside.collect()) == ["10", "11"]
    assert sorted(r["source_offset"] for r in silver_rows(spark, path).collect()) == ["0", "1", "12", "13", "14"]


def test_without_a_limit_no_row_is_late(spark, path):
    turns(spark, path, [message(0, 0)], [message(1, 90_000)], [message(2, 1)])
    assert {r["source_offset"]: r["velocity_5min"] for r in silver_rows(spark, path).collect()} == {"0": 2.0, "1": 1.0, "2": 2.0}
    assert not os.path.exists(f"{path}/late")


def test_an_hour_of_silver_reads_its_own_folders(spark, sf, path):
    feed(spark, sf, path, files=2)
    run(spark, path, Settings(available_now=True, as_of=fixture.AS_OF))
    hour = lake.read_silver(spark, f"{path}/silver", "2024-01-01-05")
    same(hour.select(*SILVER.fieldNames()), silver_rows(spark, path).where("event_ts >= '2024-01-01 05:00:00' and event_ts < '2024-01-01 06:00:00'"))
    scans = hour._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1:]
    assert scans and all("event_hour" in scan.split("]")[0] for scan in scans)
    from tallyward.plans import jobs

    labels = fixture.labels(spark, sf)
    counts = jobs.hourly_from_lake(spark, f"{path}/silver", labels, f"{path}/hourly", "2024-01-01-05", fixture.AS_OF)
    assert counts["curated_rows"] == hour.count() > 0


def test_gold_stays_unwritten_without_alerts_and_files_are_bounded(spark, path):
    body = '{"payload":{"step":"1","type":"PAYMENT","amount":"5","nameOrig":"C%d"}}'
    spark.createDataFrame([(body % i, "t", "0", str(i), "") for i in range(50)], MESSAGE).repartition(8).write.json(f"{path}/in")
    run(spark, path, Settings(available_now=True, files_per_batch=1, as_of=at(0)), per_trigger=100)
    assert not os.path.exists(f"{path}/gold")
    assert len(glob.glob(f"{path}/silver/*/*/*/*.parquet")) == 1 and silver_rows(spark, path).count() == 50


def test_a_bad_message_can_stop_the_stream(spark, path):
    spark.createDataFrame([("junk", "t", "0", "1", "")], MESSAGE).write.json(f"{path}/in")
    with pytest.raises(StreamingQueryException):
        run(spark, path, Settings(available_now=True, fail_on_bad_message=True))


def test_thresholds_are_settings(spark, path):
    body = '{"payload":{"type":"TRANSFER","amount":"100","nameOrig":"C1"}}'
    spark.createDataFrame([(body, "t", "0", "1", "")], MESSAGE).write.json(f"{path}/in")
    run(spark, path, Settings(available_now=True, amount_threshold=100.0, as_of=at(0)))
    row = silver_rows(spark, path).first()
    assert row["rule_high_amount_transfer"] and not row["rule_high_score"] and row["is_alert"]


def drain(stream, path):
    (stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/cp")
     .trigger(availableNow=True).start(f"{path}/out").awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out").where("source_offset <> '-1'")


def in_order(spark, rows, path, files):
    """Files in event order with a far-future row last, read one per micro-batch."""
    last = rows.limit(1).withColumns({"source_offset": F.lit("-1"), "event_ts": F.lit(at(3e8))})
    ranked = rows.withColumn("part", F.floor((F.unix_timestamp("event_ts") - 1704067200) * files / 43200))
    parts = [ranked.where(F.col("part") == i).drop("part") for i in range(files)] + [last]
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{path}/in")
        for f in glob.glob(f"{path}/in/*.parquet"):
            if not f.startswith(f"{path}/in/seen"):
                os.utime(f, (1_700_000_000 + i * 60,) * 2) if os.path.getmtime(f) > 1_710_000_000 else None
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def test_event_time_velocity_does_not_depend_on_batches(spark, sf, path):
    rows = fixture.transactions(spark, sf).select(*SOURCE_ID, "event_ts", "nameOrig", "amount")
    rows = rows.withColumn("nameOrig", F.when(F.col("source_offset").cast("long") % 10 != 0, F.col("nameOrig")))
    assert rows.where("nameOrig IS NULL").count() > 50
    out = drain(stream_velocity(in_order(spark, rows, path, 3)), path)
    from tallyward.operators.scoring import add_velocity

    same(out, add_velocity(rows).where("source_offset <> '-1'"))


def test_state_partitions_hold_for_the_stream_only(spark, path):
    from tallyward.streaming.velocity import state_partitions

    rows = scored(spark, {}, {"source_offset": "2"}).select(*SOURCE_ID, "event_ts")
    rows.write.parquet(f"{path}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_partitions(spark, 3):
        query = (stream_dedup(spark.readStream.schema(rows.schema).parquet(f"{path}/in")).writeStream.format("parquet")
                 .option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start(f"{path}/out"))
    query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3


def test_dedup_then_velocity_on_one_watermark(spark, sf, path):
    base = fixture.transactions(spark, sf).select(*SOURCE_ID, "event_ts", "nameOrig", "amount", "kafka_ingest_ts")
    rows = fixture.with_duplicates(base).drop("kafka_ingest_ts")
    out = drain(stream_velocity(stream_dedup(in_order(spark, rows, path, 2)), watermarked=True), path)
    from tallyward.operators.scoring import add_velocity

    same(out, add_velocity(base.drop("kafka_ingest_ts")))


def test_model_scores_inside_the_stream(spark, sf, path):
    from tallyward.operators.model import train_baseline

    model = train_baseline(fixture.transactions(spark, sf), trees=3, depth=3).model
    feed(spark, sf, path, files=1)
    run(spark, path, Settings(available_now=True, as_of=fixture.AS_OF), scorer=model)
    silver = silver_rows(spark, path)
    assert silver.count() == 985 and silver.where("fraud_score between 0 and 1").count() == 985
    assert scored(spark, {}).schema == silver.schema


def test_progress_is_recorded_once_per_micro_batch(spark, sf, path):
    import time

    feed(spark, sf, path, files=2)
    found = []
    for _ in range(2):  # the second time over nothing new
        with recorded_progress(spark, f"{path}/progress") as table:
            query = run(spark, path, Settings(available_now=True, as_of=fixture.AS_OF))
            found += query.recentProgress
            stopped = time.monotonic()
        assert time.monotonic() - stopped < 30 and table.over.is_set()
    progress = read_progress(spark, f"{path}/progress")
    rows = accounted(progress, sinks_at(path)).orderBy("ingest_batch_id").collect()
    assert [r["ingest_batch_id"] for r in rows] == [0, 1] and {r["run"] for r in rows} == {str(query.id)}
    assert sum(r["input_rows"] for r in rows) == 1000 and all(r["missing_rows"] == 0 for r in rows)
    assert all(r["undecodable_rows"] > 0 and r["durations_ms"]["triggerExecution"] > 0 and r["rows_per_second"] > 0 for r in rows)
    # A micro-batch that is done again replaces its row.
    table._write(next(p for p in found if p.batchId == 1 and p.numInputRows))
    assert read_progress(spark, f"{path}/progress").count() == 2


def test_progress_of_other_streams_is_not_recorded_and_lost_rows_show(spark, path):
    scored(spark, {}).select(*SOURCE_ID, "event_ts").write.parquet(f"{path}/in")
    with recorded_progress(spark, f"{path}/progress", "watched", wait_seconds=5) as table:
        stream = spark.readStream.schema("source_topic string").parquet(f"{path}/in")
        stream.writeStream.format("noop").option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert table.run is None and read_progress(spark, f"{path}/progress").count() == 0
    lost = spark.createDataFrame([("r", 0, None, 7, 1.0, 1.0, 0, {})], PROGRESS)
    assert accounted(lost, sinks_at(path)).first()["missing_rows"] == 7
