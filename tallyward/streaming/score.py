"""The scoring stream: messages in, bronze / silver / gold tables and alert events out."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyward.functions.coercion import UNKNOWN
from tallyward.operators import scoring
from tallyward.operators.envelope import encode_envelopes, parse_messages
from tallyward.operators.model import score
from tallyward.operators.reconcile import keep_first, lacks_event_time
from tallyward.schemas import BRONZE, SILVER, SILVER_FOLDERS, SOURCE_ID
from tallyward.sources.event_log import publish
from tallyward.sources.events import IDLE_SECONDS, trigger
from tallyward.sources.lake import stored_hours
from tallyward.sources.sinks import compact

log = logging.getLogger(__name__)

Scorer = Callable[[DataFrame], DataFrame]
QUERY_NAME = "score_stream"


@dataclass(frozen=True)
class Sinks:
    """Paths of the tables. ``late`` takes rows that come too late, where ``Settings.late_seconds`` is set. ``events_format`` is ``text`` for files under ``events``,
    ``event_log`` for a log there that shows each micro-batch's events at once, or a broker format such as ``kafka``, whose options then name the topic."""

    bronze: str
    silver: str
    gold: str
    quarantine: str
    checkpoint: str
    events: str | None = None
    late: str | None = None
    events_format: str = "text"
    events_options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Settings:
    score_threshold: float = scoring.SCORE_THRESHOLD
    amount_threshold: float = scoring.AMOUNT_THRESHOLD
    velocity_threshold: float = scoring.VELOCITY_THRESHOLD
    velocity_seconds: int = scoring.VELOCITY_SECONDS
    # At most this many files per table and micro-batch; None lets Spark choose by size.
    files_per_batch: int | None = None
    trigger_seconds: int = IDLE_SECONDS
    available_now: bool = False
    # True stops the stream at an undecodable message; False sets it aside and goes on.
    fail_on_bad_message: bool = False
    as_of: datetime | Column | None = None
    # A message that was delivered before is left out. One without an event time is stamped when it is read, so its
    # first delivery is looked for in the buckets of this many seconds before.
    untimed_seconds: int = 3600
    # Rows whose bucket ended this long before the latest event time of earlier micro-batches go to ``Sinks.late``.
    # None takes every row into silver: a late one costs a look at the folders of its own bucket.
    late_seconds: int | None = None
    # Called with the timings of each finished micro-batch.
    on_batch: Callable[[dict[str, Any]], None] | None = None


def score_rows(
    rows: DataFrame, model: PipelineModel | Scorer, settings: Settings, earlier: DataFrame | None = None,
) -> DataFrame:
    """Features, score and rules over typed rows: the batch form of the stream. Rows of ``earlier`` count for velocity."""
    featured = scoring.engineer(rows, settings.velocity_seconds, earlier)
    scored = model(featured) if callable(model) and not isinstance(model, PipelineModel) else score(featured, model)
    return scoring.apply_rules(
        scored, settings.score_threshold, settings.amount_threshold, settings.velocity_threshold)


def _identified() -> Column:
    known = F.lit(True)
    for c in SOURCE_ID:
        known = known & F.col(c).isNotNull()
    return known


def new_messages(rows: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """One row per message, the first by ingest time, and none that ``earlier`` holds. Rows without a whole identity all stay."""
    known, unknown = rows.where(_identified()), rows.where(~_identified())
    fresh = keep_first(known, SOURCE_ID, ["kafka_ingest_ts"])
    if earlier is not None:
        fresh = fresh.join(earlier.select(*SOURCE_ID), SOURCE_ID, "left_anti")
    return fresh.select(*rows.columns).unionByName(unknown)


def accounts_now_due(fresh: DataFrame, earlier: DataFrame | None, settings: Settings) -> DataFrame:
    """Accounts and buckets that reach the velocity threshold by the rows of ``fresh``, with all rows they have then. Without
    ``earlier``, all rows of an account and bucket are as many as the velocity that the rows of ``fresh`` carry says."""
    def counted(rows: DataFrame, name: str) -> DataFrame:
        account = F.coalesce("nameOrig", F.lit(UNKNOWN)).alias("_account")
        all_rows = [] if earlier is not None else [F.max("velocity_5min").alias("_all")]
        return rows.groupBy(account, "slot").agg(F.count(F.lit(1)).alias(name), *all_rows)

    if earlier is None:
        found = counted(fresh, "_now").withColumn("_before", F.col("_all") - F.col("_now")).where("_before > 0")
    else:
        found = counted(earlier, "_before").join(counted(fresh, "_now"), ["_account", "slot"])
    total = F.col("_before") + F.col("_now")
    return found.where((F.col("_before") < settings.velocity_threshold) & (total >= settings.velocity_threshold)).select(
        "_account", "slot", total.cast("double").alias("_total"))


def alerts_now_due(reached: DataFrame, earlier: DataFrame, settings: Settings) -> DataFrame:
    """Rows of ``earlier`` of the accounts and buckets in ``reached``, with their new flags and ``was_alert``. An account
    reaches the threshold once per bucket, from fewer rows than the threshold, so these are few."""
    due = earlier.withColumn("_account", F.coalesce("nameOrig", F.lit(UNKNOWN))).join(reached, ["_account", "slot"])
    changed = due.withColumns({"velocity_5min": F.col("_total"), "was_alert": F.col("is_alert")})
    return scoring.apply_velocity_rule(changed, settings.velocity_threshold).select(*SILVER.fieldNames(), "was_alert")


@dataclass(frozen=True)
class Reach:
    """Which of silver a micro-batch looks at: hours of its rows, and hours before where first deliveries of untimed rows may
    be; the first and last bucket of either. There are as many hours as the rows' span of time has."""

    hours: list[int]
    hours_before: list[int]
    slots: tuple[int, int]
    slots_before: tuple[int, int]

    @classmethod
    def of(cls, rows: DataFrame, settings: Settings) -> Reach:
        seconds = settings.velocity_seconds
        found = rows.groupBy("event_hour").agg(
            F.min("slot").alias("first"), F.max("slot").alias("last"),
            F.min(F.when(lacks_event_time(), F.col("slot"))).alias("untimed")).collect()
        hours = {r["event_hour"] for r in found}
        first, last = min((r["first"] for r in found), default=0), max((r["last"] for r in found), default=-1)
        before, since = set(), first
        for r in found:
            # A bucket may lie across an hour's border.
            looked = [(r["first"] * seconds, r["first"] * seconds), (r["last"] * seconds, (r["last"] + 1) * seconds - 1)]
            hours |= {hour for begin, end in looked for hour in (_hour(begin), _hour(end))}
            if r["untimed"] is not None:
                begin = r["untimed"] * seconds - settings.untimed_seconds
                since = min(since, begin // seconds)
                before |= {_hour(s) for s in range(begin, r["untimed"] * seconds, min(3600, settings.untimed_seconds))}
        return cls(sorted(hours), sorted(before - hours), (first, last), (since, last))


def _hour(second: int) -> int:
    return int(f"{datetime.fromtimestamp(second, timezone.utc):%Y%m%d%H}")


def _write_events(alerts: DataFrame, sinks: Sinks, at: str) -> None:
    envelopes = encode_envelopes(alerts, emitted_at=F.col("event_ts"))
    if sinks.events_format == "event_log":
        publish(envelopes, sinks.events, at)
    elif sinks.events_format == "text":
        envelopes.select("value").write.mode("overwrite").text(f"{sinks.events}/{at}")
    else:
        envelopes.write.format(sinks.events_format).options(**sinks.events_options).save()


def _watermark(spark: SparkSession, marks: str, batch_id: int) -> datetime | None:
    """Latest own event time of the micro-batches before ``batch_id``."""
    try:
        seen = spark.read.schema("latest timestamp, ingest_batch_id long").parquet(marks)
    except AnalysisException:
        return None
    return seen.where(F.col("ingest_batch_id") < batch_id).agg(F.max("latest")).first()[0]


def _set_late_aside(rows: DataFrame, sinks: Sinks, settings: Settings, at: str, batch_id: int) -> DataFrame:
    """``rows`` without those behind the watermark, which are written to the late table."""
    spark, marks = rows.sparkSession, f"{sinks.late}/_marks/{at.split('/')[0]}"
    before = _watermark(spark, marks, batch_id)
    timed = F.when(~lacks_event_time(), F.col("event_ts"))
    latest = rows.agg(F.max(timed).alias("latest"))
    latest.write.mode("overwrite").parquet(f"{marks}/ingest_batch_id={batch_id}")
    if before is None:
        return rows
    end = F.timestamp_seconds((F.col("slot") + 1) * settings.velocity_seconds)
    late = F.coalesce(timed.isNotNull() & (end <= F.lit(before - timedelta(seconds=settings.late_seconds))), F.lit(False))
    behind = rows.where(late)
    if not behind.isEmpty():
        behind.drop("event_hour", "slot").write.mode("overwrite").parquet(f"{sinks.late}/{at}")
    return rows.where(~late)


def batch_writer(model: PipelineModel | Scorer, sinks: Sinks, settings: Settings):
    """Writer of one micro-batch.

    Silver is the stream's memory: the rows that earlier micro-batches of this query stored in the same velocity buckets
    count for velocity and tell which messages are repeats. Silver lies in folders by hour, and a file of one micro-batch
    spans few buckets, so Parquet skips all but those that count; of them the few columns needed are read. Where new rows lift an
    account over the velocity threshold, its earlier rows are written to the alerts again with their new flags, and
    those that were no alerts before are published.

    Every table gets its own folder per query and batch, written with overwrite, so a batch that is retried
    after a failure replaces what it wrote before; it looks at earlier batches only. Silver is written first;
    alerts are read back from it, so they agree with it and need no cache. Events go out last, with ids
    that a retry repeats.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        at = f"run={run}/ingest_batch_id={batch_id}"
        marks: dict[str, Any] = {"batch_id": batch_id}
        began = time.perf_counter()

        def mark(name: str) -> None:
            nonlocal began
            now = time.perf_counter()
            marks[name] = now - began
            began = now

        # The batch is read for its buckets, for bronze and for silver, so the source is read once into executor storage.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        fresh = None
        try:
            bad = batch.where(~F.col("_valid"))
            if not bad.isEmpty():
                if settings.fail_on_bad_message:
                    raise ValueError(f"Undecodable message in micro-batch {batch_id}")
                bad.select(*SOURCE_ID, "kafka_ingest_ts", "value").write.mode("overwrite").parquet(
                    f"{sinks.quarantine}/{at}")
            mark("quarantine_seconds")
            rows = batch.where("_valid").drop("_valid", "value").withColumns({
                "event_hour": F.date_format("event_ts", "yyyyMMddHH").cast("long"),
                "slot": scoring.time_slot(F.col("event_ts"), settings.velocity_seconds)})
            if settings.late_seconds is not None and sinks.late:
                rows = _set_late_aside(rows, sinks, settings, at, batch_id)
                mark("late_seconds")
            reach = Reach.of(rows, settings)

            def stored(hours: list[int], slots: tuple[int, int]) -> DataFrame | None:
                found = stored_hours(spark, sinks.silver, hours, run)
                return None if found is None else found.where((F.col("ingest_batch_id") < batch_id) & F.col("slot").between(*slots))

            earlier = stored(reach.hours, reach.slots)
            # New messages are counted for velocity and scored; looking for repeats of them twice would cost more than to keep them.
            fresh = new_messages(rows, stored(reach.hours + reach.hours_before, reach.slots_before)).persist(StorageLevel.MEMORY_AND_DISK)
            scored = score_rows(fresh, model, settings, earlier).select(
                *SILVER.fieldNames(), "slot", "event_hour", F.lit(run).alias("run"), F.lit(batch_id).alias("ingest_batch_id"))
            (compact(scored, settings.files_per_batch, "event_hour").write.mode("overwrite").partitionBy(*SILVER_FOLDERS)
             .option("partitionOverwriteMode", "dynamic").parquet(sinks.silver))
            mark("silver_seconds")
            compact(rows.select(*BRONZE.fieldNames()), settings.files_per_batch).write.mode("overwrite").parquet(
                f"{sinks.bronze}/{at}")
            mark("bronze_seconds")
        finally:
            if fresh is not None:
                fresh.unpersist()
            batch.unpersist()

        written = stored_hours(spark, sinks.silver, reach.hours, run)
        if written is not None:
            silver = written.where(F.col("ingest_batch_id") == batch_id)
            alerts = silver.where(F.col("is_alert")).select(*SILVER.fieldNames(), F.lit(False).alias("was_alert"))
            reached = None
            if earlier is not None:
                reached = accounts_now_due(silver, None, settings).repartition(spark.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
                # Once they are there, Spark knows their size and sends few of them to the earlier rows, which then need no shuffle.
                reached.count()
                alerts = alerts.unionByName(alerts_now_due(reached, earlier, settings))
            try:
                if not alerts.isEmpty():
                    compact(alerts, settings.files_per_batch).write.mode("overwrite").parquet(f"{sinks.gold}/{at}")
                    mark("gold_seconds")
                    if sinks.events or sinks.events_format != "text":
                        gold = spark.read.schema(alerts.schema).parquet(f"{sinks.gold}/{at}")
                        _write_events(gold.where("NOT was_alert").select(*SILVER.fieldNames()), sinks, at)
                        mark("events_seconds")
            finally:
                if reached is not None:
                    reached.unpersist()
        log.info("micro-batch %s: %s", batch_id, marks)
        if settings.on_batch:
            settings.on_batch(marks)

    return write


def score_stream(
    messages: DataFrame, model: PipelineModel | Scorer, sinks: Sinks, settings: Settings = Settings(),
) -> StreamingQuery:
    """Start the scoring stream over a streaming frame of messages.

    Decoding and typing run in the stream, where the time a blank event time falls back to is fixed per
    micro-batch. Which rows alert does not depend on how messages are cut into micro-batches; a row's stored velocity is that
    of its arrival, and ``read_silver`` gives the final one. The score is that of the features at arrival.
    """
    typed = scoring.coerce(parse_messages(messages), settings.as_of)
    return (
        typed.writeStream.queryName(QUERY_NAME)
        .option("checkpointLocation", sinks.checkpoint)
        .trigger(**trigger(settings.trigger_seconds, settings.available_now))
        .foreachBatch(batch_writer(model, sinks, settings))
        .start()
    )


def progress_metrics(query: StreamingQuery) -> list[dict[str, Any]]:
    """Input rows, rates and durations of the query's recent micro-batches."""
    return [
        {
            "batch_id": p["batchId"],
            "input_rows": p["numInputRows"],
            "rows_per_second": p["processedRowsPerSecond"],
            "duration_ms": dict(p["durationMs"]),
        }
        for p in query.recentProgress
    ]
