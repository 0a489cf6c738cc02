"""What a micro-batch shuffles."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tallyward.streaming import score
from tallyward.streaming.score import Settings, accounts_now_due, alerts_now_due


def rows(spark, copies: int):
    """Accounts with ``copies`` rows each in one bucket, as silver stores them."""
    names = score.SILVER.fields
    given = {"nameOrig": F.concat(F.lit("C"), (F.col("id") % 2000).cast("string")), "source_offset": F.col("id").cast("string"),
             "is_alert": F.lit(False), "rule_high_score": F.lit(False), "rule_high_amount_transfer": F.lit(False)}
    return spark.range(2000 * copies).select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in names], F.lit(7).cast("long").alias("slot"))


def test_rows_of_earlier_batches_are_not_shuffled_for_the_few_accounts_that_become_due(spark, path):
    rows(spark, 4).write.parquet(f"{path}/silver")
    earlier = spark.read.parquet(f"{path}/silver")
    fresh = rows(spark, 1).where("nameOrig IN ('C3', 'C5')")
    reached = accounts_now_due(fresh, earlier, Settings()).persist(StorageLevel.MEMORY_AND_DISK)
    assert reached.count() == 2
    due = alerts_now_due(reached, earlier, Settings())
    found = due.collect()
    plan = due._jdf.queryExecution().executedPlan().toString()
    reached.unpersist()
    assert sorted(int(r["source_offset"]) for r in found) == [x for k in range(4) for x in (3 + 2000 * k, 5 + 2000 * k)]
    assert all(r["velocity_5min"] == 5 and r["is_alert"] and not r["was_alert"] for r in found)
    # Only the inside of the kept table has exchanges.
    outside = plan.split("InMemoryRelation")[0]
    assert "BroadcastHashJoin" in outside and "Exchange hashpartitioning" not in outside


def test_velocity_of_new_rows_tells_which_accounts_become_due(spark):
    def some(offsets, velocity):
        # C<n> has n rows before and two new ones.
        return spark.createDataFrame([(f"C{n}" if n < 7 else None, 7, velocity(n)) for n in offsets], "nameOrig string, slot long, velocity_5min double")

    before = some([n for n in range(8) for _ in range(n)], lambda n: None)
    fresh = some([n for n in range(8) for _ in range(2)], lambda n: float(n + 2))
    want = sorted(map(tuple, accounts_now_due(fresh, before, Settings()).collect()))
    got = accounts_now_due(fresh, None, Settings())
    assert sorted(map(tuple, got.collect())) == want == [("C3", 7, 5.0), ("C4", 7, 6.0)]


def test_a_micro_batch_reads_earlier_rows_for_repeats_and_velocity_only(spark, path, monkeypatch):
    """Looking for accounts that become due reads no earlier row, and new messages are found once."""
    seen, found = [], []
    due, new = score.accounts_now_due, score.new_messages
    monkeypatch.setattr(score, "accounts_now_due", lambda fresh, earlier, settings: (seen.append(earlier), due(fresh, earlier, settings))[1])
    monkeypatch.setattr(score, "new_messages", lambda *a: found.append(new(*a)) or found[-1])
    levels = []
    rules = score.score_rows
    monkeypatch.setattr(score, "score_rows", lambda fresh, *a: levels.append(fresh.storageLevel.useMemory) or rules(fresh, *a))
    paths = score.Sinks(*[f"{path}/{n}" for n in ("bronze", "silver", "gold", "quarantine", "checkpoint")])
    write = score.batch_writer(lambda df: df.withColumns({"fraud_score": F.lit(0.1), "predicted_is_fraud": F.lit(False)}), paths, Settings())
    fields = {f.name: f for f in score.BRONZE.fields}
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    for i in range(3):
        given = {"nameOrig": F.lit("C1"), "source_topic": F.lit("t"), "source_partition": F.lit("0"), "source_offset": (F.col("id") + 2 * i).cast("string"),
                 "event_ts": F.timestamp_seconds(F.lit(1_700_000_000)), "event_emitted_at_utc": F.lit("2023-11-14T22:13:20+00:00"), "type": F.lit("PAYMENT")}
        frame = spark.range(2).select(*[given.get(n, F.lit(0)).cast(f.dataType).alias(n) for n, f in fields.items()])
        write(frame.withColumns({"_valid": F.lit(True), "value": F.lit("")}), i)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    gold = spark.read.parquet(paths.gold)
    assert sorted(int(r["source_offset"]) for r in gold.where("is_alert").collect()) == list(range(6))
    assert seen == [None, None] and levels == [True] * 3
