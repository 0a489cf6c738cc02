"""A message delivered twice must be curated once, whichever hours it was stamped with."""

from __future__ import annotations

from frames import START, at, scored
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.plans import jobs
from tallyward.schemas import JOIN_KEYS


def test_untimed_repeat_in_another_hour(spark, path):
    df = scored(
        spark,
        {"source_offset": "1", "event_emitted_at_utc": "", "kafka_ingest_ts": "a", "event_ts": at(10)},
        {"source_offset": "1", "event_emitted_at_utc": "", "kafka_ingest_ts": "b", "event_ts": at(3700)},
        {"source_offset": "2", "event_ts": at(3800)},
        {"source_offset": "3", "event_emitted_at_utc": "", "event_ts": at(3900)})
    labels = spark.createDataFrame([], T.StructType(
        [df.schema[c] for c in JOIN_KEYS] + [T.StructField("isFraud", T.DoubleType())]))

    def curate(hour, out):
        jobs.hourly(spark, df, labels, out, hour, START)
        return {r["source_offset"] for r in spark.read.parquet(f"{out}/curated_scored").select("source_offset").collect()}

    assert curate("2024-01-01-01", f"{path}/second") == {"2", "3"}
    assert curate("2024-01-01-00", f"{path}/first") == {"1"}
    assert curate(None, f"{path}/all") == {"1", "2", "3"}


def test_labels_arriving_later_fill_one_hour(spark, path):
    df = scored(spark, {"event_ts": at(10)}, {"event_ts": at(3700), "amount": 3.0})
    none = df.select(*JOIN_KEYS).withColumn("isFraud", F.lit(1.0)).where(F.lit(False))
    late = df.select(*JOIN_KEYS).withColumn("isFraud", F.lit(1.0))
    jobs.hourly(spark, df, none, f"{path}/t", None, START)
    counts = jobs.hourly(spark, df, late, f"{path}/t", "2024-01-01-01", START)
    assert counts["labelled_rows"] == counts["retraining_rows"] == 1
    rows = spark.read.parquet(f"{path}/t/curated_scored")
    assert {r["amount"]: r["isFraud"] for r in rows.collect()} == {10.0: None, 3.0: 1.0}
