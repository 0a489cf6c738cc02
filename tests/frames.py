"""Small literal frames for the edge cases."""

from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from tallyward.schemas import MICRO_BATCH, SILVER

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
START = datetime(2024, 1, 1, tzinfo=timezone.utc)

RAW = {
    "source_topic": "t", "source_partition": "0", "source_offset": "1", "kafka_ingest_ts": "2024-01-01 00:00:00",
    "step": "1", "type": "PAYMENT", "amount": "10.5", "nameOrig": "C1", "oldbalanceOrg": "100.0",
    "newbalanceOrig": "89.5", "nameDest": "M1", "oldbalanceDest": "0.0", "newbalanceDest": "0.0",
    "event_emitted_at_utc": "2024-01-01T00:00:00.000000+00:00",
}

SCORED = {
    "source_topic": "t", "source_partition": "0", "source_offset": "1", "kafka_ingest_ts": "2024-01-01 00:00:00",
    "event_emitted_at_utc": "2024-01-01T00:00:00+00:00", "event_ts": START, "step": 1, "type": "TRANSFER",
    "amount": 10.0, "nameOrig": "C1", "nameDest": "C2", "oldbalanceOrg": 100.0, "newbalanceOrig": 90.0,
    "oldbalanceDest": 5.0, "newbalanceDest": 15.0, "velocity_5min": 1.0, "balance_change_ratio": 0.1,
    "is_new_merchant": 0.0, "origin_balance_delta": 10.0, "dest_balance_delta": 10.0, "fraud_score": 0.1,
    "predicted_is_fraud": False, "is_alert": False, "rule_high_score": False,
    "rule_high_amount_transfer": False, "rule_high_velocity": False,
}


def raw(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [{**RAW, "source_offset": str(i), **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[c] for c in MICRO_BATCH.fieldNames()) for r in rows], MICRO_BATCH)


def scored(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [{**SCORED, "source_offset": str(i), **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[c] for c in SILVER.fieldNames()) for r in rows], SILVER)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)
