"""Column lists and types of the tables that the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names and order of the published tables.
JOIN_KEYS = [
    "step", "type", "amount", "nameOrig", "nameDest",
    "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
]
SOURCE_ID = ["source_topic", "source_partition", "source_offset"]
MONEY = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
LABEL_COLUMNS = ["isFraud", "isFlaggedFraud"]
PAYLOAD_FIELDS = [
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "nameDest", "oldbalanceDest", "newbalanceDest",
]
ENGINEERED = [
    "velocity_5min", "balance_change_ratio", "is_new_merchant",
    "origin_balance_delta", "dest_balance_delta",
]
RULE_FLAGS = ["rule_high_score", "rule_high_amount_transfer", "rule_high_velocity"]
HOUR = "batch_hour_utc"
# Folders of the silver table that a stream writes: the event's hour as a number like 2024010105, and who wrote it. Its
# files also hold ``slot``, the number of the row's velocity bucket.
SILVER_FOLDERS = ["event_hour", "run", "ingest_batch_id"]

LABELLED_CSV = T.StructType([
    T.StructField("step", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", T.StringType()),
    T.StructField("newbalanceOrig", T.StringType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", T.StringType()),
    T.StructField("newbalanceDest", T.StringType()),
    T.StructField("isFraud", T.StringType()),
    T.StructField("isFlaggedFraud", T.StringType()),
])

# What arrives from a message source, whatever the broker or file format.
MESSAGE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.StringType()),
    T.StructField("offset", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

ENVELOPE = T.StructType(
    [T.StructField(name, T.StringType()) for name in
     ["schema_version", "event_id", "event_type", "source", "emitted_at_utc"]]
    + [T.StructField("payload", T.StructType(
        [T.StructField(name, T.StringType()) for name in PAYLOAD_FIELDS + ["event_emitted_at_utc"]]))]
)

MICRO_BATCH = T.StructType(
    [T.StructField(name, T.StringType()) for name in
     SOURCE_ID + ["kafka_ingest_ts"] + PAYLOAD_FIELDS + ["event_emitted_at_utc"]]
)

BRONZE = T.StructType([
    T.StructField("source_topic", T.StringType()),
    T.StructField("source_partition", T.StringType()),
    T.StructField("source_offset", T.StringType()),
    T.StructField("kafka_ingest_ts", T.StringType()),
    T.StructField("event_emitted_at_utc", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
])

SILVER = T.StructType([
    T.StructField("source_topic", T.StringType()),
    T.StructField("source_partition", T.StringType()),
    T.StructField("source_offset", T.StringType()),
    T.StructField("kafka_ingest_ts", T.StringType()),
    T.StructField("event_emitted_at_utc", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("velocity_5min", T.DoubleType()),
    T.StructField("balance_change_ratio", T.DoubleType()),
    T.StructField("is_new_merchant", T.DoubleType()),
    T.StructField("origin_balance_delta", T.DoubleType()),
    T.StructField("dest_balance_delta", T.DoubleType()),
    T.StructField("fraud_score", T.DoubleType()),
    T.StructField("predicted_is_fraud", T.BooleanType()),
    T.StructField("is_alert", T.BooleanType()),
    T.StructField("rule_high_score", T.BooleanType()),
    T.StructField("rule_high_amount_transfer", T.BooleanType()),
    T.StructField("rule_high_velocity", T.BooleanType()),
])

CURATED = T.StructType(SILVER.fields + [
    T.StructField("isFraud", T.DoubleType()),
    T.StructField("is_label_available", T.BooleanType()),
    T.StructField("label_delay_hours", T.DoubleType()),
    T.StructField(HOUR, T.TimestampType()),
])

RETRAINING = T.StructType(CURATED.fields[:-1] + [
    T.StructField("class_weight", T.DoubleType()),
    T.StructField("dataset_split", T.StringType()),
    T.StructField(HOUR, T.TimestampType()),
])

MONITORING = T.StructType([
    T.StructField(HOUR, T.TimestampType()),
    T.StructField("type", T.StringType()),
    T.StructField("txn_count", T.LongType()),
    T.StructField("alert_count", T.LongType()),
    T.StructField("avg_fraud_score", T.DoubleType()),
    T.StructField("p95_fraud_score", T.DoubleType()),
    T.StructField("observed_fraud_rate", T.DoubleType()),
    T.StructField("alert_rate", T.DoubleType()),
])

MODEL_INPUT = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("isFraud", T.DoubleType()),
    T.StructField("velocity_5min", T.DoubleType()),
    T.StructField("balance_change_ratio", T.DoubleType()),
    T.StructField("is_new_merchant", T.DoubleType()),
    T.StructField("origin_balance_delta", T.DoubleType()),
    T.StructField("dest_balance_delta", T.DoubleType()),
])

_NUMERIC = T.DecimalType(38, 9)

FCT_SCORED = T.StructType([
    T.StructField("transaction_key", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("event_hour_utc", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("step", T.LongType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("transaction_type_key", T.StringType()),
    T.StructField("origin_account", T.StringType()),
    T.StructField("origin_account_key", T.StringType()),
    T.StructField("destination_account", T.StringType()),
    T.StructField("destination_account_key", T.StringType()),
    T.StructField("amount", _NUMERIC),
    T.StructField("old_balance_origin", _NUMERIC),
    T.StructField("new_balance_origin", _NUMERIC),
    T.StructField("old_balance_destination", _NUMERIC),
    T.StructField("new_balance_destination", _NUMERIC),
    T.StructField("velocity_5min", T.DoubleType()),
    T.StructField("balance_change_ratio", T.DoubleType()),
    T.StructField("is_new_merchant", T.BooleanType()),
    T.StructField("origin_balance_delta", T.DoubleType()),
    T.StructField("destination_balance_delta", T.DoubleType()),
    T.StructField("fraud_score", T.DoubleType()),
    T.StructField("predicted_is_fraud", T.BooleanType()),
    T.StructField("is_alert", T.BooleanType()),
    T.StructField("is_fraud_label", T.LongType()),
    T.StructField("is_label_available", T.BooleanType()),
    T.StructField("label_delay_hours", T.DoubleType()),
    T.StructField("source_topic", T.StringType()),
    T.StructField("source_partition", T.LongType()),
    T.StructField("source_offset", T.LongType()),
])

FCT_ALERTS = T.StructType([FCT_SCORED[name] for name in [
    "transaction_key", "event_ts", "event_hour_utc", "event_date",
    "transaction_type", "transaction_type_key",
    "origin_account", "origin_account_key", "destination_account", "destination_account_key",
    "amount", "fraud_score", "predicted_is_fraud",
    "is_fraud_label", "is_label_available", "label_delay_hours",
    "source_topic", "source_partition", "source_offset",
]])

MART = T.StructType([
    T.StructField("event_hour_utc", T.TimestampType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("transaction_count", T.LongType()),
    T.StructField("alert_count", T.LongType()),
    T.StructField("alert_rate_recomputed", T.DoubleType()),
    T.StructField("alert_rate_batch", T.DoubleType()),
    T.StructField("avg_fraud_score", T.DoubleType()),
    T.StructField("p95_fraud_score", T.DoubleType()),
    T.StructField("max_fraud_score", T.DoubleType()),
    T.StructField("observed_fraud_rate", T.DoubleType()),
])
