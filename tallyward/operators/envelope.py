"""JSON event envelopes and alert notification text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.coercion import moment, plain_number
from tallyward.functions.keys import TIMESTAMP_TEXT, joined_key, timestamp_text
from tallyward.schemas import ENVELOPE, MICRO_BATCH, PAYLOAD_FIELDS, SILVER, SOURCE_ID

# Names that appear inside published envelopes.
SCHEMA_VERSION = "1.0"
ALERT_EVENT_TYPE = "fraud.alert"
DEFAULT_TOPIC = "pubsub.subscription"


def parse_messages(messages: DataFrame) -> DataFrame:
    """Decode messages into micro-batch columns plus ``_valid`` and the original ``value``.

    A message is valid when it is a JSON object with an object under ``payload``. Fields
    missing from the payload become empty text; the event time falls back to the envelope's.
    """
    value = F.col("value").cast("string")
    # from_json stops after the first complete value, so the text is read as the only
    # element of an array: anything after the object then breaks the array or adds to it.
    wrapped = F.concat(F.lit("["), value, F.lit("]"))
    parsed = messages.withColumn(
        "_envelopes", F.from_json(wrapped, T.ArrayType(ENVELOPE), {"allowSingleQuotes": "false"}))
    envelope = F.get("_envelopes", F.lit(0))
    payload = envelope["payload"]
    valid = (F.size("_envelopes") == 1) & payload.isNotNull() & F.rtrim(value, F.lit(" \t\r\n")).endswith("}")
    columns = {
        "source_topic": F.coalesce(F.col("topic"), F.lit(DEFAULT_TOPIC)),
        "source_partition": F.coalesce(F.col("partition").cast("string"), F.lit("0")),
        "source_offset": F.col("offset").cast("string"),
        "kafka_ingest_ts": F.coalesce(F.col("timestamp").cast("string"), F.lit("")),
        **{name: F.coalesce(payload[name], F.lit("")) for name in PAYLOAD_FIELDS},
        "event_emitted_at_utc": F.coalesce(
            payload["event_emitted_at_utc"], envelope["emitted_at_utc"], F.lit("")),
    }
    return parsed.select(
        *[columns[name].alias(name) for name in MICRO_BATCH.fieldNames()],
        F.coalesce(valid, F.lit(False)).alias("_valid"),
        value.alias("value"),
    )


def decode_envelopes(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, quarantined messages)."""
    parsed = parse_messages(messages)
    return (
        parsed.where("_valid").select(*MICRO_BATCH.fieldNames()),
        parsed.where("not _valid").select(*SOURCE_ID, "kafka_ingest_ts", "value"),
    )


def envelope_json(
    payload: Column, event_type: str, source: str, event_id: Column, emitted_at: Column,
    schema_version: str = SCHEMA_VERSION,
) -> Column:
    return F.to_json(
        F.struct(
            F.lit(schema_version).alias("schema_version"),
            event_id.alias("event_id"),
            F.lit(event_type).alias("event_type"),
            F.lit(source).alias("source"),
            F.date_format(emitted_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("emitted_at_utc"),
            payload.alias("payload"),
        ),
        {"ignoreNullFields": "false", "timestampFormat": TIMESTAMP_TEXT},
    )


def encode_envelopes(
    df: DataFrame,
    event_type: str = ALERT_EVENT_TYPE,
    source: str = "tallyward.score_stream",
    emitted_at: datetime | Column | None = None,
    schema_version: str = SCHEMA_VERSION,
) -> DataFrame:
    """``key``, ``value``: one envelope per row with all its columns as payload.

    The id is a hash of the row's source identity, or of all its columns where a part of that
    is null, so a retry publishes the same id.
    """
    unknown = F.lit(False)
    for c in SOURCE_ID:
        unknown = unknown | F.col(c).isNull()
    event_id = F.when(unknown, F.md5(F.to_json(F.struct(*df.columns)))).otherwise(joined_key(*[F.col(c) for c in SOURCE_ID]))
    value = envelope_json(
        F.struct(*df.columns), event_type, source, event_id, moment(emitted_at), schema_version)
    return df.select(event_id.alias("key"), value.alias("value"))


def decode_alerts(messages: DataFrame) -> DataFrame:
    """Alert rows out of published envelopes, with the envelope's own fields in front."""
    schema = T.StructType([f for f in ENVELOPE.fields if f.name != "payload"] + [T.StructField("payload", SILVER)])
    read = F.from_json(F.col("value").cast("string"), schema, {"timestampFormat": TIMESTAMP_TEXT})
    return (
        messages.select(read.alias("_envelope"))
        .where(F.col("_envelope.payload").isNotNull())
        .select("_envelope.schema_version", "_envelope.event_id", "_envelope.event_type",
                F.col("_envelope.source").alias("source"), "_envelope.emitted_at_utc", "_envelope.payload.*")
    )


def _shown(df: DataFrame, name: str, missing: str) -> Column:
    if name not in df.columns:
        return F.lit(missing)
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampType):
        col = timestamp_text(col)
    elif isinstance(kind, T.DoubleType):
        col = plain_number(col)
    elif isinstance(kind, T.BooleanType):
        col = F.initcap(col.cast("string"))
    return F.coalesce(col.cast("string"), F.lit("None"))


def alert_messages(df: DataFrame) -> DataFrame:
    """``subject``, ``body`` and webhook ``payload`` for every alert row."""
    kind, origin = _shown(df, "type", "UNKNOWN"), _shown(df, "nameOrig", "UNKNOWN")
    score = F.col("fraud_score").cast("double") if "fraud_score" in df.columns else F.lit(0.0)
    subject = F.concat(
        F.lit("[Fraud Alert] "), kind, F.lit(" from "), origin,
        F.format_string(" score=%.4f", F.coalesce(score, F.lit(0.0))))
    # The lines of the notification, and what stands for an absent field.
    lines = [
        ("nameOrig", "UNKNOWN"), ("nameDest", "UNKNOWN"), ("type", "UNKNOWN"), ("amount", "0"),
        ("fraud_score", "0"), ("predicted_is_fraud", "None"), ("is_alert", "None"), ("event_ts", "None"),
    ]
    body = F.concat(
        F.lit("High-risk transaction detected.\n\n"),
        *[F.concat(F.lit(f"{name}: "), _shown(df, name, missing), F.lit("\n")) for name, missing in lines])
    written = df.withColumns({"subject": subject, "body": body})
    payload = F.to_json(
        F.struct("subject", "body", F.struct(*df.columns).alias("alert")),
        {"ignoreNullFields": "false", "timestampFormat": TIMESTAMP_TEXT})
    identity = [c for c in SOURCE_ID if c in df.columns]
    return written.select(*identity, "subject", "body", payload.alias("payload"))
