"""Transactions derived from the ``events`` and ``customer`` tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.keys import TIMESTAMP_TEXT
from tallyward.operators import reconcile, scoring
from tallyward.operators.envelope import envelope_json
from tallyward.schemas import CURATED, JOIN_KEYS, MICRO_BATCH, PAYLOAD_FIELDS, SILVER
from tallyward.session import configure

# Fixed values of the mapping: first event, types per event kind, and the run moment.
BASE_MICROS = 1704067200000000
TYPES = {"purchase": "TRANSFER", "signup": "CASH_OUT", "click": "PAYMENT", "view": "CASH_IN", "error": "DEBIT"}
AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)


# Stated here so that opening a table reads no footers.
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
CUSTOMER = "c_custkey bigint, c_acctbal double"


def table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    reader = configure(spark).read
    return (reader.schema(schema) if schema else reader).parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions with source identity, surrogate score and label (null = none yet).

    Time runs 60 times faster than in ``events``, so that accounts repeat within 5 minutes.
    """
    events = table(spark, sf_dir, "events", EVENTS).selectExpr(
        "event_id", "user_id", "event_type", "value",
        "cast(regexp_extract(props, '[0-9]+', 0) as int) as k",
        f"(unix_micros(cast(ts as timestamp)) - {BASE_MICROS}) div 60 as cus",
    )
    customer = table(spark, sf_dir, "customer", CUSTOMER)
    # Both joins are left to Spark, which broadcasts a side by size or splits hot keys.
    payer = customer.selectExpr("c_custkey as user_id", "c_acctbal as payer_balance")
    payee = customer.selectExpr(
        "cast(c_custkey as int) as k", "c_acctbal as payee_balance")
    joined = events.join(payer, "user_id", "left").join(payee, "k", "left")
    kinds = " ".join(f"when '{kind}' then '{code}'" for kind, code in TYPES.items())
    shaped = joined.selectExpr(
        "event_id", "k",
        "'transactions_raw' as source_topic",
        "cast(event_id % 4 as string) as source_partition",
        "cast(event_id as string) as source_offset",
        f"timestamp_micros({BASE_MICROS} + cus) as event_ts",
        "cast(cus div 3600000000 as int) as step",
        f"case event_type {kinds} end as type",
        "value * 2000D as amount",
        "concat('C', cast(user_id div 4 as string)) as nameOrig",
        "case when k % 3 = 0 then concat('M', cast(k as string)) else concat('C', cast(k div 4 as string)) end as nameDest",
        "greatest(coalesce(payer_balance, 0D), 0D) * 100D as oldbalanceOrg",
        "case when k % 3 = 0 then 0D else greatest(coalesce(payee_balance, 0D), 0D) * 100D end as oldbalanceDest",
    )
    return shaped.selectExpr(
        "source_topic", "source_partition", "source_offset",
        f"date_format(event_ts, '{TIMESTAMP_TEXT}') as kafka_ingest_ts",
        f"date_format(event_ts, '{TIMESTAMP_TEXT}') as event_emitted_at_utc",
        "event_ts", "step", "type", "amount", "nameOrig", "nameDest",
        "oldbalanceOrg", "greatest(oldbalanceOrg - amount, 0D) as newbalanceOrig",
        "oldbalanceDest", "case when k % 3 = 0 then 0D else oldbalanceDest + amount end as newbalanceDest",
        "least(1D, amount / 400000D) as fraud_score",
        """case when event_id % 10 = 0 then cast(null as double)
                when type in ('TRANSFER', 'CASH_OUT') and amount >= 150000 and k % 2 = 0 then 1D
                else 0D end as isFraud""",
    )


def surrogate_score(df: DataFrame) -> DataFrame:
    """Stands in for the model wherever results are compared with another engine."""
    score = F.least(F.lit(1.0), F.col("amount") / 400000.0)
    return df.withColumns({"fraud_score": score, "predicted_is_fraud": score > 0.5})


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows with the columns of the silver table."""
    return scored(spark, sf_dir).select(*SILVER.fieldNames())


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.apply_rules(surrogate_score(scoring.engineer(transactions(spark, sf_dir))))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rows, with the label taken from the mapping itself."""
    labelled = scored(spark, sf_dir).withColumns(reconcile.label_columns(AS_OF))
    return reconcile.with_hour(labelled).select(*CURATED.fieldNames())


def with_duplicates(df: DataFrame) -> DataFrame:
    """Every twentieth message delivered twice, the second time one second later."""
    again = df.where(F.col("source_offset").cast("bigint") % 20 == 0).withColumn(
        "kafka_ingest_ts", F.concat(F.col("kafka_ingest_ts"), F.lit("+1")))
    return df.unionByName(again)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rows, some with a second row that contradicts them."""
    known = transactions(spark, sf_dir).where(F.col("isFraud").isNotNull()).select(
        *JOIN_KEYS, "isFraud", "source_offset")
    conflict = known.where(F.col("source_offset").cast("bigint") % 50 == 1).withColumn(
        "isFraud", F.lit(1.0) - F.col("isFraud"))
    return known.unionByName(conflict).drop("source_offset")


def raw_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The micro-batch frame as text, with blanks and a hyphenated type here and there."""
    event_id = F.col("source_offset").cast("bigint")

    def blank(condition: Column, col: Column) -> Column:
        return F.when(condition, F.lit("")).otherwise(col)

    kind = F.when((event_id % 79 == 0) & (F.col("type") == "CASH_OUT"), F.lit("CASH-OUT")).otherwise(F.col("type"))
    text = transactions(spark, sf_dir)
    changed = {
        "amount": blank(event_id % 97 == 0, F.col("amount").cast("string")),
        "type": blank(event_id % 89 == 0, kind),
        "event_emitted_at_utc": blank(
            event_id % 83 == 0, F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")),
    }
    return text.select(*[
        (changed[c] if c in changed else F.col(c).cast("string")).alias(c) for c in MICRO_BATCH.fieldNames()])


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows inside JSON envelopes, every 71st of them cut off in the middle."""
    raw = raw_strings(spark, sf_dir)
    event_id = F.col("source_offset").cast("bigint")
    whole = envelope_json(
        F.struct(*PAYLOAD_FIELDS, "event_emitted_at_utc"), "transaction.created", "replay",
        F.col("source_offset"), F.lit(AS_OF).cast("timestamp"))
    cut = F.when(event_id % 71 == 0, F.substring(whole, 1, 40)).otherwise(whole)
    return raw.select(
        cut.alias("value"),
        F.col("source_topic").alias("topic"),
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
        F.col("kafka_ingest_ts").alias("timestamp"),
    )
