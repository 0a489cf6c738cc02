"""Warehouse models: staging, dimensions, facts and the hourly KPI mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.coercion import to_bool
from tallyward.functions.keys import hour_of, joined_key, natural_key, timestamp_text
from tallyward.schemas import FCT_ALERTS, FCT_SCORED, HOUR, MART

NUMERIC = "decimal(38,9)"


def stg_curated(curated: DataFrame) -> DataFrame:
    """Curated rows renamed and retyped; money becomes exact decimal."""
    def flag(name: str) -> Column:
        return to_bool(F.col(name), curated.schema[name].dataType).alias(name)

    ts = F.col("event_ts").cast("timestamp")
    return curated.select(
        F.col("step").cast("bigint").alias("step"),
        F.col("type").cast("string").alias("transaction_type"),
        F.col("amount").cast(NUMERIC).alias("amount"),
        F.col("nameOrig").cast("string").alias("origin_account"),
        F.col("nameDest").cast("string").alias("destination_account"),
        F.col("oldbalanceOrg").cast(NUMERIC).alias("old_balance_origin"),
        F.col("newbalanceOrig").cast(NUMERIC).alias("new_balance_origin"),
        F.col("oldbalanceDest").cast(NUMERIC).alias("old_balance_destination"),
        F.col("newbalanceDest").cast(NUMERIC).alias("new_balance_destination"),
        ts.alias("event_ts"),
        F.col("fraud_score").cast("double").alias("fraud_score"),
        flag("predicted_is_fraud"),
        flag("is_alert"),
        F.round(F.col("isFraud").cast("double")).cast("bigint").alias("is_fraud_label"),
        flag("is_label_available"),
        F.col("label_delay_hours").cast("double").alias("label_delay_hours"),
        F.col("velocity_5min").cast("double").alias("velocity_5min"),
        F.col("balance_change_ratio").cast("double").alias("balance_change_ratio"),
        flag("is_new_merchant"),
        F.col("origin_balance_delta").cast("double").alias("origin_balance_delta"),
        F.col("dest_balance_delta").cast("double").alias("destination_balance_delta"),
        F.col("source_topic").cast("string").alias("source_topic"),
        F.col("source_partition").cast("bigint").alias("source_partition"),
        F.col("source_offset").cast("bigint").alias("source_offset"),
        F.to_date(ts).alias("event_date"),
        hour_of(ts).alias("event_hour_utc"),
    )


def stg_monitoring(monitoring: DataFrame) -> DataFrame:
    return monitoring.select(
        F.col(HOUR).cast("timestamp").alias("event_hour_utc"),
        F.col("type").cast("string").alias("transaction_type"),
        F.col("txn_count").cast("bigint").alias("transaction_count"),
        F.col("alert_count").cast("bigint").alias("alert_count"),
        *[F.col(c).cast("double").alias(c) for c in
          ["avg_fraud_score", "p95_fraud_score", "observed_fraud_rate", "alert_rate"]],
    )


def account_touches(stg: DataFrame) -> DataFrame:
    """One row per account of a transaction, origin and destination, from one scan of staging; ``period`` is its hour."""
    return stg.select(
        F.explode(F.array("origin_account", "destination_account")).alias("account_id"),
        F.col("event_hour_utc").alias("period"),
        F.col("event_ts").alias("first_seen_ts"), F.col("event_ts").alias("last_seen_ts"),
        F.lit(1).cast("bigint").alias("transaction_touch_count"), F.col("amount").alias("total_amount_touched"),
    ).where(F.col("account_id").isNotNull())


def merge_touches(touches: DataFrame, *by: str) -> DataFrame:
    """Touches of an account, or partial figures of some, in one row. All four figures can be merged again, and the sum is
    of exact decimals, so that merging hours to days and months changes nothing."""
    return touches.groupBy(*by, "account_id").agg(
        F.min("first_seen_ts").alias("first_seen_ts"),
        F.max("last_seen_ts").alias("last_seen_ts"),
        F.sum("transaction_touch_count").alias("transaction_touch_count"),
        F.sum("total_amount_touched").cast(NUMERIC).alias("total_amount_touched"),
    )


def dim_account_of(touches: DataFrame) -> DataFrame:
    """Every account, from touches or partial figures."""
    return merge_touches(touches).select(natural_key(F.col("account_id")).alias("account_key"), "*")


def dim_account(stg: DataFrame) -> DataFrame:
    """Every account seen as origin or destination, from one scan of staging."""
    return dim_account_of(account_touches(stg))


def dim_transaction_type(stg: DataFrame) -> DataFrame:
    kinds = stg.where(F.col("transaction_type").isNotNull()).select("transaction_type").distinct()
    return kinds.select(natural_key(F.col("transaction_type")).alias("transaction_type_key"), "transaction_type")


def dim_time_hour(stg: DataFrame) -> DataFrame:
    hours = stg.where(F.col("event_hour_utc").isNotNull()).select("event_hour_utc").distinct()
    hour = F.col("event_hour_utc")
    return hours.select(
        hour.alias("time_hour_utc"),
        F.to_date(hour).alias("event_date"),
        F.year(hour).cast("bigint").alias("event_year"),
        F.month(hour).cast("bigint").alias("event_month"),
        F.dayofmonth(hour).cast("bigint").alias("event_day"),
        F.hour(hour).cast("bigint").alias("event_hour"),
        F.date_format(hour, "EEEE").alias("day_name"),
        F.date_format(hour, "yyyy-MM-dd HH:00:00 'UTC'").alias("hour_label_utc"),
    )


def fct_scored(stg: DataFrame) -> DataFrame:
    """One row per scored transaction with its surrogate keys; a map-only plan."""
    keys = {
        "transaction_key": joined_key(
            F.col("step"), F.col("transaction_type"), F.col("origin_account"),
            F.col("destination_account"), timestamp_text(F.col("event_ts")),
            F.col("source_partition"), F.col("source_offset")),
        "transaction_type_key": natural_key(F.col("transaction_type")),
        "origin_account_key": natural_key(F.col("origin_account")),
        "destination_account_key": natural_key(F.col("destination_account")),
    }
    return stg.select(*[
        keys[name].alias(name) if name in keys else F.col(name) for name in FCT_SCORED.fieldNames()])


def fct_alerts(fct: DataFrame) -> DataFrame:
    return fct.where(F.col("is_alert")).select(*FCT_ALERTS.fieldNames())


def mart_kpis(fct: DataFrame, stg_mon: DataFrame) -> DataFrame:
    """Hourly KPIs per type beside the batch job's own figures. Both join sides are
    aggregates with one row per hour and type."""
    scored = fct.groupBy("event_hour_utc", "transaction_type").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(F.col("is_alert")).alias("alert_count"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        F.max("fraud_score").alias("max_fraud_score"),
        F.avg(F.when(F.col("is_label_available"), F.col("is_fraud_label"))).alias("observed_fraud_rate"),
    )
    batch = stg_mon.select(
        "event_hour_utc", "transaction_type", "p95_fraud_score",
        F.col("alert_rate").alias("alert_rate_batch"))
    return (
        scored.join(batch, ["event_hour_utc", "transaction_type"], "left")
        .withColumn("alert_rate_recomputed", F.try_divide("alert_count", "transaction_count"))
        .select(*MART.fieldNames())
    )
