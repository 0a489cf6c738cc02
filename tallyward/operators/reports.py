"""Dashboard aggregates over the facts and the mart."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_period(
    df: DataFrame, start: datetime | None = None, end: datetime | None = None,
    types: list[str] | None = None,
) -> DataFrame:
    """Hours from ``start`` to ``end`` inclusive, and the chosen transaction types."""
    if start is not None:
        df = df.where(F.col("event_hour_utc") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("event_hour_utc") <= F.lit(end))
    return df.where(F.col("transaction_type").isin(types)) if types else df


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def kpi_tiles(fct: DataFrame) -> DataFrame:
    """One row of headline figures; the two fraud shares add up to 1 when there is any fraud."""
    fraud = F.col("is_label_available") & (F.col("is_fraud_label") == 1)
    counts = fct.agg(
        F.count("transaction_key").alias("total_transactions"),
        F.count_if(fraud).alias("real_fraud_transactions"),
        F.count_if("is_alert").alias("alerted_transactions"),
        F.count_if(fraud & F.col("is_alert")).alias("real_fraud_alerted"),
        F.count_if(fraud & ~F.col("is_alert")).alias("real_fraud_not_alerted"),
        F.count_if("is_label_available").alias("_labelled"),
    )
    total, real = F.col("total_transactions"), F.col("real_fraud_transactions")
    return counts.select(
        "total_transactions", "real_fraud_transactions", "alerted_transactions",
        "real_fraud_alerted", "real_fraud_not_alerted",
        _share(F.col("alerted_transactions"), total).alias("alert_share"),
        _share(F.col("real_fraud_alerted"), real).alias("real_fraud_alerted_share"),
        _share(F.col("real_fraud_not_alerted"), real).alias("real_fraud_not_alerted_share"),
        _share(F.col("_labelled"), total).alias("label_coverage"),
    )


def alert_trend(mart: DataFrame) -> DataFrame:
    """Alerts per month and type."""
    return mart.groupBy(F.date_trunc("month", "event_hour_utc").alias("event_month"), "transaction_type").agg(
        F.sum("alert_count").alias("alert_count"),
        F.sum("transaction_count").alias("transaction_count"),
    ).withColumn("alert_rate", F.try_divide("alert_count", "transaction_count"))


def volume_vs_alerts(mart: DataFrame) -> DataFrame:
    """Hourly volume, alerts, alert rate and score trend over all types."""
    return mart.groupBy("event_hour_utc").agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("alert_count").alias("alert_count"),
        F.avg("alert_rate_recomputed").alias("avg_alert_rate"),
        F.avg("avg_fraud_score").alias("avg_fraud_score"),
        F.max("max_fraud_score").alias("max_fraud_score"),
        F.avg("p95_fraud_score").alias("avg_p95_fraud_score"),
    )


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    per_type = alerts.groupBy("transaction_type").agg(F.count("transaction_key").alias("alert_count"))
    total = per_type.agg(F.sum("alert_count").alias("total")).scalar()
    return per_type.withColumn("_total", total).select(
        "transaction_type", "alert_count", (F.col("alert_count") / F.col("_total")).alias("share"))


def top_risky_accounts(alerts: DataFrame, side: str = "origin", n: int = 10) -> DataFrame:
    """The ``n`` origin or destination accounts with most alerts; ties by account name."""
    account = F.col(f"{side}_account")
    return (
        alerts.groupBy(account.alias("account"))
        .agg(F.count("transaction_key").alias("alert_count"), F.avg("fraud_score").alias("avg_fraud_score"))
        .orderBy(F.desc("alert_count"), "account").limit(n)
    )


def alert_drill(fct: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alerts beside the scored row they came from."""
    detail = fct.where("is_alert").select(
        "transaction_key", "velocity_5min", "balance_change_ratio", "is_new_merchant",
        "origin_balance_delta", "destination_balance_delta")
    return alerts.join(detail, "transaction_key")


def source_offsets(df: DataFrame) -> DataFrame:
    """Messages and offset range per source partition."""
    offset = F.col("source_offset").cast("bigint")
    return df.groupBy("source_topic", "source_partition").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.min(offset).alias("min_offset"),
        F.max(offset).alias("max_offset"),
    )


def lake_preview(
    df: DataFrame, n: int = 20, only_alerts: bool = False, tie_break: list[str] | None = None,
) -> DataFrame:
    """The newest ``n`` rows, or any ``n`` where there is no event time."""
    if only_alerts:
        if "is_alert" not in df.columns:
            raise ValueError("Only scored rows tell alerts apart: there is no is_alert column here.")
        df = df.where(F.col("is_alert"))
    if "event_ts" in df.columns:
        df = df.orderBy(F.desc("event_ts"), *(tie_break or []))
    return df.limit(n)
