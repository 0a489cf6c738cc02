"""Deduplication, label reconciliation and hourly monitoring."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.coercion import blank_to_null, moment
from tallyward.functions.keys import exact_text, hour_of
from tallyward.operators.skew import HOT_ROWS, bucketed_join, key_load, spread_join
from tallyward.schemas import HOUR, JOIN_KEYS, SILVER, SOURCE_ID

# The business key as a label table stores it: amounts as text. The amount goes first for the same reason as in keep_first.
_AMOUNTS = [c for c in JOIN_KEYS if isinstance(SILVER[c].dataType, T.DoubleType)]
STORED_KEYS = [f"{c}_text" for c in _AMOUNTS] + [c for c in JOIN_KEYS if c not in _AMOUNTS]


def dedup_keys(df: DataFrame) -> list[str]:
    return SOURCE_ID if set(SOURCE_ID) <= set(df.columns) else JOIN_KEYS + ["event_ts"]


def keep_first(df: DataFrame, keys: list[str], prefer: list[str]) -> DataFrame:
    """One row per key: the first by ``prefer``, then by all other sortable columns.

    Spark keeps the best row of each key per map task before it shuffles, so a key with
    many copies sends one row per task.
    """
    sortable = [
        f.name for f in df.schema.fields
        if f.name not in keys and isinstance(f.dataType, T.AtomicType)
    ]
    order = [c for c in prefer if c in sortable] + [c for c in sortable if c not in prefer]
    # Keys run from general to specific; sorting by the specific one first settles most
    # comparisons at the first column.
    rank = F.row_number().over(Window.partitionBy(*reversed(keys)).orderBy(*(order or keys)))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedup_scored(df: DataFrame) -> DataFrame:
    """One row per source message; where any part of that identity is absent or null, one per business key and event time."""
    if dedup_keys(df) != SOURCE_ID:
        return keep_first(df, dedup_keys(df), ["kafka_ingest_ts"])
    unknown = F.lit(False)
    for c in SOURCE_ID:
        unknown = unknown | F.col(c).isNull()
    identity = {f"_id_{c}": F.when(~unknown, F.col(c)) for c in SOURCE_ID}
    business = {f"_id_{c}": F.when(unknown, F.col(c)) for c in [*JOIN_KEYS, "event_ts"]}
    keyed = df.withColumns({**business, **identity})
    return keep_first(keyed, [*business, *identity], ["kafka_ingest_ts"]).drop(*business, *identity)


def stored_keys() -> dict[str, Column]:
    """The columns of ``STORED_KEYS`` that are made from others."""
    return {f"{c}_text": exact_text(F.col(c)) for c in _AMOUNTS}


def are_stored(labels: DataFrame) -> bool:
    """Whether ``labels`` come from a table in buckets of the business key."""
    return set(STORED_KEYS) <= set(labels.columns)


def dedup_labels(labels: DataFrame) -> DataFrame:
    """One label per business key, stored or not. On conflict the fraud label wins."""
    return labels.groupBy(*(STORED_KEYS if are_stored(labels) else JOIN_KEYS)).agg(F.max("isFraud").alias("isFraud"))


def parse_hour(hour: str) -> datetime:
    return datetime.strptime(hour, "%Y-%m-%d-%H").replace(tzinfo=timezone.utc)


def filter_hour(df: DataFrame, hour: str | None = None, ts: str = "event_ts") -> DataFrame:
    """Rows of one hour ``YYYY-MM-DD-HH`` as a plain range, which Parquet can prune."""
    if not hour:
        return df
    start = parse_hour(hour)
    return df.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(start + timedelta(hours=1))))


def lacks_event_time() -> Column:
    """True for rows whose ``event_ts`` is the time they were processed."""
    return F.try_to_timestamp(blank_to_null(F.col("event_emitted_at_utc"))).isNull()


def repeats_elsewhere(silver: DataFrame, hour: str, elsewhere: DataFrame | None = None) -> DataFrame:
    """Rows outside ``hour``, of ``elsewhere`` if given, that repeat a message of that hour.

    Only a message without an event time can be stamped with two hours when it is delivered
    twice, so only the identities of such messages are looked for in the rest of silver.
    """
    suspects = filter_hour(silver, hour).where(lacks_event_time()).select(*SOURCE_ID).distinct()
    start = parse_hour(hour)
    outside = (silver if elsewhere is None else elsewhere).where(
        (F.col("event_ts") < F.lit(start)) | (F.col("event_ts") >= F.lit(start + timedelta(hours=1))))
    return outside.where(lacks_event_time()).join(suspects, SOURCE_ID, "left_semi").select(*silver.columns)


def require_rows(df: DataFrame, message: str = "The chosen window holds no scored transactions.") -> None:
    if df.isEmpty():
        raise ValueError(message)


def with_hour(df: DataFrame) -> DataFrame:
    return df.withColumn(HOUR, hour_of(F.col("event_ts")))


def label_columns(as_of: datetime | Column | None = None) -> dict[str, Column]:
    label = F.col("isFraud").cast("double")
    elapsed = F.unix_timestamp(moment(as_of)) - F.unix_timestamp("event_ts")
    return {
        "isFraud": label,
        "is_label_available": label.isNotNull(),
        "label_delay_hours": F.when(label.isNotNull(), elapsed / F.lit(3600.0)),
    }


def reconcile(
    scored: DataFrame,
    labels: DataFrame,
    as_of: datetime | Column | None = None,
    load: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Scored rows with their label where one has arrived. ``labels`` must be unique per key. Those of a table in
    buckets of it are not shuffled; ``load`` must then come from ``business_key_load(.., stored=True)``."""
    if are_stored(labels):
        keyed, right = scored.withColumns(stored_keys()), labels.select(*STORED_KEYS, "isFraud")
        joined = bucketed_join(keyed, right, STORED_KEYS, "left", load, hot_rows).drop(*stored_keys())
    else:
        # The amount goes first for the same reason as in keep_first.
        keys = sorted(JOIN_KEYS, key=lambda c: c != "amount")
        joined = spread_join(scored, labels.select(*JOIN_KEYS, "isFraud"), keys, "left", load, hot_rows)
    return joined.withColumns(label_columns(as_of))


def business_key_load(silver: DataFrame, stored: bool = False) -> DataFrame:
    """Key histogram of silver before deduplication, so that it costs no second dedup; ``stored`` for a join with stored labels."""
    if stored:
        return key_load(silver.withColumns(stored_keys()), STORED_KEYS)
    return key_load(silver, sorted(JOIN_KEYS, key=lambda c: c != "amount"))


def hourly_monitoring(reconciled: DataFrame) -> DataFrame:
    """Counts, score statistics and rates per hour and type."""
    alerts = F.count_if(F.col("is_alert"))
    return (
        reconciled.groupBy(hour_of(F.col("event_ts")).alias(HOUR), "type")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            alerts.alias("alert_count"),
            F.avg("fraud_score").alias("avg_fraud_score"),
            F.percentile_approx("fraud_score", 0.95).alias("p95_fraud_score"),
            F.avg(F.when(F.col("is_label_available"), F.col("isFraud"))).alias("observed_fraud_rate"),
        )
        .withColumn("alert_rate", F.col("alert_count") / F.col("txn_count"))
    )
