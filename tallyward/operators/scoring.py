"""Typing, features and alert rules of the scoring path."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import coercion as C
from tallyward.schemas import JOIN_KEYS, MONEY

# Default thresholds of the alert rules and the velocity bucket.
SCORE_THRESHOLD = 0.8
AMOUNT_THRESHOLD = 200_000.0
VELOCITY_THRESHOLD = 5
VELOCITY_SECONDS = 300
OUTGOING_TYPES = ["TRANSFER", "CASH_OUT"]

# An account with more transactions than this in one time bucket is split.
HOT_ACCOUNT_ROWS = 4_000_000


def coerce_keys(df: DataFrame) -> DataFrame:
    """Type the nine business columns: numbers default to 0, text to ``UNKNOWN``."""
    typed = {c: C.to_double(F.col(c), df.schema[c].dataType) for c in MONEY}
    typed["step"] = C.to_int(F.col("step"), df.schema["step"].dataType)
    typed["type"] = C.to_type_code(F.col("type"))
    typed["nameOrig"] = C.to_text(F.col("nameOrig"))
    typed["nameDest"] = C.to_text(F.col("nameDest"))
    return df.withColumns({c: typed[c] for c in JOIN_KEYS})


def coerce(df: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Type a raw micro-batch and add ``event_ts``."""
    return coerce_keys(df).withColumn("event_ts", C.event_time(F.col("event_emitted_at_utc"), as_of))


def time_slot(ts: Column, seconds: int = VELOCITY_SECONDS) -> Column:
    return F.floor(F.unix_timestamp(ts) / F.lit(seconds))


def add_velocity(
    df: DataFrame, seconds: int = VELOCITY_SECONDS, hot_rows: int = HOT_ACCOUNT_ROWS,
    earlier: DataFrame | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Transactions of the same origin account in the same time bucket, on every row.

    Counted by a map-side-combined aggregate and joined back, because a window over
    (account, bucket) would hold a hot account's rows in one task. A count above
    ``hot_rows`` is copied once per piece of that size, and the rows it belongs to are
    spread over the pieces by a hash of their other columns. Rows of ``earlier`` count as
    well but are not returned. Accounts of different values in ``by`` are different ones.
    """
    key = [*by, "_account", "_slot"]

    def slotted(rows: DataFrame) -> DataFrame:
        return rows.withColumns({
            "_account": F.coalesce("nameOrig", F.lit(C.UNKNOWN)),
            "_slot": F.coalesce(time_slot(F.col("event_ts"), seconds), F.lit(-1)),
        })

    counted = slotted(df).select(*key)
    if earlier is not None:
        counted = counted.unionByName(slotted(earlier).select(*key))
    counts = (
        counted.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_pieces", F.ceil(F.col("_n") / F.lit(hot_rows)))
    )
    # Each row here stands for over hot_rows input rows, so its size is bounded by their number.
    hot = F.broadcast(counts.where(F.col("_n") > hot_rows).select(*key, "_pieces"))
    rest = F.xxhash64(*[F.col(c) for c in df.columns])
    salt = F.when(F.col("_pieces").isNotNull(), F.pmod(rest, F.col("_pieces"))).otherwise(F.lit(0))
    salted = slotted(df).join(hot, key, "left").withColumn("_salt", salt).drop("_pieces")
    copies = counts.select(
        *key, F.col("_n").cast("double").alias("velocity_5min"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)).alias("_salt"))
    return salted.join(copies, [*key, "_salt"], "left").select(*df.columns, "velocity_5min")


def apply_velocity_rule(df: DataFrame, velocity: float = VELOCITY_THRESHOLD) -> DataFrame:
    """The flags that depend on ``velocity_5min``, after it has changed."""
    high = F.col("velocity_5min") >= F.lit(float(velocity))
    others = F.col("rule_high_score") | F.col("rule_high_amount_transfer")
    return df.withColumns({"rule_high_velocity": high, "is_alert": others | high})


def balance_features() -> dict[str, Column]:
    amount, old_org, new_org = F.col("amount"), F.col("oldbalanceOrg"), F.col("newbalanceOrig")
    old_dest, new_dest = F.col("oldbalanceDest"), F.col("newbalanceDest")
    return {
        "balance_change_ratio": F.when(old_org > 0, amount / old_org).otherwise(F.lit(0.0)),
        "is_new_merchant": F.when((old_dest == 0) & (new_dest == 0), F.lit(1.0)).otherwise(F.lit(0.0)),
        "origin_balance_delta": old_org - new_org,
        "dest_balance_delta": new_dest - old_dest,
    }


def add_balance_features(df: DataFrame) -> DataFrame:
    return df.withColumns(balance_features())


def engineer(df: DataFrame, seconds: int = VELOCITY_SECONDS, earlier: DataFrame | None = None) -> DataFrame:
    return add_balance_features(add_velocity(df, seconds, earlier=earlier))


def apply_rules(
    df: DataFrame,
    score: float = SCORE_THRESHOLD,
    amount: float = AMOUNT_THRESHOLD,
    velocity: float = VELOCITY_THRESHOLD,
) -> DataFrame:
    """Three rule flags and ``is_alert``, their disjunction."""
    high_score = F.col("fraud_score") >= F.lit(score)
    high_amount = F.col("type").isin(OUTGOING_TYPES) & (F.col("amount") >= F.lit(amount))
    high_velocity = F.col("velocity_5min") >= F.lit(float(velocity))
    return df.withColumns({
        "rule_high_score": high_score,
        "rule_high_amount_transfer": high_amount,
        "rule_high_velocity": high_velocity,
        "is_alert": high_score | high_amount | high_velocity,
    })


def model_features(df: DataFrame) -> DataFrame:
    """Typed model inputs: a stored feature is used where its column exists and recomputed
    where it does not; nulls become 0."""
    typed = coerce_keys(df) if "nameOrig" in df.columns else df.withColumns(
        {c: C.to_double(F.col(c), df.schema[c].dataType) for c in MONEY}
        | {"step": C.to_int(F.col("step"), df.schema["step"].dataType),
           "type": C.to_type_code(F.col("type"))}
    )
    recomputed = {"velocity_5min": F.lit(0.0), **balance_features()}
    features = {
        name: F.coalesce(F.col(name).cast("double") if name in df.columns else expr, F.lit(0.0))
        for name, expr in recomputed.items()
    }
    return typed.withColumns(features).withColumn(
        "isFraud", C.to_double(F.col("isFraud"), df.schema["isFraud"].dataType, None))
