"""Training sets: class weights, deterministic splits, row caps and refresh gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.keys import cents, split_name
from tallyward.schemas import ENGINEERED, JOIN_KEYS, MONEY


def labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("isFraud").isNotNull())


def class_weights(df: DataFrame) -> DataFrame:
    """One row: class counts (at least 1 each) and the weight of each class."""
    counts = df.agg(
        F.greatest(F.count_if(F.col("isFraud") == 1), F.lit(1)).alias("fraud_count"),
        F.greatest(F.count_if(F.col("isFraud") == 0), F.lit(1)).alias("nonfraud_count"),
    )
    total = F.col("fraud_count") + F.col("nonfraud_count")
    return counts.select(
        "fraud_count", "nonfraud_count", total.alias("total_count"),
        (total / (F.lit(2.0) * F.col("fraud_count"))).alias("fraud_weight"),
        (total / (F.lit(2.0) * F.col("nonfraud_count"))).alias("nonfraud_weight"),
    )


def weight_of(fraud_weight: Column, nonfraud_weight: Column) -> Column:
    return F.when(F.col("isFraud") == 1, fraud_weight).otherwise(nonfraud_weight)


def with_class_weight(df: DataFrame) -> DataFrame:
    """Add ``class_weight`` through a scalar subquery: no join and no driver round trip."""
    weights = class_weights(df).select(F.struct("fraud_weight", "nonfraud_weight").alias("w")).scalar()
    return (
        df.withColumn("_weights", weights)
        .withColumn("class_weight", weight_of(F.col("_weights.fraud_weight"), F.col("_weights.nonfraud_weight")))
        .drop("_weights")
    )


def split(df: DataFrame) -> DataFrame:
    """70 / 15 / 15 split by a hash of the business key: the same row always lands alike."""
    return df.withColumn(
        "dataset_split", split_name(F.pmod(F.xxhash64(*[F.col(c) for c in JOIN_KEYS]), F.lit(100))))


def key_digest() -> Column:
    """Hex md5 of the business key, spelled so that other engines can repeat it."""
    return F.md5(F.concat_ws("|", *[
        (cents(F.col(c)) if c in MONEY else F.col(c)).cast("string") for c in JOIN_KEYS]))


def split_by_digest(df: DataFrame) -> DataFrame:
    """The same split over an md5 bucket instead of xxhash64."""
    bucket = F.conv(F.substring(key_digest(), 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("dataset_split", split_name(bucket))


def training_dataset(reconciled: DataFrame) -> DataFrame:
    return split(with_class_weight(reconciled.where(F.col("is_label_available"))))


def training_join(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct scored business keys with their features and label, for labelled keys only.

    Duplicates of a key keep the smallest value of each feature as one struct, so the
    features of a row always belong together.
    """
    features = [c for c in ENGINEERED if c in scored.columns]
    keys = scored.select(*JOIN_KEYS, *features)
    if features:
        unique = (
            keys.groupBy(*JOIN_KEYS).agg(F.min(F.struct(*features)).alias("_f"))
            .select(*JOIN_KEYS, *[F.col(f"_f.{c}").alias(c) for c in features])
        )
    else:
        unique = keys.distinct()
    # Both sides hold one row per key, so no key can be hot.
    return unique.join(labels.select(*JOIN_KEYS, F.col("isFraud").cast("double").alias("isFraud")), JOIN_KEYS)


def cap_rows(df: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows, chosen by key digest, so the choice does not depend on file order.

    A histogram over the first four hex digits finds the digest range that holds enough
    rows; only that range is ranked. Equal rows travel as one row with a count.
    """
    if rows <= 0:
        return df
    prefix = F.conv(F.substring(key_digest(), 1, 4), 16, 10).cast("int")
    histogram = df.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # At most 65,536 histogram rows go through this unpartitioned window.
    running = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    last = (
        histogram.select("_p", F.coalesce(running, F.lit(0)).alias("_before"))
        .where(F.col("_before") < rows)
        .agg(F.max("_p").alias("last"))
    )
    candidates = df.withColumn("_p", prefix).where(F.col("_p") <= last.scalar()).drop("_p")
    counted = (
        candidates.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_digest", key_digest())
        .orderBy("_digest", *df.columns).limit(rows)
    )
    # At most ``rows`` rows are left here.
    order = Window.orderBy("_digest", *df.columns).rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(rows) - F.coalesce(F.sum("_copies").over(order), F.lit(0))
    return (
        counted.withColumn("_take", F.least(F.col("_copies"), room))
        .where(F.col("_take") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_take"))))
        .select(*df.columns)
    )


def refresh_gate(df: DataFrame) -> DataFrame:
    """One row: label counts, whether a refresh may run and why not."""
    label = F.col("isFraud").cast("int")
    counts = df.agg(
        F.count(label).alias("labelled_rows"),
        F.count_if(label == 1).alias("fraud_rows"),
        F.count_if(label == 0).alias("nonfraud_rows"),
        F.count_if(~label.isin(0, 1)).alias("other_rows"),
    )
    both = (F.col("fraud_rows") > 0) & (F.col("nonfraud_rows") > 0) & (F.col("other_rows") == 0)
    return counts.select(
        "*",
        both.alias("may_refresh"),
        F.when(F.col("labelled_rows") == 0, F.lit("no labelled rows"))
        .when(~both, F.lit("labels are not exactly {0, 1}"))
        .otherwise(F.lit("ok")).alias("reason"),
    )
