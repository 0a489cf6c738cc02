"""Assertions over built tables, and parity between two builds.

Checks return the violating rows, so an empty result is a pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Acceptance limits of the parity checks, and the keys each table asserts.
ROWCOUNT_LIMIT = 0.005
KPI_LIMIT = 0.01
UNIQUE_KEYS = {
    "dim_account": ["account_key"],
    "dim_time_hour": ["time_hour_utc"],
    "dim_transaction_type": ["transaction_type_key"],
    "fct_scored_transactions": ["transaction_key"],
}
NOT_NULL = {
    "dim_account": ["account_key", "account_id"],
    "dim_time_hour": ["time_hour_utc"],
    "dim_transaction_type": ["transaction_type_key", "transaction_type"],
    "fct_scored_transactions": ["transaction_key"],
    "fct_fraud_alerts": ["transaction_key"],
    "mart_fraud_hourly_kpis": ["event_hour_utc", "transaction_type"],
}
FOREIGN_KEYS = [
    ("origin_account_key", "dim_account", "account_key"),
    ("destination_account_key", "dim_account", "account_key"),
    ("transaction_type_key", "dim_transaction_type", "transaction_type_key"),
]


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``column_name``, ``null_rows``, ``total_rows`` per column, in one pass over the table."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols],
    )
    return counted.unpivot(["total_rows"], cols, "column_name", "null_rows").select(
        "column_name", "null_rows", "total_rows")


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return null_counts(df, cols).where(F.col("null_rows") > 0)


def check_fk(fact: DataFrame, fk: str, dim: DataFrame, pk: str, row_key: str = "transaction_key") -> DataFrame:
    """``row_key`` of the fact rows whose foreign key is missing from the dimension.

    The distinct foreign keys are compared first, so a hot key is one row there; the fact
    is only read again, by semi join, for keys that turned out to be orphans.
    """
    orphans = (
        fact.where(F.col(fk).isNotNull()).select(fk).distinct()
        .join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")
    )
    return fact.select(row_key, fk).join(orphans, fk, "left_semi").select(row_key)


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Per expected column: its type, the type found, whether they agree, and null rows."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(*[
        (F.count_if(F.col(f.name).isNull()) if f.name in found else F.count(F.lit(1))).alias(f.name)
        for f in expected.fields])
    lines = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("expected_type"),
            F.lit(found.get(f.name, "missing")).alias("actual_type"),
            F.lit(found.get(f.name) == f.dataType.simpleString()).alias("matches"),
            # Every row lacks a value for a missing column.
            F.col(f.name).alias("null_rows"),
        )
        for f in expected.fields
    ]
    return counts.select(F.inline(F.array(*lines)))


def parity_rowcount(a: DataFrame, b: DataFrame, limit: float = ROWCOUNT_LIMIT) -> DataFrame:
    """One row: both counts, their relative difference and whether it is within the limit."""
    sides = a.agg(F.count(F.lit(1)).alias("n")).select(F.col("n").alias("rows_a"), F.lit(None).cast("bigint").alias("rows_b")).unionByName(
        b.agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("bigint").alias("rows_a"), F.col("n").alias("rows_b")))
    both = sides.agg(F.max("rows_a").alias("rows_a"), F.max("rows_b").alias("rows_b"))
    delta = F.try_divide(F.abs(F.col("rows_b") - F.col("rows_a")).cast("double"), F.col("rows_a").cast("double"))
    return both.select(
        "rows_a", "rows_b", delta.alias("relative_delta"),
        F.coalesce(delta <= limit, F.col("rows_b") == 0).alias("within_limit"))


def parity_kpi(a: DataFrame, b: DataFrame, kpi: str = "observed_fraud_rate", limit: float = KPI_LIMIT) -> DataFrame:
    """Both sides' KPI per hour and type, newest hour first. A group that one side lacks is not within the limit."""
    key = ["event_hour_utc", "transaction_type"]
    joined = a.select(*key, F.col(kpi).alias("rate_a"), F.lit(True).alias("in_a")).join(
        b.select(*key, F.col(kpi).alias("rate_b"), F.lit(True).alias("in_b")), key, "full")
    rate_a, rate_b = F.coalesce("rate_a", F.lit(0.0)), F.coalesce("rate_b", F.lit(0.0))
    delta = F.abs(rate_b - rate_a)
    return joined.select(
        *key, "rate_a", "rate_b", delta.alias("abs_delta"),
        (F.col("in_a").isNotNull() & F.col("in_b").isNotNull() & (delta <= F.lit(limit) * F.abs(rate_a))).alias("within_limit"),
    ).orderBy(F.desc("event_hour_utc"), "transaction_type")
