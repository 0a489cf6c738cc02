"""The jobs a user runs: each reads tables, applies operators and writes tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.keys import hour_of
from tallyward.operators import quality, reconcile, training, warehouse
from tallyward.operators.model import Trained, refresh, train_baseline
from tallyward.plans.durable import durable
from tallyward.schemas import CURATED, HOUR, MART, MONITORING, RETRAINING, SOURCE_ID
from tallyward.sources import lake, models, sinks

# Names of the hourly outputs and of the warehouse tables.
HOURLY_TABLES = ["curated_scored", "retraining_dataset", "monitoring_hourly"]
WAREHOUSE_TABLES = [
    "dim_account", "dim_transaction_type", "dim_time_hour",
    "fct_scored_transactions", "fct_fraud_alerts", "mart_fraud_hourly_kpis",
]
# Levels at which figures of accounts are kept: an update reads the hours of a day, the days of a month and all months.
ACCOUNT_LEVELS = ["hour", "day", "month"]


def hourly(
    spark: SparkSession, silver: DataFrame, labels: DataFrame, out: str,
    target_hour: str | None = None, as_of: datetime | None = None, elsewhere: DataFrame | None = None,
) -> dict[str, int]:
    """Deduplicate silver, attach labels, write curated / retraining / monitoring by hour and
    return row counts. Where ``silver`` is the target hour alone, ``elsewhere`` holds the rest, read
    only for repeats of messages without an event time. A table of ``store_labels`` as ``labels`` is
    not shuffled, and of it the steps of the window alone are read.

    Curated is written first and is the input of the other two tables, so the
    deduplication and the join run once and survive lost executors. The label delay of all
    rows counts from one moment. Row counts come from the written tables: counters kept
    while writing would count the rows of a repeated task twice.
    """
    as_of = as_of or datetime.now(timezone.utc)
    window = reconcile.filter_hour(silver, target_hour)
    identified = set(SOURCE_ID) <= set(silver.columns)
    span = window.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_if(reconcile.lacks_event_time()) if identified else F.lit(0)).alias("untimed"),
        # Hours, not rows, come to the driver.
        F.collect_set(hour_of(F.col("event_ts"))).alias("hours"),
        F.min("step").alias("first_step"), F.max("step").alias("last_step"),
    ).first()
    if not span["hours"]:
        raise ValueError("The chosen window holds no scored transactions.")
    delivered = window
    if target_hour and span["untimed"]:
        delivered = window.unionByName(reconcile.repeats_elsewhere(silver, target_hour, elsewhere))
    scored = reconcile.filter_hour(reconcile.dedup_scored(delivered), target_hour)
    due = labels.where(F.col("step").between(F.lit(span["first_step"]), F.lit(span["last_step"])))
    load = reconcile.business_key_load(window, stored=reconcile.are_stored(labels))
    joined = reconcile.reconcile(scored, reconcile.dedup_labels(due), as_of, load=load)
    sinks.write_hourly(reconcile.with_hour(joined).select(*CURATED.fieldNames()), f"{out}/curated_scored")

    def this_run(name: str, schema: T.StructType) -> DataFrame:
        """The hours of this run only: earlier runs may have left others in the table."""
        return spark.read.schema(schema).parquet(f"{out}/{name}").where(
            F.col(HOUR).between(F.lit(min(hours)), F.lit(max(hours))))

    hours = [h.astimezone(timezone.utc) for h in span["hours"]]
    # Of the curated table only the hours that this run has rows of.
    curated = this_run("curated_scored", CURATED).where(F.col(HOUR).isin(hours))
    sinks.write_hourly(
        training.training_dataset(curated).select(*RETRAINING.fieldNames()), f"{out}/retraining_dataset")
    sinks.write_hourly(
        reconcile.hourly_monitoring(curated).select(*MONITORING.fieldNames()), f"{out}/monitoring_hourly")
    counts = curated.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_label_available").alias("labelled"),
        F.collect_set(HOUR).alias("hours"), F.collect_set(F.when(F.col("isFraud").isNotNull(), F.col(HOUR))).alias("labelled_hours"),
    ).first()
    for name, schema in (("curated_scored", CURATED), ("retraining_dataset", RETRAINING), ("monitoring_hourly", MONITORING)):
        # An hour of an earlier run that has no rows now is emptied.
        now = {h.astimezone(timezone.utc) for h in counts["labelled_hours" if name == "retraining_dataset" else "hours"]}
        held = {h for h in lake.stored_periods(spark, f"{out}/{name}", HOUR) if min(hours) <= h <= max(hours)}
        sinks.clear_hours(spark, f"{out}/{name}", sorted(held - now), schema)
    return {
        "silver_rows": span["rows"],
        "curated_rows": counts["rows"],
        "labelled_rows": counts["labelled"],
        "retraining_rows": this_run("retraining_dataset", RETRAINING).count(),
        "monitoring_rows": this_run("monitoring_hourly", MONITORING).count(),
    }


def hourly_from_lake(
    spark: SparkSession, silver_path: str, labels: DataFrame, out: str,
    target_hour: str | None = None, as_of: datetime | None = None,
) -> dict[str, int]:
    """The hourly job over a stored silver table. Of one that the scoring stream wrote, a target hour reads its own folders."""
    silver = lake.read_silver(spark, silver_path, target_hour)
    elsewhere = spark.read.parquet(silver_path).select(*silver.columns) if target_hour else None
    return hourly(spark, silver, labels, out, target_hour, as_of, elsewhere)


def load(
    spark: SparkSession, base: str, database: str, tables: list[str] | None = None,
    disposition: str = "WRITE_TRUNCATE", create_database: bool = True, location: str | None = None,
) -> list[str]:
    """Load hourly outputs into warehouse tables and return their names."""
    names = sinks.clean_table_names(tables or HOURLY_TABLES)
    sinks.ensure_database(spark, database, create_database, location)
    loaded = []
    for name in names:
        source = lake.read_table_layout(spark, base, name)
        sinks.load_table(source, f"{database}.{name}", disposition,
                         partition_by=HOUR if HOUR in source.columns else None)
        loaded.append(f"{database}.{name}")
    return loaded


@dataclass(frozen=True)
class Warehouse:
    tables: dict[str, DataFrame]
    violations: dict[str, DataFrame]

    def failed(self) -> dict[str, int]:
        """Number of violating rows per failed assertion, from one Spark job over all checks."""
        counts = [
            rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
            for name, rows in self.violations.items()
        ]
        return {r["name"]: r["n"] for r in reduce(DataFrame.unionByName, counts).where("n > 0").collect()}


def assertions(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    checks: dict[str, DataFrame] = {}
    for table, keys in quality.UNIQUE_KEYS.items():
        checks[f"unique_{table}"] = quality.check_unique(tables[table], keys)
    for table, columns in quality.NOT_NULL.items():
        checks[f"not_null_{table}"] = quality.check_not_null(tables[table], columns)
    fact = tables["fct_scored_transactions"]
    for fk, dim, pk in quality.FOREIGN_KEYS:
        checks[f"fk_{fk}"] = quality.check_fk(fact, fk, tables[dim], pk)
    return checks


def build_warehouse(
    spark: SparkSession, curated: DataFrame, monitoring: DataFrame, out: str, hours: list[datetime] | None = None,
) -> Warehouse:
    """Staging, facts, mart, dimensions and assertions. Each table is written once; later models and the assertions read
    the written tables.

    With ``hours`` a warehouse that was built before is brought in line with those hours of the curated table, and no
    other hour of curated or of the facts is read: facts and account figures of the hours are replaced, the figures of
    their days and months merged again, ``dim_account`` comes from the months, the small dimensions from the mart. Hours
    that lost all their rows are emptied. Facts are checked in the hours only, which is enough for the uniqueness of their
    keys, as a key holds the event time.
    """
    def changed(unit: str, column: str) -> Column:
        if hours is None:
            return F.lit(True)
        return F.date_trunc(unit, F.col(column)).isin([F.date_trunc(unit, F.lit(h)) for h in hours])

    def read(name: str, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{out}/{name}").select(*schema.fieldNames())

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/{name}")
        return read(name, df.schema)

    def put(name: str, df: DataFrame, by: str, unit: str, periods: DataFrame) -> DataFrame:
        """Replace the table, or of the changed hours its periods ``by``; those that ``periods`` has no rows of are emptied.
        Returns what was written."""
        part = changed(unit, by)
        mode = "static" if hours is None else "dynamic"
        df.write.partitionBy(by).mode("overwrite").option("partitionOverwriteMode", mode).parquet(f"{out}/{name}")
        if hours is not None:
            held = {r[0] for r in read(name, df.schema).where(part).select(by).distinct().collect()}
            now = {r[0] for r in periods.select(by).distinct().collect()}
            sinks.clear_hours(spark, f"{out}/{name}", sorted(held - now), df.schema, by)
        return read(name, df.schema).where(part)

    stg = warehouse.stg_curated(curated.where(changed("hour", HOUR)))
    stg_mon = warehouse.stg_monitoring(monitoring.where(changed("hour", HOUR)))
    # Curated files hold one hour each, so cutting the facts by hour needs no shuffle.
    fact = put("fct_scored_transactions", warehouse.fct_scored(stg), "event_hour_utc", "hour", stg)
    alerts = put("fct_fraud_alerts", warehouse.fct_alerts(fact), "event_hour_utc", "hour", warehouse.fct_alerts(fact))

    partial = warehouse.account_touches(stg)
    for unit in ACCOUNT_LEVELS:
        name = f"account_touches_{unit}"
        finer = partial.where(changed(unit, "period")).withColumn("period", F.date_trunc(unit, "period"))
        merged = warehouse.merge_touches(finer, "period")
        put(name, merged.hint("rebalance", F.col("period")), "period", unit, finer)
        partial = read(name, merged.schema)

    day = F.date_trunc("day", "event_hour_utc").alias("period")
    mart = warehouse.mart_kpis(fact, stg_mon).select("*", day)
    if hours is not None:
        rest = read("mart_fraud_hourly_kpis", mart.schema).where(changed("day", "period") & ~changed("hour", "event_hour_utc"))
        mart = durable(rest.unionByName(mart), "mart")
    put("mart_fraud_hourly_kpis", mart.hint("rebalance", F.col("period")), "period", "day", mart)
    mart = read("mart_fraud_hourly_kpis", mart.schema)
    tables = {
        "dim_account": stored("dim_account", warehouse.dim_account_of(partial)),
        "dim_transaction_type": stored("dim_transaction_type", warehouse.dim_transaction_type(mart)),
        "dim_time_hour": stored("dim_time_hour", warehouse.dim_time_hour(mart)),
        "fct_scored_transactions": read("fct_scored_transactions", fact.schema),
        "fct_fraud_alerts": read("fct_fraud_alerts", alerts.schema),
        "mart_fraud_hourly_kpis": mart.select(*MART.fieldNames()),
    }
    return Warehouse(tables, assertions({**tables, "fct_scored_transactions": fact, "fct_fraud_alerts": alerts}))


def refresh_from_lake(
    spark: SparkSession, silver: DataFrame, labels: DataFrame, out: str | None, **options: Any,
) -> tuple[bool, str, Trained | None]:
    """Daily refresh from silver and labels instead of the retraining table."""
    joined = training.training_join(reconcile.dedup_scored(silver), reconcile.dedup_labels(labels))
    return refresh(durable(joined, "refresh"), out, **options)


def refresh_model(
    spark: SparkSession, retraining: str, out: str | None, **options: Any,
) -> tuple[bool, str, Trained | None]:
    """Daily refresh from the retraining table."""
    return refresh(lake.read_retraining(spark, retraining), out, **options)


def train_first_model(spark: SparkSession, labels_csv: str, out: str, **options: Any) -> Trained:
    """Baseline model from the labelled CSV alone."""
    trained = train_baseline(lake.read_labels(spark, labels_csv), **options)
    models.serve(spark, out, models.add_version(spark, out, trained.model))
    return trained


def last_full_hour(now: datetime | None = None) -> str:
    """The hour an hourly schedule should process: the one that ended last."""
    now = now or datetime.now(timezone.utc)
    return (now - timedelta(hours=1)).strftime("%Y-%m-%d-%H")
