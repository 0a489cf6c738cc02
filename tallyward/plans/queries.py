"""One query per operator, over the transactions derived from the supplied tables.

Results are made comparable across engines: timestamps, dates and booleans as text,
doubles rounded to six places.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyward.functions.coercion import to_bool
from tallyward.functions.keys import TIMESTAMP_TEXT, timestamp_text
from tallyward.operators import envelope, quality, quantiles, reconcile, reports, scoring, training, warehouse
from tallyward.operators.model import exact_auc, refresh, score, train_baseline
from tallyward.plans import fixture as fx
from tallyward.plans import jobs
from tallyward.plans.durable import durable, scratch
from tallyward.schemas import (
    BRONZE, CURATED, ENGINEERED, FCT_SCORED, HOUR, JOIN_KEYS, LABELLED_CSV, MESSAGE, RETRAINING, RULE_FLAGS, SILVER, SOURCE_ID,
)
from tallyward.sources import events, lake, models, sinks
from tallyward.sources.event_log import read_event_log
from tallyward.sources.message_log import append_segment, read_message_log
from tallyward.streaming.metrics import accounted, read_progress, recorded_progress
from tallyward.streaming.score import Settings, Sinks, score_stream
from tallyward.streaming.velocity import state_partitions, stream_dedup, stream_velocity

Query = Callable[[SparkSession, str], DataFrame]
TARGET_HOUR = "2024-01-01-05"
EMPTY_HOUR = "2024-01-01-07"
# Micro-batches of the streams that are fed in turns, and files of each.
TURNS, FILES = 8, 4
MONTH = (datetime(2024, 1, 1, 2, tzinfo=timezone.utc), datetime(2024, 1, 1, 9, tzinfo=timezone.utc))


def comparable(df: DataFrame) -> DataFrame:
    def shown(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return timestamp_text(col)
        if isinstance(field.dataType, (T.DateType, T.BooleanType)):
            return col.cast("string")
        if isinstance(field.dataType, T.DoubleType):
            # The shift keeps the last bit of a sum from deciding a half-way case.
            return F.round(col + F.lit(1e-9), 6)
        if isinstance(field.dataType, T.DecimalType):
            return F.round(col.cast("double"), 4)
        return col

    return df.select(*[shown(f).alias(f.name) for f in df.schema.fields])


def _tagged(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    frames = [df.select(F.lit(name).alias(tag), "*") for name, df in parts.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


# --- scoring ---------------------------------------------------------------------------

def coerce_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(scoring.coerce_keys(fx.raw_strings(spark, sf)).select("source_offset", *JOIN_KEYS))


def event_time(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(scoring.coerce(fx.raw_strings(spark, sf), fx.AS_OF).select("source_offset", "event_ts"))


def velocity_5min(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(scoring.add_velocity(fx.transactions(spark, sf)).select(
        "source_offset", "nameOrig", "event_ts", "velocity_5min"))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(scoring.add_balance_features(fx.transactions(spark, sf)).select(
        "source_offset", *[c for c in ENGINEERED if c != "velocity_5min"]))


def alert_rules(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(fx.scored(spark, sf).select(
        "source_offset", "type", "amount", "fraud_score", "velocity_5min", *RULE_FLAGS, "is_alert"))


def to_bool_query(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("source_offset").cast("bigint")
    spellings = [" TRUE ", "t", "1", "Yes", "y", "false", "F", "0", "no", "n", "maybe", ""]
    written = fx.transactions(spark, sf).select(
        "source_offset",
        F.element_at(F.array(*[F.lit(s) for s in spellings]), (n % len(spellings) + 1).cast("int")).alias("as_text"),
        (n % 3).cast("double").alias("as_number"),
        (n % 2 == 0).alias("as_flag"),
    )
    return comparable(written.select("source_offset", *[
        to_bool(F.col(f.name), f.dataType).alias(f.name) for f in written.schema.fields[1:]]))


def model_features(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("source_offset").cast("bigint")
    stored = fx.curated(spark, sf).withColumn(
        "balance_change_ratio", F.when(n % 7 != 0, F.col("balance_change_ratio")))
    bare = fx.transactions(spark, sf)
    picked = ["source_offset", *ENGINEERED, "isFraud"]
    return comparable(_tagged({
        "stored": scoring.model_features(stored).select(*picked),
        "recomputed": scoring.model_features(bare).select(*picked),
    }, "features_from"))


# --- hourly job ------------------------------------------------------------------------

_SHOWN = [*SOURCE_ID, "kafka_ingest_ts", "event_ts", "type", "amount", "velocity_5min", "fraud_score", "is_alert"]


def dedup_scored(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(reconcile.dedup_scored(fx.with_duplicates(fx.silver(spark, sf))).select(*_SHOWN))


def dedup_scored_fallback(spark: SparkSession, sf: str) -> DataFrame:
    anonymous = fx.with_duplicates(fx.silver(spark, sf)).drop(*SOURCE_ID)
    return comparable(reconcile.dedup_scored(anonymous).select(*_SHOWN[3:], *[c for c in JOIN_KEYS if c not in _SHOWN]))


def labels_unique(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(reconcile.dedup_labels(fx.labels(spark, sf)))


def _label_csv(spark: SparkSession, sf: str) -> str:
    path = scratch(spark, "labels")
    text = fx.transactions(spark, sf).withColumn("isFlaggedFraud", (F.col("amount") > 200000).cast("int"))
    text.select(*[F.col(c).cast("string").alias(c) for c in LABELLED_CSV.fieldNames()]).write.option(
        "header", True).csv(path)
    return path


def labels_scan(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(lake.read_labels(spark, _label_csv(spark, sf)))


def reconcile_labels(spark: SparkSession, sf: str) -> DataFrame:
    delivered = durable(fx.with_duplicates(fx.silver(spark, sf)), "silver")
    matched = reconcile.reconcile(
        reconcile.dedup_scored(delivered), reconcile.dedup_labels(fx.labels(spark, sf)), fx.AS_OF,
        load=reconcile.business_key_load(delivered))
    return comparable(matched.select(*_SHOWN, "isFraud", "is_label_available", "label_delay_hours"))


def reconcile_labels_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """As reconcile_labels, with labels that came in two loads of a table in buckets of the business key; every part of
    the key space with more than one row counts as hot."""
    delivered = durable(fx.with_duplicates(fx.silver(spark, sf)), "silver")
    base = scratch(spark, "labels")
    table = f"labels_{base[-8:]}.by_key"
    sinks.ensure_database(spark, table.split(".")[0], location=base)
    known = durable(fx.labels(spark, sf), "labels")
    buckets = sinks.label_buckets(known.count())
    early = F.pmod(F.xxhash64(*JOIN_KEYS), F.lit(2)) == 0
    for part in (known.where(early), known.where(~early)):
        sinks.store_labels(part, table, buckets=buckets)
    matched = reconcile.reconcile(
        reconcile.dedup_scored(delivered), reconcile.dedup_labels(spark.table(table)), fx.AS_OF,
        load=reconcile.business_key_load(delivered, stored=True), hot_rows=1)
    return comparable(matched.select(*_SHOWN, "isFraud", "is_label_available", "label_delay_hours"))


def hour_filter(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(reconcile.filter_hour(fx.transactions(spark, sf), TARGET_HOUR).select(
        "source_offset", "event_ts", "type", "amount"))


def hourly_monitoring(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(reconcile.hourly_monitoring(fx.curated(spark, sf)))


def hourly_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """All hours with labels, then one hour again without any: only that hour may change."""
    out = scratch(spark, "hourly")
    delivered = durable(fx.with_duplicates(fx.silver(spark, sf)), "silver")
    known = fx.labels(spark, sf)
    jobs.hourly(spark, delivered, known, out, as_of=fx.AS_OF)
    jobs.hourly(spark, delivered, known.where(F.lit(False)), out, TARGET_HOUR, fx.AS_OF)
    return comparable(spark.read.parquet(f"{out}/curated_scored").select(
        "source_offset", HOUR, "isFraud", "is_label_available"))


def hourly_retraining_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """What the retraining table holds after one hour ran again without labels."""
    out = scratch(spark, "hourly")
    delivered = durable(fx.with_duplicates(fx.silver(spark, sf)), "silver")
    known = fx.labels(spark, sf)
    jobs.hourly(spark, delivered, known, out, as_of=fx.AS_OF)
    jobs.hourly(spark, delivered, known.where(F.lit(False)), out, TARGET_HOUR, fx.AS_OF)
    return comparable(spark.read.schema(RETRAINING).parquet(f"{out}/retraining_dataset").select("source_offset", HOUR, "isFraud"))


def batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    delivered = durable(fx.with_duplicates(fx.silver(spark, sf)), "silver")
    counts = jobs.hourly(spark, delivered, fx.labels(spark, sf), scratch(spark, "hourly"), as_of=fx.AS_OF)
    return spark.createDataFrame(list(counts.items()), "metric string, row_count bigint")


# --- warehouse -------------------------------------------------------------------------

def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The curated table as a job finds it: written, for models that read it wide or often."""
    return durable(fx.curated(spark, sf), "curated")


def _hourly(df: DataFrame) -> DataFrame:
    """The curated table as the hourly job leaves it: in folders by hour, whose files hold one hour each."""
    path = scratch(df.sparkSession, "curated")
    sinks.write_hourly(df.select(*CURATED.fieldNames()), path)
    return df.sparkSession.read.schema(CURATED).parquet(path).select(*CURATED.fieldNames())


def _stg(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.stg_curated(fx.curated(spark, sf))


def _monitoring_of(curated: DataFrame) -> DataFrame:
    return warehouse.stg_monitoring(reconcile.hourly_monitoring(curated))


def _fct_of(curated: DataFrame) -> DataFrame:
    return warehouse.fct_scored(warehouse.stg_curated(curated))


def _fct(spark: SparkSession, sf: str) -> DataFrame:
    return _fct_of(fx.curated(spark, sf))


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    curated = fx.curated(spark, sf)
    return warehouse.mart_kpis(_fct_of(curated), _monitoring_of(curated))


def _label_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("is_fraud_label", F.col("is_fraud_label").cast("double"))


def stg_curated_scored(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(_label_as_double(warehouse.stg_curated(_stored(spark, sf))))


def stg_monitoring_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(_monitoring_of(fx.curated(spark, sf)))


def dim_account(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(warehouse.dim_account(_stg(spark, sf)))


def dim_transaction_type(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(warehouse.dim_transaction_type(_stg(spark, sf)))


def dim_time_hour(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(warehouse.dim_time_hour(_stg(spark, sf)))


def fct_scored_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(_label_as_double(_fct_of(_stored(spark, sf))))


def fct_fraud_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(_label_as_double(warehouse.fct_alerts(_fct(spark, sf))))


def mart_fraud_hourly_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(_mart(spark, sf))


# --- quality ---------------------------------------------------------------------------

@cache
def _updated_warehouse(spark: SparkSession, sf: str) -> jobs.Warehouse:
    """A warehouse built while one hour lacked a third of its rows and had other amounts, another one lacked all and a third
    one had rows too many; then updated by those hours."""
    out = scratch(spark, "warehouse")
    right = _hourly(fx.curated(spark, sf))
    n, hour = F.col("source_offset").cast("bigint"), F.date_format(HOUR, "yyyy-MM-dd-HH")
    wrong = right.where((hour != TARGET_HOUR) | (n % 3 != 0)).where(hour != EMPTY_HOUR).withColumn(
        "amount", F.when(hour == TARGET_HOUR, F.col("amount") + 1.0).otherwise(F.col("amount")))
    moved = right.where(hour == TARGET_HOUR).withColumns({
        "event_ts": F.col("event_ts") + F.expr("interval 1 year"), HOUR: F.col(HOUR) + F.expr("interval 1 year"),
        "nameOrig": F.lit("gone")})
    # Tasks read whole hours, so a file of this one holds some hours whole.
    before = durable(wrong.unionByName(moved), "curated")
    jobs.build_warehouse(spark, before, reconcile.hourly_monitoring(before), out)
    hours = [reconcile.parse_hour(h) for h in (TARGET_HOUR, EMPTY_HOUR, TARGET_HOUR.replace("2024", "2025"))]
    return jobs.build_warehouse(spark, right, reconcile.hourly_monitoring(right), out, hours)


def warehouse_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly mart of an updated warehouse."""
    return comparable(_updated_warehouse(spark, sf).tables["mart_fraud_hourly_kpis"])


def warehouse_incremental_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """The accounts of an updated warehouse."""
    return comparable(_updated_warehouse(spark, sf).tables["dim_account"])


def warehouse_job(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each table that the warehouse job builds, and how many rows violate an assertion."""
    curated = _hourly(fx.curated(spark, sf))
    built = jobs.build_warehouse(spark, curated, reconcile.hourly_monitoring(curated), scratch(spark, "warehouse"))
    counted = {**built.tables, "violations": _tagged(
        {name: rows.select(F.lit(1).alias("one")) for name, rows in built.violations.items()}, "check")}
    return _tagged({name: rows.agg(F.count(F.lit(1)).alias("row_count")) for name, rows in counted.items()}, "table_name")


def load_job(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the tables after a load, a load that fails half-way and a second load of the same hours."""
    out = scratch(spark, "hourly")
    database = "loaded_" + out[-8:]
    curated = _stored(spark, sf)
    sinks.write_hourly(curated, f"{out}/curated_scored")
    sinks.write_hourly(training.training_dataset(curated).select(*RETRAINING.fieldNames()), f"{out}/retraining_dataset")
    sinks.write_hourly(reconcile.hourly_monitoring(curated), f"{out}/monitoring_hourly")
    names = jobs.load(spark, out, database, location=f"{out}/db")
    fails = F.when(F.col("source_offset") == "7", F.raise_error(F.lit("refused"))).otherwise(F.col("type").cast("string"))
    try:
        sinks.load_table(spark.table(names[0]).withColumn("type", fails), names[0], partition_by=HOUR)
    except Exception as error:  # the failure is part of the query
        if "refused" not in str(error):
            raise
    else:
        raise RuntimeError("the load should have failed")
    after_failure = {"curated_scored_after_failure": spark.table(names[0])}
    kept = durable(_tagged({n: t.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(HOUR).alias("hours"))
                            for n, t in after_failure.items()}, "table_name"), "kept")
    again = jobs.load(spark, out, database)
    return kept.unionByName(_tagged({
        n.split(".")[1]: spark.table(n).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(HOUR).alias("hours"))
        for n in again}, "table_name"))


def percentiles_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Per day, of each type and of all types: whether the merged 95th percentile stays within the stated error in rank."""
    curated = _stored(spark, sf)
    sketches = durable(quantiles.score_sketches(curated), "sketches")
    kinds = F.explode(F.array(F.col("type"), F.lit("ALL"))).alias("transaction_type")
    merged = quantiles.merged_percentile(
        sketches.select(F.to_date(HOUR).alias("event_date"), kinds, "txn_count", "score_sketch"), 0.95, "event_date", "transaction_type")
    rows = curated.select(F.to_date("event_ts").alias("event_date"), kinds, "fraud_score")
    share = lambda held: F.count_if(held) / F.count("fraud_score")
    ranks = rows.join(merged, ["event_date", "transaction_type"]).groupBy("event_date", "transaction_type", "txn_count").agg(
        share(F.col("fraud_score") < F.col("score_percentile")).alias("below"),
        share(F.col("fraud_score") <= F.col("score_percentile")).alias("up_to"))
    return comparable(ranks.select("event_date", "transaction_type", "txn_count", (
        (F.col("below") <= 0.95 + quantiles.RANK_ERROR) & (F.col("up_to") >= 0.95 - quantiles.RANK_ERROR)).alias("within_error")))


def _tables(stg: DataFrame, stg_mon: DataFrame) -> dict[str, DataFrame]:
    fct = warehouse.fct_scored(stg)
    return {
        "dim_account": warehouse.dim_account(stg),
        "dim_time_hour": warehouse.dim_time_hour(stg),
        "dim_transaction_type": warehouse.dim_transaction_type(stg),
        "fct_scored_transactions": fct,
        "fct_fraud_alerts": warehouse.fct_alerts(fct),
        "mart_fraud_hourly_kpis": warehouse.mart_kpis(fct, stg_mon),
    }


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Over data with messages delivered twice, so that the fact's key must be reported."""
    curated = _stored(spark, sf)
    tables = _tables(warehouse.stg_curated(fx.with_duplicates(curated)), _monitoring_of(curated))
    return comparable(_tagged({
        name: quality.check_unique(tables[name], keys).select(
            F.col(keys[0]).cast("string").alias("key"), "row_count")
        for name, keys in quality.UNIQUE_KEYS.items()
    }, "table_name"))


def dq_nonnull(spark: SparkSession, sf: str) -> DataFrame:
    """Over data with some transaction types missing."""
    n = F.col("source_offset").cast("bigint")
    curated = _stored(spark, sf)
    holed = curated.withColumn("type", F.when(n % 89 != 0, F.col("type")))
    tables = _tables(warehouse.stg_curated(holed), _monitoring_of(curated))
    return _tagged({
        name: quality.null_counts(tables[name], cols) for name, cols in quality.NOT_NULL.items()
    }, "table_name")


def dq_fk_origin(spark: SparkSession, sf: str) -> DataFrame:
    """Against a dimension that knows destination accounts only."""
    stg = _stg(spark, sf)
    dim = warehouse.dim_account(stg.withColumn("origin_account", F.lit(None).cast("string")))
    return quality.check_fk(warehouse.fct_scored(stg), "origin_account_key", dim, "account_key")


def dq_fk_destination(spark: SparkSession, sf: str) -> DataFrame:
    """Against a dimension that knows origin accounts only."""
    stg = _stg(spark, sf)
    dim = warehouse.dim_account(stg.withColumn("destination_account", F.lit(None).cast("string")))
    return quality.check_fk(warehouse.fct_scored(stg), "destination_account_key", dim, "account_key")


def dq_fk_type(spark: SparkSession, sf: str) -> DataFrame:
    """Against a dimension that knows the types of fraud rows only."""
    stg = _stg(spark, sf)
    dim = warehouse.dim_transaction_type(stg.where(F.col("is_fraud_label") == 1))
    return quality.check_fk(warehouse.fct_scored(stg), "transaction_type_key", dim, "transaction_type_key")


def parity_rowcount(spark: SparkSession, sf: str) -> DataFrame:
    curated = _stored(spark, sf)
    return comparable(quality.parity_rowcount(_fct_of(curated), _fct_of(fx.with_duplicates(curated))))


def parity_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """Against a build that counted some messages twice and has no debits."""
    curated = _stored(spark, sf)
    monitoring = _monitoring_of(curated)
    other = _fct_of(fx.with_duplicates(curated).where(F.col("type") != "DEBIT"))
    return comparable(quality.parity_kpi(
        warehouse.mart_kpis(_fct_of(curated), monitoring), warehouse.mart_kpis(other, monitoring)))


def schema_contract(spark: SparkSession, sf: str) -> DataFrame:
    """A fact that lacks one column and has another of the wrong type."""
    drifted = _fct_of(_stored(spark, sf)).drop("label_delay_hours").withColumn("step", F.col("step").cast("int"))
    return comparable(quality.check_schema(drifted, FCT_SCORED))


# --- reports ---------------------------------------------------------------------------

def kpi_tiles(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(reports.kpi_tiles(_fct(spark, sf)))


def kpi_filtered(spark: SparkSession, sf: str) -> DataFrame:
    chosen = reports.filter_period(_fct(spark, sf), *MONTH, types=["TRANSFER", "CASH_OUT"])
    return comparable(reports.kpi_tiles(chosen))


def alert_trend(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(reports.alert_trend(_mart(spark, sf)))


def volume_vs_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(reports.volume_vs_alerts(_mart(spark, sf)))


def alerts_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(reports.alerts_by_type(warehouse.fct_alerts(_fct(spark, sf))))


def top_risky_accounts(spark: SparkSession, sf: str) -> DataFrame:
    alerts = warehouse.fct_alerts(_fct(spark, sf))
    return comparable(_tagged(
        {side: reports.top_risky_accounts(alerts, side) for side in ["origin", "destination"]}, "side"))


def alert_drill(spark: SparkSession, sf: str) -> DataFrame:
    fct = _fct_of(_stored(spark, sf))
    return comparable(_label_as_double(reports.alert_drill(fct, warehouse.fct_alerts(fct))))


def source_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return reports.source_offsets(fx.with_duplicates(fx.transactions(spark, sf)))


def lake_preview(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(reports.lake_preview(
        fx.silver(spark, sf), 20, only_alerts=True, tie_break=["source_offset"]).select(*_SHOWN))


# --- training --------------------------------------------------------------------------

def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return training.labelled(fx.curated(spark, sf))


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(training.class_weights(_labelled(spark, sf)))


def training_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(training.training_dataset(fx.curated(spark, sf)).select(
        *_SHOWN, "isFraud", "label_delay_hours", "class_weight"))


def training_join(spark: SparkSession, sf: str) -> DataFrame:
    delivered = fx.with_duplicates(fx.silver(spark, sf))
    return comparable(training.training_join(
        reconcile.dedup_scored(delivered), reconcile.dedup_labels(fx.labels(spark, sf))))


def dataset_split(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(training.split(_labelled(spark, sf)).select("source_offset", "dataset_split"))


def dataset_split_md5(spark: SparkSession, sf: str) -> DataFrame:
    return training.split_by_digest(_labelled(spark, sf)).select("source_offset", "dataset_split")


def train_cap(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(training.cap_rows(fx.transactions(spark, sf).select(*JOIN_KEYS, "isFraud"), 500))


def refresh_gate(spark: SparkSession, sf: str) -> DataFrame:
    """All labels, one class only, and none."""
    rows = _stored(spark, sf)
    return comparable(_tagged({
        "both": training.refresh_gate(rows),
        "one": training.refresh_gate(rows.where(F.col("isFraud") == 0)),
        "none": training.refresh_gate(rows.where(F.col("isFraud").isNull())),
    }, "labels"))


def retraining_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "retraining")
    fx.curated(spark, sf).write.parquet(path)
    return comparable(lake.read_retraining(spark, path))


def _baseline(spark: SparkSession, sf: str):
    return train_baseline(fx.transactions(spark, sf))


def model_train(spark: SparkSession, sf: str) -> DataFrame:
    """The baseline model's scores of all transactions, with its validation AUC."""
    trained = _baseline(spark, sf)
    rows = scoring.add_balance_features(fx.transactions(spark, sf).drop("fraud_score"))
    return comparable(score(rows, trained.model).select(
        "source_offset", "fraud_score", "predicted_is_fraud", F.lit(trained.auc).alias("auc")))


def model_score(spark: SparkSession, sf: str) -> DataFrame:
    """Rules over the scores of a model that was saved and loaded again."""
    from pyspark.ml import PipelineModel

    path = scratch(spark, "model")
    _baseline(spark, sf).model.write().overwrite().save(path)
    rows = scoring.engineer(fx.transactions(spark, sf).drop("fraud_score"))
    return comparable(scoring.apply_rules(score(rows, PipelineModel.load(path))).select(
        "source_offset", "fraud_score", "predicted_is_fraud", *RULE_FLAGS, "is_alert"))


def model_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the refreshed model, trained on the stored split of the retraining table."""
    data = durable(training.training_dataset(fx.curated(spark, sf)), "retraining")
    refreshed, _, trained = refresh(data, scratch(spark, "model"))
    assert refreshed and trained is not None
    rows = scoring.model_features(data).drop("fraud_score", "predicted_is_fraud")
    return comparable(score(rows, trained.model).select(
        "source_offset", "dataset_split", "fraud_score", "predicted_is_fraud", F.lit(trained.auc).alias("auc")))


def auc_exact(spark: SparkSession, sf: str) -> DataFrame:
    """How well the score tells fraud apart, over all labelled rows and with coarse scores that tie."""
    rows = _labelled(spark, sf).select("fraud_score", "isFraud")
    return comparable(_tagged({
        "as_scored": exact_auc(rows), "coarse": exact_auc(rows.withColumn("fraud_score", F.floor(F.col("fraud_score") * 4)))}, "scores"))


def refresh_job(spark: SparkSession, sf: str) -> DataFrame:
    """Four refreshes of one model: a good one, one without fraud labels, another good one, and one that would have to be
    better by far. Which of them moved the pointer, and how many versions there are then."""
    root = scratch(spark, "models")
    data = durable(training.training_dataset(fx.curated(spark, sf)), "retraining")
    attempts = {"first": (data, -1.0), "no_fraud": (data.where("isFraud = 0"), -1.0), "again": (data, -1.0), "too_little_better": (data, 1.0)}
    rows = []
    for attempt, (labels, least_gain) in attempts.items():
        before = models.serving_version(spark, root)
        refreshed, _, trained = refresh(labels, root, trees=4, depth=3, least_gain=least_gain)
        now = models.serving_version(spark, root)
        assert refreshed == (now != before)
        useful = trained is not None and trained.auc > 0.6
        rows.append((attempt, str(now != before).lower(), str(useful).lower(), len(models.versions(spark, root))))
    moved = spark.createDataFrame(rows, "attempt string, moved string, useful string, versions long")
    gates = _tagged({name: training.refresh_gate(labels) for name, (labels, _) in attempts.items()}, "attempt")
    return comparable(moved.join(gates, "attempt"))


# --- envelopes -------------------------------------------------------------------------

def envelope_decode(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = envelope.decode_envelopes(durable(fx.messages(spark, sf), "messages"))
    return comparable(valid.withColumn("amount", F.col("amount").try_cast("double")).select(
        *SOURCE_ID, "kafka_ingest_ts", "step", "type", "amount", "nameOrig", "nameDest", "event_emitted_at_utc"))


def envelope_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = envelope.decode_envelopes(durable(fx.messages(spark, sf), "messages"))
    return bad.select(*SOURCE_ID, F.length("value").alias("message_length"))


def alert_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Published alerts, read back from their JSON."""
    alerts = fx.silver(spark, sf).where("is_alert")
    published = envelope.encode_envelopes(alerts, emitted_at=fx.AS_OF)
    return comparable(envelope.decode_alerts(published).withColumnRenamed("type", "transaction_type"))


def alert_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Scores are moved off the grid of the test data, where four places would often fall
    on a half-way case that the engines print differently."""
    alerts = fx.silver(spark, sf).where("is_alert").withColumn("fraud_score", F.col("fraud_score") / 1.0007)
    received = envelope.decode_alerts(envelope.encode_envelopes(alerts, emitted_at=fx.AS_OF))
    return envelope.alert_messages(received.select(*SILVER.fieldNames())).select(
        "source_offset", "subject", "body",
        F.get_json_object("payload", "$.subject").alias("payload_subject"),
        F.get_json_object("payload", "$.alert.nameDest").alias("payload_destination"))


# --- reading and writing ---------------------------------------------------------------

_LAKE = ["source_offset", "event_ts", "type", "amount", "is_alert"]


def lake_read_formats(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.silver(spark, sf).select(*_LAKE)
    parts = {}
    options = {"timestampFormat": TIMESTAMP_TEXT}
    for fmt in lake.FORMATS:
        path = scratch(spark, fmt)
        rows.write.format(fmt).options(**options).save(path)
        parts[fmt] = lake.read_lake(spark, path, fmt, rows.schema, **options)
    return comparable(_tagged(parts, "format"))


def load_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """One table by hour partition, one in nested folders, one flat."""
    base = scratch(spark, "layouts")
    rows = fx.curated(spark, sf).select("source_offset", "type", "amount", HOUR)
    sinks.write_hourly(rows, f"{base}/by_hour")
    rows.where("amount >= 100000").write.parquet(f"{base}/nested/large")
    rows.where("amount < 100000").write.parquet(f"{base}/nested/small")
    rows.write.parquet(f"{base}/flat")
    return comparable(_tagged(
        {name: lake.read_table_layout(spark, base, name) for name in ["by_hour", "nested", "flat"]}, "layout"))


def load_dispositions(spark: SparkSession, sf: str) -> DataFrame:
    """Truncate twice, append once, and an empty-only load that must be refused."""
    location = scratch(spark, "warehouse")
    database = "loaded_" + location[-8:]
    sinks.ensure_database(spark, database, location=location)
    rows = fx.transactions(spark, sf).select("source_offset", "type", "amount")
    parts = {}
    for disposition in ["WRITE_TRUNCATE", "WRITE_TRUNCATE", "WRITE_APPEND", "WRITE_EMPTY"]:
        name = f"{database}.{disposition.lower()}"
        sinks.load_table(rows, name, disposition)
        parts[disposition] = name
    sinks.load_table(rows, parts["WRITE_APPEND"], "WRITE_APPEND")
    try:
        sinks.load_table(rows, parts["WRITE_EMPTY"], "WRITE_EMPTY")
    except AnalysisException:
        pass
    return comparable(_tagged({d: spark.table(name) for d, name in parts.items()}, "disposition"))


def compaction(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "compacted")
    rows = fx.silver(spark, sf).select(*_LAKE)
    sinks.compact(rows.repartition(32)).write.parquet(path)
    return comparable(spark.read.schema(rows.schema).parquet(path))


# --- streams ---------------------------------------------------------------------------

def _stream_paths(spark: SparkSession) -> tuple[str, Sinks]:
    base = scratch(spark, "stream")
    names = ["bronze", "silver", "gold", "quarantine", "checkpoint", "events", "late"]
    return f"{base}/in", Sinks(*[f"{base}/{name}" for name in names], events_format="event_log")


def _score_messages(spark: SparkSession, sf: str) -> Sinks:
    source, paths = _stream_paths(spark)
    fx.messages(spark, sf).write.json(source)
    stream = events.read_events(spark, "json", path=source, schema=MESSAGE)
    query = score_stream(stream, fx.surrogate_score, paths, Settings(available_now=True, as_of=fx.AS_OF))
    query.awaitTermination()
    return paths


def _score_in_turns(spark: SparkSession, deliveries: list[DataFrame], late_seconds: int | None = None) -> Sinks:
    """Each delivery as one micro-batch."""
    source, paths = _stream_paths(spark)
    for rows in deliveries:
        rows.repartition(FILES).write.mode("append").json(source)
    stream = events.read_events(spark, "json", events.pacing_options("json", FILES), source)
    settings = Settings(available_now=True, as_of=fx.AS_OF, late_seconds=late_seconds)
    with recorded_progress(spark, f"{source}-progress"):
        query = score_stream(stream, fx.surrogate_score, paths, settings)
        query.awaitTermination()
    assert len(query.recentProgress) == len(deliveries)
    return paths


@cache
def _score_scattered(spark: SparkSession, sf: str) -> Sinks:
    """One run of the stream in a session, whose tables several queries look at."""
    return _score_in_turns(spark, _scattered(spark, sf))


def _scattered(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Messages dealt over eight deliveries by their offset, which cuts every bucket; every twentieth comes again with the next."""
    messages = durable(fx.messages(spark, sf), "messages")
    n = F.col("offset").cast("bigint")
    again = messages.where(n % 20 == 0).withColumn("timestamp", F.concat("timestamp", F.lit("+1")))
    return [messages.where(n % TURNS == i).unionByName(again.where(n % TURNS == (i - 1) % TURNS) if i else messages.limit(0))
            for i in range(TURNS)]


def stream_bronze(spark: SparkSession, sf: str) -> DataFrame:
    written = spark.read.parquet(_score_messages(spark, sf).bronze)
    return comparable(written.select(*BRONZE.fieldNames()))


def stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(lake.read_silver(spark, _score_messages(spark, sf).silver).select(*SILVER.fieldNames()))


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(lake.read_alerts(spark, _score_messages(spark, sf).gold))


def stream_silver_many_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Silver is the same however messages are cut into micro-batches, and whichever come twice."""
    paths = _score_scattered(spark, sf)
    return comparable(lake.read_silver(spark, paths.silver).select(*SILVER.fieldNames()))


def stream_alerts_many_batches(spark: SparkSession, sf: str) -> DataFrame:
    """So are the alerts, as they were written, and their flags; their velocity is that of the moment."""
    paths = _score_scattered(spark, sf)
    return comparable(lake.read_alerts(spark, paths.gold).drop("velocity_5min"))


def stream_events_many_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Every alert is published once."""
    paths = _score_scattered(spark, sf)
    published = envelope.decode_alerts(read_event_log(spark, paths.events))
    return published.select("source_offset", "event_id", F.col("is_alert").cast("string").alias("is_alert"))


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Messages by the quarter of their time; some of the first quarters come with the last. What went to silver and what to the late table."""
    messages = durable(fx.messages(spark, sf), "messages")
    held_back = F.col("offset").cast("bigint") % 50 == 7
    quarter = F.when(held_back, F.lit(3)).otherwise(F.floor(F.substring("timestamp", 12, 2).cast("int") / 3))
    paths = _score_in_turns(spark, [messages.where(quarter == i) for i in range(4)], late_seconds=600)
    return _tagged({
        "silver": lake.read_silver(spark, paths.silver).select("source_offset"),
        "late": spark.read.parquet(paths.late).select("source_offset"),
    }, "written_to")


def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """What became of the input of each micro-batch, as recorded by the listener and found in the tables."""
    paths = _score_scattered(spark, sf)
    progress = read_progress(spark, paths.bronze.removesuffix("bronze") + "in-progress")
    return accounted(progress, paths).select(
        "ingest_batch_id", "input_rows", "bronze_rows", "silver_rows", "undecodable_rows", "late_rows", "repeated_rows", "missing_rows", "dropped_rows")


def stream_pull_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """A message log pulled a few messages at a time, with a restart: how often each message arrived."""
    base = scratch(spark, "pull")
    messages = durable(fx.messages(spark, sf), "messages")
    n = F.col("offset").cast("bigint")
    for i in range(3):
        append_segment(messages.where(n % 3 == i).repartition(2), f"{base}/log", i)
    limit = messages.count() // 7 + 1
    sizes: list[int] = []

    def pull() -> StreamingQuery:
        stream = read_message_log(spark, f"{base}/log", f"{base}/progress.json", limit)
        return (stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
                .trigger(processingTime="0 seconds").start(f"{base}/pulled"))

    query = pull()
    while not query.recentProgress and query.isActive:
        query.awaitTermination(1)
    query.stop()
    sizes += [p["numInputRows"] for p in query.recentProgress]
    query = pull()
    query.processAllAvailable()
    query.stop()
    sizes += [p["numInputRows"] for p in query.recentProgress]
    pulled = spark.read.schema(MESSAGE).parquet(f"{base}/pulled")
    return pulled.groupBy("topic", "partition", "offset").agg(F.count(F.lit(1)).alias("times")).withColumn(
        "within_limit", F.lit(str(max(sizes) <= limit).lower()))


def _stream_of(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows as a file stream, with one far-future row that pushes the watermark past them."""
    path = scratch(spark, "in")
    last = rows.limit(1).withColumns({
        "source_offset": F.lit("-1"), "event_ts": F.lit(datetime(2100, 1, 1, tzinfo=timezone.utc))})
    rows.unionByName(last).write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def _drain(stream: DataFrame, spark: SparkSession) -> DataFrame:
    out = scratch(spark, "out")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", out + "-checkpoint")
    with state_partitions(spark):
        query = writer.trigger(availableNow=True).start(out)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out).where(F.col("source_offset") != "-1")


def stream_velocity_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.transactions(spark, sf).select(*SOURCE_ID, "event_ts", "nameOrig", "amount")
    return comparable(_drain(stream_velocity(_stream_of(spark, rows)), spark).select(
        "source_offset", "nameOrig", "event_ts", "velocity_5min"))


def stream_dedup_query(spark: SparkSession, sf: str) -> DataFrame:
    delivered = fx.with_duplicates(fx.transactions(spark, sf)).select(*SOURCE_ID, "event_ts", "nameOrig", "amount")
    return comparable(_drain(stream_dedup(_stream_of(spark, delivered)), spark).select(
        *SOURCE_ID, "event_ts", "amount"))


QUERIES: dict[str, Query] = {
    "coerce_defaults": coerce_defaults,
    "event_time": event_time,
    "velocity_5min": velocity_5min,
    "features": features,
    "alert_rules": alert_rules,
    "to_bool": to_bool_query,
    "model_features": model_features,
    "dedup_scored": dedup_scored,
    "dedup_scored_fallback": dedup_scored_fallback,
    "labels_unique": labels_unique,
    "labels_scan": labels_scan,
    "reconcile_labels": reconcile_labels,
    "reconcile_labels_bucketed": reconcile_labels_bucketed,
    "hour_filter": hour_filter,
    "hourly_monitoring": hourly_monitoring,
    "hourly_overwrite": hourly_overwrite,
    "hourly_retraining_rerun": hourly_retraining_rerun,
    "batch_metrics": batch_metrics,
    "stg_curated_scored": stg_curated_scored,
    "stg_monitoring_hourly": stg_monitoring_hourly,
    "dim_account": dim_account,
    "dim_transaction_type": dim_transaction_type,
    "dim_time_hour": dim_time_hour,
    "fct_scored_transactions": fct_scored_transactions,
    "fct_fraud_alerts": fct_fraud_alerts,
    "mart_fraud_hourly_kpis": mart_fraud_hourly_kpis,
    "warehouse_incremental": warehouse_incremental,
    "warehouse_incremental_accounts": warehouse_incremental_accounts,
    "warehouse_job": warehouse_job,
    "load_job": load_job,
    "percentiles_merged": percentiles_merged,
    "dq_unique": dq_unique,
    "dq_nonnull": dq_nonnull,
    "dq_fk_origin": dq_fk_origin,
    "dq_fk_destination": dq_fk_destination,
    "dq_fk_type": dq_fk_type,
    "parity_rowcount": parity_rowcount,
    "parity_kpi": parity_kpi,
    "schema_contract": schema_contract,
    "kpi_tiles": kpi_tiles,
    "kpi_filtered": kpi_filtered,
    "alert_trend": alert_trend,
    "volume_vs_alerts": volume_vs_alerts,
    "alerts_by_type": alerts_by_type,
    "top_risky_accounts": top_risky_accounts,
    "alert_drill": alert_drill,
    "source_offsets": source_offsets,
    "lake_preview": lake_preview,
    "class_weights": class_weights,
    "training_dataset": training_dataset,
    "training_join": training_join,
    "dataset_split": dataset_split,
    "dataset_split_md5": dataset_split_md5,
    "train_cap": train_cap,
    "refresh_gate": refresh_gate,
    "retraining_scan": retraining_scan,
    "model_train": model_train,
    "model_score": model_score,
    "model_refresh": model_refresh,
    "auc_exact": auc_exact,
    "refresh_job": refresh_job,
    "envelope_decode": envelope_decode,
    "envelope_quarantine": envelope_quarantine,
    "alert_envelopes": alert_envelopes,
    "alert_messages": alert_messages,
    "lake_read_formats": lake_read_formats,
    "load_layouts": load_layouts,
    "load_dispositions": load_dispositions,
    "compaction": compaction,
    "stream_bronze": stream_bronze,
    "stream_silver": stream_silver,
    "stream_alerts": stream_alerts,
    "stream_silver_many_batches": stream_silver_many_batches,
    "stream_alerts_many_batches": stream_alerts_many_batches,
    "stream_events_many_batches": stream_events_many_batches,
    "stream_late_rows": stream_late_rows,
    "stream_pull_offsets": stream_pull_offsets,
    "stream_metrics": stream_metrics,
    "stream_velocity": stream_velocity_query,
    "stream_dedup": stream_dedup_query,
}
