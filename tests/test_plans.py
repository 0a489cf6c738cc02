"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import ast
import glob
import os

import pytest
from frames import scored

from tallyward.operators import quality, reconcile, reports, scoring, training, warehouse
from tallyward.schemas import CURATED, SILVER
from tallyward.streaming.velocity import stream_velocity

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    scored(spark, {}, {"amount": 3.0}).write.parquet(path)
    return spark.read.schema(SILVER).parquet(path)


def test_hour_filter_reaches_the_scan(silver):
    text = plan(reconcile.filter_hour(silver, "2024-01-01-05"))
    assert "GreaterThanOrEqual(event_ts" in text and "LessThan(event_ts" in text


def test_partitioned_hours_are_pruned(spark, tmp_path):
    from pyspark.sql import functions as F

    from tallyward.schemas import HOUR
    from tallyward.sources.sinks import write_hourly

    write_hourly(reconcile.with_hour(scored(spark, {})), str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).where(F.col(HOUR) >= F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert "PartitionFilters: [isnotnull(batch_hour_utc" in plan(df)


def test_velocity_uses_no_window_and_counts_before_the_shuffle(silver):
    text = plan(scoring.add_velocity(silver.drop("velocity_5min")))
    assert "Window" not in text and "partial_count" in text and "CartesianProduct" not in text


def test_dedup_drops_copies_before_the_shuffle(silver):
    text = plan(reconcile.dedup_scored(silver))
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:shuffle] and "WindowGroupLimit" in text[shuffle:]


def test_stored_labels_are_not_shuffled(spark, silver, tmp_path):
    from pyspark.sql import functions as F

    from tallyward.operators.skew import hot_buckets
    from tallyward.schemas import JOIN_KEYS
    from tallyward.sources import sinks

    sinks.ensure_database(spark, "planned", location=str(tmp_path))
    # One value of zero, of whichever sign.
    known = silver.withColumn("oldbalanceDest", F.col("oldbalanceDest") * F.lit(-0.0)).select(*JOIN_KEYS, F.lit(1.0).alias("isFraud"))
    silver = silver.withColumn("oldbalanceDest", F.col("oldbalanceDest") * F.lit(0.0))
    sinks.store_labels(known, "planned.labels", buckets=4)
    sinks.store_labels(known, "planned.labels", buckets=4)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        load = reconcile.business_key_load(silver, stored=True)
        due = spark.table("planned.labels").where(F.col("step").between(1, 1))
        df = reconcile.reconcile(silver, reconcile.dedup_labels(due), load=load)
        rows = df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert [r["isFraud"] for r in rows] == [1.0, 1.0] and hot_buckets(load).isEmpty()
    # With nothing hot the final plan has the join with the buckets alone: labels are read once, and no exchange is above them.
    final = text.split("== Initial Plan ==")[0]
    assert final.count("planned.labels") == 1 and "SelectedBucketsCount: 4 out of 4" in final
    lines = final.splitlines()
    scan = next(i for i, line in enumerate(lines) if "planned.labels" in line)
    deep = len(lines[scan])
    above = []
    for line in reversed(lines[:scan]):
        depth = len(line) - len(line.lstrip(" :|+-"))
        if depth < deep:
            deep = depth
            above.append(line)
            if "Join" in line:
                break
    assert "Join" in above[-1] and not any("Exchange" in line or "ShuffleQueryStage" in line for line in above), final
    assert "GreaterThanOrEqual(step,1)" in final


def test_reads_only_the_columns_it_needs(silver):
    text = plan(reconcile.business_key_load(silver))
    assert "fraud_score" not in text.split("ReadSchema")[1]


def test_aggregates_combine_before_the_shuffle(silver):
    curated = silver.selectExpr("*", "0D as isFraud", "true as is_label_available", "1D as label_delay_hours",
                                "date_trunc('hour', event_ts) as batch_hour_utc").select(*CURATED.fieldNames())
    stg = warehouse.stg_curated(curated)
    fct = warehouse.fct_scored(stg)
    assert "Exchange" not in plan(fct)
    assert plan(warehouse.dim_account(stg)).count("FileScan") == 1
    for df in [warehouse.dim_account(stg), reconcile.hourly_monitoring(curated), reports.kpi_tiles(fct),
               quality.check_unique(fct, ["transaction_key"]), reports.top_risky_accounts(warehouse.fct_alerts(fct))]:
        text = plan(df)
        assert "partial_" in text and "SortAggregate" not in text


def test_foreign_keys_are_compared_distinct(silver):
    fact = silver.selectExpr("source_offset as transaction_key", "nameOrig as fk")
    text = plan(quality.check_fk(fact, "fk", silver.selectExpr("nameDest as pk"), "pk"))
    assert "LeftAnti" in text and "LeftSemi" in text and "Cartesian" not in text


def test_weights_need_no_join(silver):
    text = plan(training.with_class_weight(silver.selectExpr("*", "1D as isFraud")))
    assert "Subquery" in text and "Join" not in text


def test_no_python_workers_and_no_cross_joins(spark, sf):
    from tallyward.plans.queries import QUERIES

    for name in ["alert_rules", "reconcile_labels", "mart_fraud_hourly_kpis", "envelope_decode", "alert_envelopes", "parity_kpi"]:
        text = plan(QUERIES[name](spark, sf))
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_skewed_left_join_partition_is_split_at_run_time(spark):
    """The fixture's own join is left to Spark's skew handling; it must take effect."""
    from pyspark.sql import functions as F

    keep = {k: spark.conf.get(k, None) for k in [
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.autoBroadcastJoinThreshold"]}
    for k, v in zip(keep, ["10KB", "10KB", "2", "-1"]):
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 40000, 1, 8).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
        df = left.join(spark.range(40000).select(F.col("id").alias("k"), F.col("id").alias("v")), "k", "left")
        assert df.count() == 40000
        df.collect()
        assert "skew=true" in plan(df) or "isSkewJoin=true" in plan(df) or "skewed" in plan(df)
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stream_join_is_keyed_by_bucket_and_salt(spark, tmp_path):
    rows = scored(spark, {}).select("source_topic", "source_partition", "source_offset", "event_ts", "nameOrig")
    rows.write.parquet(str(tmp_path / "in"))
    stream = stream_velocity(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    assert stream.isStreaming and stream.columns == rows.columns + ["velocity_5min"]
    text = stream._jdf.queryExecution().analyzed().toString()
    assert "_slot" in text and "_salt" in text


def test_library_code_keeps_to_the_ground_rules():
    banned = {"localCheckpoint", "toPandas", "toLocalIterator", "crossJoin", "rdd", "udf", "pandas_udf"}
    for file in glob.glob(f"{ROOT}/tallyward/**/*.py", recursive=True):
        names = {n.attr for n in ast.walk(ast.parse(open(file).read())) if isinstance(n, ast.Attribute)}
        assert not names & banned, (file, names & banned)
