from __future__ import annotations

import glob
import math
import os

import pytest
from frames import START, at, scored
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyward.__main__ import main, parser
from tallyward.operators import reconcile
from tallyward.plans import fixture, jobs
from tallyward.plans.durable import scratch
from tallyward.schemas import CURATED, HOUR, JOIN_KEYS, MODEL_INPUT
from tallyward.sources import events, lake, sinks

HEADER = "step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud\n"


def csv(path, *lines):
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write(HEADER + "\n".join(lines))
    return path


def test_labels_are_coerced_like_the_scored_side(spark, path):
    p = csv(f"{path}/l", "1,CASH-OUT,1060.31,C1,1089.0,28.69,M1,0.0,0.0,0,0", "2,,5,C2,,1,M2,,,1,0", "3,DEBIT,5,C3,1,1,M2,,,,0")
    rows = {r["step"]: r for r in lake.read_labels(spark, p).collect()}
    assert rows[1]["type"] == "CASH_OUT" and rows[1]["amount"] == 1060.31 and rows[1]["isFraud"] == 0.0
    assert rows[2]["type"] == "UNKNOWN" and rows[2]["oldbalanceOrg"] == 0.0 and rows[2]["isFraud"] == 1.0
    assert rows[3]["isFraud"] is None
    bare = {r["step"]: r for r in lake.read_labels(spark, p, coerce_labels=False).collect()}
    assert bare[2]["oldbalanceOrg"] is None and bare[1]["type"] == "CASH-OUT"


def test_unknown_format(spark, path):
    with pytest.raises(ValueError):
        lake.read_lake(spark, path, "avro")


def test_alerts_path_without_any_alert(spark, path):
    os.makedirs(f"{path}/gold")
    assert lake.read_alerts(spark, f"{path}/gold").count() == 0


def test_retraining_scan_of_an_unlabelled_table(spark, path):
    df = scored(spark, {}).withColumn("isFraud", F.lit(None).cast("double"))
    df.write.parquet(f"{path}/r")
    out = lake.read_retraining(spark, f"{path}/r")
    assert out.count() == 0 and out.columns == MODEL_INPUT.fieldNames()


def test_missing_table_is_named(spark, path):
    with pytest.raises(ValueError, match="nowhere"):
        lake.read_table_layout(spark, path, "nowhere")


def test_hourly_write_replaces_only_its_hours(spark, path):
    def rows(hour, amount):
        return reconcile.with_hour(scored(spark, {"event_ts": at(3600 * hour), "amount": amount}))

    sinks.write_hourly(rows(0, 1.0).unionByName(rows(1, 1.0)), f"{path}/t")
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/t/*00%3A00%3A00/*.parquet")}
    sinks.write_hourly(rows(1, 2.0), f"{path}/t")
    out = {r[HOUR].hour: r["amount"] for r in spark.read.parquet(f"{path}/t").collect()}
    assert out == {0: 1.0, 1: 2.0}
    assert before and all(os.path.exists(f) for f in before if "2024-01-01 00" in f)


def test_compaction_bounds_the_files(spark, path):
    df = spark.range(1000).repartition(16)
    sinks.compact(df, 3).write.parquet(f"{path}/few")
    sinks.compact(df).write.parquet(f"{path}/auto")
    assert len(glob.glob(f"{path}/few/*.parquet")) == 3 and len(glob.glob(f"{path}/auto/*.parquet")) < 16
    assert spark.read.parquet(f"{path}/few").count() == spark.read.parquet(f"{path}/auto").count() == 1000
    with pytest.raises(ValueError):
        sinks.compact(df, 0)


def test_table_names():
    assert sinks.clean_table_names([" a ", "b", "", "a"]) == ["a", "b"]
    with pytest.raises(ValueError):
        sinks.clean_table_names(["", " "])


def test_database_and_dispositions(spark, path):
    db = "db_" + os.path.basename(path).replace("-", "_")
    with pytest.raises(ValueError):
        sinks.ensure_database(spark, db, create=False)
    sinks.ensure_database(spark, db, location=f"{path}/db")
    sinks.ensure_database(spark, db, create=False)
    sinks.load_table(spark.range(3), f"{db}.t", "WRITE_EMPTY")
    sinks.load_table(spark.range(3), f"{db}.t", "WRITE_APPEND")
    assert spark.table(f"{db}.t").count() == 6
    with pytest.raises(AnalysisException):
        sinks.load_table(spark.range(3), f"{db}.t", "WRITE_EMPTY")
    sinks.load_table(spark.range(2), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 2
    with pytest.raises(ValueError):
        sinks.load_table(spark.range(2), f"{db}.t", "MERGE")


def test_failed_load_leaves_the_old_rows(spark, path):
    db = "atomic_" + os.path.basename(path).replace("-", "_")
    sinks.ensure_database(spark, db, location=f"{path}/db")
    rows = spark.range(100).selectExpr("id", "id % 5 as part")
    sinks.load_table(rows, f"{db}.t", partition_by="part")
    before = spark.table(f"{db}.t")
    held = before.inputFiles()
    with pytest.raises(Exception, match="refused"):
        sinks.load_table(rows.withColumn("id", F.expr("if(id = 77, raise_error('refused'), id + 1000)").cast("bigint")), f"{db}.t", partition_by="part")
    assert sorted(r["id"] for r in spark.table(f"{db}.t").collect()) == list(range(100))
    # The new rows lack a partition and add one; whoever planned a read before still finds the old files.
    sinks.load_table(spark.range(10).selectExpr("id", "id % 5 + 1 as part"), f"{db}.t", partition_by="part")
    assert {r["part"] for r in spark.table(f"{db}.t").collect()} == {1, 2, 3, 4, 5}
    assert spark.table(f"{db}.t").count() == 10 and spark.read.parquet(*held).count() == 100
    sinks.load_table(rows, f"{db}.t", "WRITE_APPEND", partition_by="part")
    assert spark.table(f"{db}.t").count() == 110
    sinks.load_table(spark.range(3).selectExpr("id", "'x' as other"), f"{db}.t")
    assert spark.table(f"{db}.t").columns == ["id", "other"] and spark.table(f"{db}.t").count() == 3


def test_load_job_reads_hourly_output(spark, path):
    db = "loaded_" + os.path.basename(path).replace("-", "_")
    for name in jobs.HOURLY_TABLES:
        sinks.write_hourly(reconcile.with_hour(scored(spark, {}, {"event_ts": at(4000)})), f"{path}/out/{name}")
    loaded = jobs.load(spark, f"{path}/out", db, location=f"{path}/db")
    assert loaded == [f"{db}.{n}" for n in jobs.HOURLY_TABLES]
    assert spark.table(loaded[0]).where(F.col(HOUR) == F.lit(at(3600))).count() == 1


def test_hourly_job_then_warehouse_then_refresh(spark, sf, path):
    delivered = fixture.with_duplicates(fixture.silver(spark, sf))
    delivered.write.parquet(f"{path}/silver")
    fixture.labels(spark, sf).write.parquet(f"{path}/labels")
    silver, labels = lake.read_silver(spark, f"{path}/silver"), spark.read.parquet(f"{path}/labels")
    counts = jobs.hourly(spark, silver, labels, f"{path}/out", as_of=fixture.AS_OF)
    assert counts == {"silver_rows": 1050, "curated_rows": 1000, "labelled_rows": 900, "retraining_rows": 900,
                      "monitoring_rows": 60}
    again = jobs.hourly(spark, silver, labels, f"{path}/out", "2024-01-01-03", fixture.AS_OF)
    assert spark.read.parquet(f"{path}/out/curated_scored").count() == 1000
    assert again["curated_rows"] < 1000
    with pytest.raises(ValueError):
        jobs.hourly(spark, silver, labels, f"{path}/out", "2030-01-01-00")
    built = jobs.build_warehouse(
        spark, spark.read.schema(CURATED).parquet(f"{path}/out/curated_scored"),
        spark.read.parquet(f"{path}/out/monitoring_hourly"), f"{path}/wh")
    assert built.failed() == {}
    assert built.tables["mart_fraud_hourly_kpis"].count() == 60
    ok, message, trained = jobs.refresh_model(
        spark, f"{path}/out/retraining_dataset", f"{path}/model", trees=5, depth=4)
    assert ok and "AUC" in message and trained.auc > 0.6
    ok, _, _ = jobs.refresh_from_lake(spark, silver, labels, f"{path}/model2", trees=3, depth=3)
    assert ok and os.path.exists(f"{path}/model2")


def test_command_line_runs_hourly_and_warehouse(spark, sf, path, monkeypatch, capsys):
    import tallyward.__main__ as cli

    monkeypatch.setattr(cli, "get_spark", lambda *a: spark)
    fixture.silver(spark, sf).write.parquet(f"{path}/silver")
    fixture.transactions(spark, sf).withColumn("isFlaggedFraud", F.lit(0)).select(
        *lake.LABELLED_CSV.fieldNames()).write.option("header", True).csv(f"{path}/labels")
    assert main(["hourly", "--silver-path", f"{path}/silver", "--labels-csv", f"{path}/labels",
                 "--output-base", f"{path}/out"]) == 0
    assert main(["warehouse", "--base", f"{path}/out", "--output", f"{path}/wh"]) == 0
    assert main(["warehouse", "--base", f"{path}/out", "--output", f"{path}/wh", "--hour-utc", "2024-01-01-03"]) == 0
    assert main(["preview", "--path", f"{path}/wh/fct_fraud_alerts", "--only-alerts"] [:3]) == 0
    assert main(["train-baseline", "--input", f"{path}/labels", "--model-output", f"{path}/model"]) == 0
    out = capsys.readouterr().out
    assert "'curated_rows': 1000" in out and "all assertions hold" in out and "AUC" in out


def test_defaults_of_the_command_line():
    args = parser().parse_args(["refresh-model", "--retraining", "x", "--model-output", "y"])
    assert (args.model_num_trees, args.model_max_depth, args.model_seed) == (120, 8, 42)
    args = parser().parse_args(["train-baseline", "--input", "x", "--model-output", "y"])
    assert (args.num_trees, args.max_depth, args.max_rows, args.train_ratio) == (8, 4, 75000, 0.8)


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch(spark, "x"), scratch(spark, "x")
    assert one != two and (root is None or one.startswith(root.rstrip("/")))


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077", "spark.app.id": "a"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(Session(), "x")


def test_pacing():
    assert events.pacing_options("kafka") == {}
    assert events.pacing_options("kafka", 7, "earliest") == {"maxOffsetsPerTrigger": "7", "startingOffsets": "earliest"}
    assert events.pacing_options("json", 3) == {"maxFilesPerTrigger": "3"} and events.pacing_options("json") == {}
    assert events.trigger() == {"processingTime": "10 seconds"} and events.trigger(available_now=True) == {"availableNow": True}
