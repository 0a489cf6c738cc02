from __future__ import annotations

import hashlib
import re
from datetime import datetime

import pytest
from frames import at, scored
from pyspark.sql import functions as F

from tallyward.operators import quality, quantiles, reconcile, reports, warehouse
from tallyward.plans.jobs import assertions, build_warehouse
from tallyward.schemas import CURATED, FCT_ALERTS, FCT_SCORED, MART


def curated(spark, *changes):
    labelled = scored(spark, *changes).withColumn("isFraud", F.lit(0.0))
    return reconcile.with_hour(labelled.withColumns(reconcile.label_columns(at(3600)))).select(*CURATED.fieldNames())


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def built(spark, *changes):
    stg = warehouse.stg_curated(curated(spark, *changes))
    mon = warehouse.stg_monitoring(reconcile.hourly_monitoring(curated(spark, *changes)))
    fct = warehouse.fct_scored(stg)
    return {
        "dim_account": warehouse.dim_account(stg),
        "dim_time_hour": warehouse.dim_time_hour(stg),
        "dim_transaction_type": warehouse.dim_transaction_type(stg),
        "fct_scored_transactions": fct,
        "fct_fraud_alerts": warehouse.fct_alerts(fct),
        "mart_fraud_hourly_kpis": warehouse.mart_kpis(fct, mon),
    }


def test_schemas(spark):
    tables = built(spark, {})
    types = lambda s: [(f.name, f.dataType) for f in s.fields]
    assert types(tables["fct_scored_transactions"].schema) == types(FCT_SCORED)
    assert types(tables["fct_fraud_alerts"].schema) == types(FCT_ALERTS)
    assert types(tables["mart_fraud_hourly_kpis"].schema) == types(MART)
    assert len(FCT_SCORED) == 30 and len(FCT_ALERTS) == 19 and len(MART) == 10


def test_keys(spark):
    row = built(spark, {"source_partition": "3", "source_offset": "17"})["fct_scored_transactions"].first()
    assert row["transaction_key"] == md5("1|TRANSFER|C1|C2|2024-01-01 00:00:00.000000|3|17")
    assert row["origin_account_key"] == md5("C1") and row["transaction_type_key"] == md5("TRANSFER")
    empty = built(spark, {"type": None})["fct_scored_transactions"].first()
    assert empty["transaction_key"] == md5("1||C1|C2|2024-01-01 00:00:00.000000|0|0")
    assert empty["transaction_type_key"] is None


def test_flags_from_mixed_encodings(spark):
    df = curated(spark, {"is_new_merchant": 1.0}).withColumn("is_alert", F.lit(" Yes "))
    row = warehouse.stg_curated(df).first()
    assert row["is_new_merchant"] is True and row["is_alert"] is True


def test_accounts_touch_both_sides(spark):
    rows = {r["account_id"]: r for r in built(
        spark, {"event_ts": at(0)}, {"event_ts": at(9), "nameOrig": "C2", "nameDest": "C2", "amount": 2.5},
        {"nameDest": None})["dim_account"].collect()}
    assert set(rows) == {"C1", "C2"}
    assert rows["C2"]["transaction_touch_count"] == 3 and float(rows["C2"]["total_amount_touched"]) == 15.0
    assert rows["C2"]["last_seen_ts"].second == 9 and rows["C1"]["transaction_touch_count"] == 2


def test_time_dimension(spark):
    row = built(spark, {"event_ts": at(3600 * 25 + 7)})["dim_time_hour"].first()
    assert (row["event_year"], row["event_month"], row["event_day"], row["event_hour"]) == (2024, 1, 2, 1)
    assert (row["day_name"], row["hour_label_utc"]) == ("Tuesday", "2024-01-02 01:00:00 UTC")


def test_mart_row_without_monitoring_is_kept(spark):
    stg = warehouse.stg_curated(curated(spark, {}, {"type": "DEBIT"}))
    mon = warehouse.stg_monitoring(reconcile.hourly_monitoring(curated(spark, {})))
    rows = {r["transaction_type"]: r for r in warehouse.mart_kpis(warehouse.fct_scored(stg), mon).collect()}
    assert rows["TRANSFER"]["alert_rate_batch"] == 0.0 and rows["DEBIT"]["alert_rate_batch"] is None
    assert rows["DEBIT"]["alert_rate_recomputed"] == 0.0


def test_clean_build_has_no_violations(spark):
    checks = assertions(built(spark, {}, {"event_ts": at(4000)}, {"type": "DEBIT", "is_alert": True}))
    assert len(checks) == 13
    assert {name: df.count() for name, df in checks.items() if df.count()} == {}


def test_violations_are_found(spark):
    tables = built(spark, {"source_offset": "5"}, {"source_offset": "5"}, {"type": None})
    tables["dim_account"] = tables["dim_account"].where("account_id <> 'C2'")
    found = {name: df.count() for name, df in assertions(tables).items() if df.count()}
    assert found == {
        "unique_fct_scored_transactions": 1, "not_null_mart_fraud_hourly_kpis": 1, "fk_destination_account_key": 3}


def test_orphans_of_a_hot_key_are_all_reported(spark):
    fact = spark.range(1000).select(F.col("id").cast("string").alias("transaction_key"), F.when(
        F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("fk"))
    dim = fact.where("fk <> 'hot'").select(F.col("fk").alias("pk")).distinct()
    assert quality.check_fk(fact, "fk", dim, "pk").count() == 334


def test_schema_contract(spark):
    tables = built(spark, {}, {"type": None})
    broken = tables["fct_scored_transactions"].drop("amount").withColumn("step", F.col("step").cast("string"))
    lines = {r["column_name"]: r for r in quality.check_schema(broken, FCT_SCORED).collect()}
    assert {n for n, r in lines.items() if not r["matches"]} == {"amount", "step"}
    assert lines["amount"]["actual_type"] == "missing" and lines["amount"]["null_rows"] == 2
    assert lines["transaction_type"]["null_rows"] == 1


@pytest.mark.parametrize("a, b, delta, ok", [(1000, 1005, 0.005, True), (1000, 1006, 0.006, False), (0, 0, None, True), (0, 3, None, False)])
def test_row_count_parity(spark, a, b, delta, ok):
    row = quality.parity_rowcount(spark.range(a), spark.range(b)).first()
    assert row["relative_delta"] == delta and row["within_limit"] is ok


def test_kpi_parity_keeps_hours_of_either_side(spark):
    schema = "event_hour_utc timestamp, transaction_type string, observed_fraud_rate double"
    a = spark.createDataFrame([(at(0), "A", 0.5), (at(3600), "A", 0.1)], schema)
    b = spark.createDataFrame([(at(0), "A", 0.504), (at(7200), "A", 0.2)], schema)
    rows = [(r["rate_a"], r["rate_b"], r["within_limit"]) for r in quality.parity_kpi(a, b).collect()]
    assert rows == [(None, 0.2, False), (0.1, None, False), (0.5, 0.504, True)]


def test_tiles_without_fraud(spark):
    row = reports.kpi_tiles(built(spark, {})["fct_scored_transactions"]).first()
    assert row["total_transactions"] == 1 and row["real_fraud_alerted_share"] == 0.0


def test_fraud_shares_add_up_to_one(spark, sf):
    from tallyward.plans import fixture

    row = reports.kpi_tiles(warehouse.fct_scored(warehouse.stg_curated(fixture.curated(spark, sf)))).first()
    assert row["real_fraud_alerted_share"] + row["real_fraud_not_alerted_share"] == pytest.approx(1.0)


def test_top_accounts_break_ties_by_name(spark):
    alerts = built(spark, *[{"nameOrig": f"C{i:02d}", "is_alert": True} for i in range(15)])["fct_fraud_alerts"]
    assert [r["account"] for r in reports.top_risky_accounts(alerts).collect()] == [f"C{i:02d}" for i in range(10)]


def test_preview_needs_alert_flags(spark):
    df = scored(spark, {"event_ts": at(5)}, {"event_ts": at(9)}, {"is_alert": True})
    assert reports.lake_preview(df, 1).first()["event_ts"] == datetime(2024, 1, 1, 0, 0, 9)
    assert reports.lake_preview(df, 9, only_alerts=True).count() == 1
    with pytest.raises(ValueError):
        reports.lake_preview(df.drop("is_alert"), 9, only_alerts=True)


def test_period_filter_includes_both_ends(spark):
    fct = built(spark, *[{"event_ts": at(3600 * h)} for h in range(4)])["fct_scored_transactions"]
    assert reports.filter_period(fct, at(3600), at(7200)).count() == 2
    assert reports.filter_period(fct, types=["DEBIT"]).count() == 0


def hours_of_accounts(n, **changes):
    return [{"event_ts": at(3600 * h), "nameOrig": f"C{h}", "source_offset": str(10 * n + h), **changes} for h in range(30)]


def content(built):
    return {name: sorted(map(str, df.select(*sorted(df.columns)).collect())) for name, df in built.tables.items()}


def test_update_equals_a_full_build_and_reads_no_other_hour(spark, path):
    old = curated(spark, *hours_of_accounts(1), *hours_of_accounts(2, type="DEBIT", is_alert=True))
    build_warehouse(spark, old, reconcile.hourly_monitoring(old), f"{path}/wh")
    # Hour 3 gets other rows and no alert, hour 5 loses all rows, hour 40 is new.
    right = old.where(~F.hour("event_ts").isin(3, 5) | (F.col("event_ts") > F.lit(at(24 * 3600)))).unionByName(
        curated(spark, {"event_ts": at(3 * 3600 + 1), "nameOrig": "new"}, {"event_ts": at(40 * 3600), "source_offset": "77"}))
    hours = [at(3600 * 3), at(3600 * 5), at(3600 * 40)]
    # Rows of other hours fail when they are read.
    guarded = right.withColumn("amount", F.when(
        F.col("batch_hour_utc").isin(hours), F.col("amount")).otherwise(F.raise_error(F.lit("read")).cast("double")))
    updated = build_warehouse(spark, guarded, reconcile.hourly_monitoring(right), f"{path}/wh", hours)
    full = build_warehouse(spark, right, reconcile.hourly_monitoring(right), f"{path}/full")
    assert content(updated) == content(full)
    assert updated.failed() == {} and full.failed() == {}
    text = updated.violations["fk_origin_account_key"]._jdf.queryExecution().executedPlan().toString()
    facts = [scan.split("\n")[0] for scan in text.split("FileScan")[1:] if "event_hour_utc" in scan.split("\n")[0]]
    assert facts and all(re.search(r"PartitionFilters: \[.*date_trunc\(hour, event_hour_utc", scan) for scan in facts), text


def test_percentiles_of_merged_sketches(spark):
    rows = curated(spark, *[{"fraud_score": i / 200, "event_ts": at(60 * i)} for i in range(200)], {"fraud_score": None, "type": "DEBIT"})
    sketches = quantiles.score_sketches(rows)
    assert sketches.count() == 5
    merged = {r["type"]: r for r in quantiles.merged_percentile(sketches, 0.95, "type").collect()}
    assert merged["TRANSFER"]["txn_count"] == 200 and 0.94 <= merged["TRANSFER"]["score_percentile"] <= 0.96
    assert merged["DEBIT"]["txn_count"] == 1 and merged["DEBIT"]["score_percentile"] is None


def test_facts_of_an_hour_are_in_one_file_however_the_rows_came(spark, sf, monkeypatch):
    from tallyward.plans import queries

    dealt = queries.fx.curated
    monkeypatch.setattr(queries.fx, "curated", lambda *given: dealt(*given).repartition(6))
    facts = queries._updated_warehouse.__wrapped__(spark, sf).tables["fct_scored_transactions"]
    files = facts.select("event_hour_utc", F.input_file_name().alias("file")).distinct().groupBy("event_hour_utc").count()
    assert {r["count"] for r in files.collect()} == {1}
