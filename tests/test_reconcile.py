from __future__ import annotations

import pytest
from frames import at, scored
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators import reconcile, training
from tallyward.schemas import JOIN_KEYS


def labels_of(df, *values):
    rows = df.select(*JOIN_KEYS).collect()
    schema = T.StructType([df.schema[c] for c in JOIN_KEYS] + [T.StructField("isFraud", T.DoubleType())])
    return df.sparkSession.createDataFrame([(*r, v) for r, v in zip(rows, values)], schema)


def test_dedup_keeps_the_first_delivery_and_is_idempotent(spark):
    df = scored(
        spark,
        {"source_offset": "1", "kafka_ingest_ts": "b", "amount": 1.0},
        {"source_offset": "1", "kafka_ingest_ts": "a", "amount": 2.0},
        {"source_offset": "2", "kafka_ingest_ts": "c", "amount": 3.0})
    once = reconcile.dedup_scored(df)
    assert sorted(r["amount"] for r in once.collect()) == [2.0, 3.0]
    assert reconcile.dedup_scored(once).count() == 2
    assert sorted(r["amount"] for r in reconcile.dedup_scored(df.repartition(7)).collect()) == [2.0, 3.0]


def test_dedup_falls_back_to_business_key_and_time(spark):
    df = scored(spark, {}, {}, {"event_ts": at(1)}).drop("source_topic", "source_partition", "source_offset")
    assert reconcile.dedup_scored(df).count() == 2


def test_conflicting_labels_resolve_to_fraud(spark):
    df = scored(spark, {}, {}, {"amount": 2.0})
    unique = reconcile.dedup_labels(labels_of(df, 0.0, 1.0, 0.0))
    assert sorted((r["amount"], r["isFraud"]) for r in unique.collect()) == [(2.0, 0.0), (10.0, 1.0)]


def test_reconcile_keeps_unlabelled_rows_and_null_keys_do_not_match(spark):
    df = scored(spark, {}, {"amount": 2.0}, {"type": None})
    known = labels_of(df, 1.0, None, 0.0)
    rows = {r["source_offset"]: r for r in reconcile.reconcile(df, reconcile.dedup_labels(known), at(7200)).collect()}
    assert rows["0"]["isFraud"] == 1.0 and rows["0"]["is_label_available"] and rows["0"]["label_delay_hours"] == 2.0
    assert not rows["1"]["is_label_available"] and rows["1"]["label_delay_hours"] is None
    assert not rows["2"]["is_label_available"]


def test_reconcile_of_a_hot_business_key(spark):
    df = scored(spark, *[{} for _ in range(300)], *[{"amount": float(i)} for i in range(100, 400)])
    known = reconcile.dedup_labels(labels_of(df, *[1.0] * 600))
    out = reconcile.reconcile(df, known, at(0), hot_rows=20)
    assert out.count() == 600 and out.where("isFraud = 1").count() == 600


@pytest.mark.parametrize("hour, offsets", [("2024-01-01-00", {"0", "1"}), ("2024-01-01-01", {"2"}), (None, {"0", "1", "2"})])
def test_hour_filter_includes_its_start_and_not_its_end(spark, hour, offsets):
    df = scored(spark, {"event_ts": at(0)}, {"event_ts": at(3599.999)}, {"event_ts": at(3600)})
    assert {r["source_offset"] for r in reconcile.filter_hour(df, hour).collect()} == offsets


def test_empty_hour_is_an_error(spark):
    with pytest.raises(ValueError):
        reconcile.require_rows(reconcile.filter_hour(scored(spark, {}), "2030-01-01-00"))


def test_monitoring_rates_and_percentile(spark):
    df = scored(spark, *[{"fraud_score": i / 100, "is_alert": i >= 90} for i in range(100)])
    df = df.withColumns(reconcile.label_columns(at(0))) if "isFraud" in df.columns else df.withColumns({
        "isFraud": F.when(F.col("fraud_score") >= 0.5, F.lit(1.0)), "is_label_available": F.col("fraud_score") >= 0.5})
    row = reconcile.hourly_monitoring(df).first()
    assert (row["txn_count"], row["alert_count"], row["alert_rate"]) == (100, 10, 0.1)
    assert row["p95_fraud_score"] == 0.94 and row["observed_fraud_rate"] == 1.0


def test_class_weights_floor_an_absent_class_at_one(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,)], "isFraud double")
    row = training.class_weights(df).first()
    assert (row["fraud_count"], row["nonfraud_count"]) == (1, 3)
    assert row["fraud_weight"] == 2.0 and row["nonfraud_weight"] == pytest.approx(4 / 6)
    assert training.with_class_weight(df).first()["class_weight"] == pytest.approx(4 / 6)


def test_split_is_stable_and_near_70_15_15(spark):
    df = scored(spark, *[{"amount": float(i)} for i in range(2000)])
    first = {r["source_offset"]: r["dataset_split"] for r in training.split(df).collect()}
    again = {r["source_offset"]: r["dataset_split"] for r in training.split(df.repartition(5)).collect()}
    assert first == again
    share = {s: list(first.values()).count(s) / 2000 for s in ["train", "validation", "test"]}
    assert abs(share["train"] - 0.7) < 0.05 and abs(share["test"] - 0.15) < 0.04


@pytest.mark.parametrize("rows", [1, 37, 150, 1000])
def test_cap_is_the_lowest_digests_and_copies_count_one_by_one(spark, rows):
    df = scored(spark, *[{"amount": float(i)} for i in range(100)], *[{"amount": 5.0}] * 50).select(*JOIN_KEYS)
    capped = training.cap_rows(df, rows)
    ranked = df.withColumn("d", training.key_digest()).orderBy("d").limit(rows).drop("d")
    assert sorted(map(tuple, capped.collect())) == sorted(map(tuple, ranked.collect()))
    assert training.cap_rows(df, 0).count() == 150


@pytest.mark.parametrize("values, may, reason", [
    ([1.0, 0.0], True, "ok"), ([0.0, 0.0], False, "labels are not exactly {0, 1}"), ([None], False, "no labelled rows"),
    ([0.0, 1.0, 2.0], False, "labels are not exactly {0, 1}")])
def test_refresh_gate(spark, values, may, reason):
    row = training.refresh_gate(spark.createDataFrame([(v,) for v in values], "isFraud double")).first()
    assert (row["may_refresh"], row["reason"]) == (may, reason)


def test_stored_labels_give_the_same_rows(spark, tmp_path):
    from tallyward.sources import sinks

    rows = scored(spark, {}, {"amount": 3.0}, {"amount": 3.0}, {"amount": -0.0}, {"nameOrig": None}, {"amount": 9.0, "step": 2},
                  {"oldbalanceDest": float("nan")})
    names = [*JOIN_KEYS, "isFraud"]
    known = rows.where("source_offset <> '5'").select(*JOIN_KEYS, F.lit(0.0).alias("isFraud"))
    conflict = rows.where("source_offset = '1'").select(*JOIN_KEYS, F.lit(1.0).alias("isFraud"))
    sinks.ensure_database(spark, "same_rows", location=str(tmp_path))
    for part in (known, conflict):
        sinks.store_labels(part, "same_rows.labels", buckets=4)
    plain = reconcile.reconcile(rows, reconcile.dedup_labels(known.unionByName(conflict)), at(7200))
    for hot_rows in (1, 1000):
        load = reconcile.business_key_load(rows, stored=True)
        found = reconcile.reconcile(rows, reconcile.dedup_labels(spark.table("same_rows.labels")), at(7200), load, hot_rows)
        assert found.columns == plain.columns
        assert sorted(map(repr, found.select("source_offset", *names).collect())) == sorted(map(repr, plain.select("source_offset", *names).collect()))
    assert {r["source_offset"]: r["isFraud"] for r in plain.collect()} == {
        "0": 0.0, "1": 1.0, "2": 1.0, "3": 0.0, "4": None, "5": None, "6": 0.0}
    from tallyward.plans import jobs

    counts = jobs.hourly(spark, rows, spark.table("same_rows.labels"), str(tmp_path / "hourly"), as_of=at(7200))
    assert counts["curated_rows"] == 7 and counts["labelled_rows"] == 5


def test_buckets_of_stored_labels_follow_their_number(spark, sf, monkeypatch):
    from tallyward.plans import queries
    from tallyward.sources import sinks

    made = []
    store = sinks.store_labels
    monkeypatch.setattr(sinks, "LABELS_A_BUCKET", 50)
    monkeypatch.setattr(sinks, "store_labels", lambda part, table, buckets: (made.append(buckets), store(part, table, buckets)))
    rows = queries.reconcile_labels_bucketed(spark, sf)
    known = queries.fx.labels(spark, sf).count()
    assert len(made) == 2 and made[0] == made[1] == sinks.label_buckets(known) and known / made[0] <= 50 < 2 * known / made[0]
    assert rows.count() == queries.fx.transactions(spark, sf).count()
    assert [sinks.label_buckets(n) for n in (0, 1, 400, 401)] == [8, 8, 8, 16]
