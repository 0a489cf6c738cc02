from __future__ import annotations

import random
from collections import Counter

import pytest
from frames import at, raw, scored
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.coercion import plain_number, to_bool
from tallyward.operators import scoring
from tallyward.operators.skew import key_load, spread_join


def one(df):
    return df.first().asDict()


@pytest.mark.parametrize("given, column, expected", [
    ({"step": "1.0"}, "step", 1), ({"step": ""}, "step", 0), ({"step": None}, "step", 0), ({"step": "x"}, "step", 0),
    ({"amount": ""}, "amount", 0.0), ({"amount": None}, "amount", 0.0), ({"amount": " 7 "}, "amount", 7.0),
    ({"amount": "abc"}, "amount", 0.0), ({"oldbalanceOrg": ""}, "oldbalanceOrg", 0.0),
    ({"type": ""}, "type", "UNKNOWN"), ({"type": None}, "type", "UNKNOWN"), ({"type": "CASH-OUT"}, "type", "CASH_OUT"),
    ({"nameOrig": " "}, "nameOrig", "UNKNOWN"), ({"nameDest": None}, "nameDest", "UNKNOWN"),
])
def test_coercion(spark, given, column, expected):
    assert one(scoring.coerce(raw(spark, given), at(0)))[column] == expected


@pytest.mark.parametrize("text, seconds", [
    ("2024-01-01T00:00:05+00:00", 5), ("2024-01-01T01:00:05+01:00", 5), ("2024-01-01 00:00:05", 5),
    ("2024-01-01T00:00:05Z", 5), ("", 99), (None, 99), ("yesterday", 99),
])
def test_event_time(spark, text, seconds):
    df = scoring.coerce(raw(spark, {"event_emitted_at_utc": text}), at(99))
    assert df.select(F.unix_timestamp("event_ts")).first()[0] == int(at(seconds).timestamp())


@pytest.mark.parametrize("value, dtype, expected", [
    (" TRUE ", T.StringType(), True), ("n", T.StringType(), False), ("maybe", T.StringType(), None),
    ("", T.StringType(), None), (None, T.StringType(), None), (1.0, T.DoubleType(), True),
    (0.0, T.DoubleType(), False), (2.0, T.DoubleType(), None), (None, T.DoubleType(), None),
    (1, T.IntegerType(), True), (True, T.BooleanType(), True), (None, T.BooleanType(), None),
])
def test_to_bool(spark, value, dtype, expected):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", dtype)]))
    assert df.select(to_bool(F.col("v"), dtype)).first()[0] is expected


def test_balance_features_on_zero_and_negative_balance(spark):
    df = scoring.add_balance_features(scored(
        spark, {"oldbalanceOrg": 0.0}, {"oldbalanceOrg": -5.0}, {"oldbalanceDest": 0.0, "newbalanceDest": 0.0}))
    rows = sorted(df.collect(), key=lambda r: r["source_offset"])
    assert [r["balance_change_ratio"] for r in rows] == [0.0, 0.0, 0.1]
    assert [r["is_new_merchant"] for r in rows] == [0.0, 0.0, 1.0]


@pytest.mark.parametrize("given, flags", [
    ({"fraud_score": 0.8}, (True, False, False, True)),
    ({"amount": 200000.0}, (False, True, False, True)),
    ({"amount": 200000.0, "type": "PAYMENT"}, (False, False, False, False)),
    ({"amount": 199999.99}, (False, False, False, False)),
    ({"velocity_5min": 5.0}, (False, False, True, True)),
])
def test_rules_at_their_thresholds(spark, given, flags):
    row = one(scoring.apply_rules(scored(spark, given)))
    assert (row["rule_high_score"], row["rule_high_amount_transfer"], row["rule_high_velocity"], row["is_alert"]) == flags


def test_velocity_on_bucket_borders_and_missing_account(spark):
    df = scored(
        spark, {"event_ts": at(0)}, {"event_ts": at(299.999)}, {"event_ts": at(300)},
        {"nameOrig": None}, {"nameOrig": "UNKNOWN"})
    found = {r["source_offset"]: r["velocity_5min"] for r in scoring.add_velocity(df.drop("velocity_5min")).collect()}
    assert found == {"0": 2.0, "1": 2.0, "2": 1.0, "3": 2.0, "4": 2.0}


def _skewed(spark, seed=7, n=3000):
    """A third of the rows belong to one account and bucket."""
    rng = random.Random(seed)
    changes = []
    for i in range(n):
        hot = i % 3 == 0
        changes.append({
            "nameOrig": "HOT" if hot else f"C{rng.randrange(200)}",
            "event_ts": at(10 if hot else rng.randrange(1200)), "amount": float(i)})
    return changes, scored(spark, *changes)


def test_velocity_of_a_hot_account_is_split_and_exact(spark):
    changes, df = _skewed(spark)
    expected = Counter((c["nameOrig"], int(c["event_ts"].timestamp()) // 300) for c in changes)
    out = scoring.add_velocity(df.drop("velocity_5min"), hot_rows=50)
    rows = out.collect()
    assert len(rows) == len(changes)
    assert all(r["velocity_5min"] == expected[(r["nameOrig"], int(r["event_ts"].timestamp()) // 300)] for r in rows)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    _, df = _skewed(spark)
    left = df.select("nameOrig", "source_offset", "amount")
    right = left.select("nameOrig").distinct().where("nameOrig <> 'C3'").withColumn("x", F.length("nameOrig"))
    plain = left.join(right, ["nameOrig"], how)
    ours = spread_join(left, right, ["nameOrig"], how, hot_rows=20)
    assert ours.columns == plain.columns
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_spread_join_keeps_null_and_signed_zero_keys_like_a_plain_join(spark):
    left = spark.createDataFrame([(0.0, i) for i in range(60)] + [(-0.0, 99), (None, 100)], "k double, i int")
    right = spark.createDataFrame([(-0.0, "zero"), (None, "null")], "k double, v string")
    rows = {r["i"]: r["v"] for r in spread_join(left, right, ["k"], "left", hot_rows=10).collect()}
    assert rows[0] == rows[99] == "zero" and rows[100] is None and len(rows) == 62


def test_spread_join_cuts_the_hot_key_into_pieces(spark):
    from tallyward.operators.skew import hot_buckets

    _, df = _skewed(spark)
    hot = hot_buckets(key_load(df, ["nameOrig"]), hot_rows=100).collect()
    assert len(hot) == 1 and hot[0]["_pieces"] == 10


def test_spread_join_refuses_a_join_it_cannot_salt(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        spread_join(df, df, ["id"], "full")


def test_model_features_use_stored_columns_or_recompute(spark):
    base = scored(spark, {"balance_change_ratio": None, "oldbalanceOrg": 100.0, "amount": 50.0}).withColumn("isFraud", F.lit("1"))
    stored = one(scoring.model_features(base))
    bare = one(scoring.model_features(base.drop("balance_change_ratio", "velocity_5min")))
    assert stored["balance_change_ratio"] == 0.0 and stored["velocity_5min"] == 1.0 and stored["isFraud"] == 1.0
    assert bare["balance_change_ratio"] == 0.5 and bare["velocity_5min"] == 0.0


@pytest.mark.parametrize("value, text", [
    (12.5, "12.5"), (200000.0, "200000.0"), (12345678.9, "12345678.9"), (1e10, "10000000000.0"),
    (0.0005, "0.0005"), (0.0, "0.0")])
def test_plain_number(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(plain_number(F.col("v"))).first()[0] == text
