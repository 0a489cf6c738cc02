from __future__ import annotations

import json

import pytest
from frames import at, scored
from pyspark.sql import functions as F

from tallyward.operators import envelope
from tallyward.schemas import MESSAGE, SILVER

GOOD = '{"payload":{"step":"1"}}'


def messages(spark, *values):
    return spark.createDataFrame(
        [(v, "topic", "0", str(i), "2024-01-01") for i, v in enumerate(values)], MESSAGE)


@pytest.mark.parametrize("text", [
    "not json", "", None, "null", '"text"', "[]", f"[{GOOD}]", "{}", '{"payload":null}', '{"payload":"text"}',
    '{"payload":[{"step":"1"}]}', GOOD[:-1], GOOD + " trailing", GOOD + ",", f"{GOOD},{GOOD}", GOOD + "]",
    "{'payload':{'step':'1'}}", '{"payload":{"step":"1"},}',
])
def test_bad_messages_are_quarantined_whole(spark, text):
    valid, bad = envelope.decode_envelopes(messages(spark, text))
    assert valid.count() == 0
    assert [r["value"] for r in bad.collect()] == [text]


@pytest.mark.parametrize("text, step, amount", [
    (GOOD, "1", ""), ('{"payload":{}}', "", ""), ('{"payload":{"step":1,"amount":12.5}}', "1", "12.5"),
    ('{"payload":{"step":null}}', "", ""), (f" {GOOD}\n", "1", ""),
])
def test_payload_fields_become_text(spark, text, step, amount):
    valid, bad = envelope.decode_envelopes(messages(spark, text))
    row = valid.first()
    assert bad.count() == 0 and (row["step"], row["amount"]) == (step, amount)


def test_fallbacks(spark):
    df = messages(spark, '{"emitted_at_utc":"outer","payload":{}}', '{"emitted_at_utc":"outer","payload":{"event_emitted_at_utc":"inner"}}')
    valid, _ = envelope.decode_envelopes(df.withColumn("topic", F.lit(None).cast("string")))
    rows = sorted(valid.collect(), key=lambda r: r["source_offset"])
    assert [r["event_emitted_at_utc"] for r in rows] == ["outer", "inner"]
    assert rows[0]["source_topic"] == "pubsub.subscription"


def test_binary_values_decode(spark):
    df = messages(spark, GOOD).withColumn("value", F.col("value").cast("binary"))
    assert envelope.decode_envelopes(df)[0].count() == 1


def test_envelope_carries_every_column_and_a_repeatable_id(spark):
    df = scored(spark, {"event_ts": at(1.5), "type": None})
    one, two = (envelope.encode_envelopes(df, emitted_at=at(n)).first() for n in (0, 9))
    body = json.loads(one["value"])
    assert one["key"] == two["key"] == body["event_id"]
    assert list(body) == ["schema_version", "event_id", "event_type", "source", "emitted_at_utc", "payload"]
    assert (body["schema_version"], body["event_type"]) == ("1.0", "fraud.alert")
    assert list(body["payload"]) == SILVER.fieldNames() and body["payload"]["type"] is None
    assert body["payload"]["event_ts"] == "2024-01-01 00:00:01.500000"


def test_alert_message_text(spark):
    row = envelope.alert_messages(scored(spark, {"fraud_score": 0.91237, "amount": 12345678.9, "is_alert": True})).first()
    assert row["subject"] == "[Fraud Alert] TRANSFER from C1 score=0.9124"
    assert row["body"] == (
        "High-risk transaction detected.\n\nnameOrig: C1\nnameDest: C2\ntype: TRANSFER\namount: 12345678.9\n"
        "fraud_score: 0.91237\npredicted_is_fraud: False\nis_alert: True\nevent_ts: 2024-01-01 00:00:00.000000\n")
    payload = json.loads(row["payload"])
    assert payload["subject"] == row["subject"] and payload["alert"]["nameDest"] == "C2"


def test_alert_message_without_fields(spark):
    row = envelope.alert_messages(spark.createDataFrame([(True,)], "is_alert boolean")).first()
    assert row["subject"] == "[Fraud Alert] UNKNOWN from UNKNOWN score=0.0000"
    assert "amount: 0\n" in row["body"] and "event_ts: None\n" in row["body"]
