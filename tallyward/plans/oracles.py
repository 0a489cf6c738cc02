"""DuckDB statements that give the same rows as the queries of the same name."""

from __future__ import annotations

BASE = 1704067200000000
AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
TS = "'%Y-%m-%d %H:%M:%S.%f'"
KEYS = "step type amount:f nameOrig nameDest oldbalanceOrg:f newbalanceOrig:f oldbalanceDest:f newbalanceDest:f"
KEY_LIST = KEYS.replace(":f", "").replace(" ", ", ")

# Formats of an output column: t timestamp, d date, b boolean, f double, m money, n nullable number.
FORMATS = {
    "t": f"strftime({{}}, {TS})",
    "d": "CAST({} AS VARCHAR)",
    "b": "CAST({} AS VARCHAR)",
    "f": "round(CAST({} AS DOUBLE) + 1e-9, 6)",
    "m": "round(CAST({} AS DOUBLE), 4)",
    "n": "CAST({} AS DOUBLE)",
    "i": "CAST({} AS BIGINT)",
}


def shown(columns: str, prefix: str = "") -> str:
    out = []
    for item in columns.split():
        name, _, kind = item.partition(":")
        col = prefix + name
        out.append(f"{FORMATS[kind].format(col) if kind else col} AS {name}")
    return ", ".join(out)


CTES = {
    "txn": f"""
ev AS (
  SELECT event_id, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, (epoch_us(ts) - {BASE}) // 60 AS cus
  FROM events),
shaped AS (
  SELECT ev.event_id, ev.k, 'transactions_raw' AS source_topic,
         CAST(ev.event_id % 4 AS VARCHAR) AS source_partition, CAST(ev.event_id AS VARCHAR) AS source_offset,
         make_timestamp({BASE} + ev.cus) AS event_ts,
         CAST(ev.cus // 3600000000 AS INTEGER) AS step,
         CASE ev.event_type WHEN 'purchase' THEN 'TRANSFER' WHEN 'signup' THEN 'CASH_OUT'
              WHEN 'click' THEN 'PAYMENT' WHEN 'view' THEN 'CASH_IN' WHEN 'error' THEN 'DEBIT' END AS type,
         ev.value * CAST(2000.0 AS DOUBLE) AS amount,
         'C' || CAST(ev.user_id // 4 AS VARCHAR) AS nameOrig,
         CASE WHEN ev.k % 3 = 0 THEN 'M' || CAST(ev.k AS VARCHAR) ELSE 'C' || CAST(ev.k // 4 AS VARCHAR) END AS nameDest,
         greatest(coalesce(p.c_acctbal, CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) * 100 AS oldbalanceOrg,
         CASE WHEN ev.k % 3 = 0 THEN CAST(0 AS DOUBLE)
              ELSE greatest(coalesce(q.c_acctbal, CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) * 100 END AS oldbalanceDest
  FROM ev LEFT JOIN customer p ON p.c_custkey = ev.user_id LEFT JOIN customer q ON q.c_custkey = ev.k),
txn AS (
  SELECT *, strftime(event_ts, {TS}) AS kafka_ingest_ts, strftime(event_ts, {TS}) AS event_emitted_at_utc,
         greatest(oldbalanceOrg - amount, CAST(0 AS DOUBLE)) AS newbalanceOrig,
         CASE WHEN k % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE oldbalanceDest + amount END AS newbalanceDest,
         least(CAST(1 AS DOUBLE), amount / CAST(400000 AS DOUBLE)) AS fraud_score,
         CASE WHEN event_id % 10 = 0 THEN NULL
              WHEN type IN ('TRANSFER', 'CASH_OUT') AND amount >= 150000 AND k % 2 = 0 THEN CAST(1 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS isFraud
  FROM shaped)""",
    "raw": f"""
raw AS (
  SELECT * REPLACE (
           CASE WHEN event_id % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE amount END AS amount,
           CASE WHEN event_id % 89 = 0 THEN 'UNKNOWN' ELSE type END AS type,
           CASE WHEN event_id % 83 = 0 THEN {AS_OF} ELSE event_ts END AS event_ts,
           CASE WHEN event_id % 83 = 0 THEN '' ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END
             AS event_emitted_at_utc)
  FROM txn)""",
    "received": "received AS (SELECT * FROM raw WHERE event_id % 71 <> 0)",
    "scored": "",
    "again": """
again AS (
  SELECT * FROM scored
  UNION ALL
  SELECT * REPLACE (kafka_ingest_ts || '+1' AS kafka_ingest_ts) FROM scored WHERE event_id % 20 = 0)""",
    "labels": f"""
labels AS (
  SELECT {KEY_LIST}, isFraud FROM txn WHERE isFraud IS NOT NULL
  UNION ALL
  SELECT {KEY_LIST}, 1 - isFraud FROM txn WHERE isFraud IS NOT NULL AND event_id % 50 = 1)""",
    "unique_labels": f"unique_labels AS (SELECT {KEY_LIST}, max(isFraud) AS isFraud FROM labels GROUP BY ALL)",
    "first": """
first AS (
  SELECT * FROM again
  QUALIFY row_number() OVER (
    PARTITION BY source_topic, source_partition, source_offset ORDER BY kafka_ingest_ts) = 1)""",
    "reconciled": f"""
reconciled AS (
  SELECT f.* EXCLUDE (isFraud), l.isFraud, l.isFraud IS NOT NULL AS is_label_available,
         CASE WHEN l.isFraud IS NOT NULL
              THEN (epoch({AS_OF}) - floor(epoch(f.event_ts))) / 3600.0 END AS label_delay_hours
  FROM first f LEFT JOIN unique_labels l USING ({KEY_LIST}))""",
    "curated": f"""
curated AS (
  SELECT *, isFraud IS NOT NULL AS is_label_available,
         CASE WHEN isFraud IS NOT NULL
              THEN (epoch({AS_OF}) - floor(epoch(event_ts))) / 3600.0 END AS label_delay_hours,
         date_trunc('hour', event_ts) AS batch_hour_utc
  FROM scored)""",
    "doubled": """
doubled AS (SELECT * FROM curated UNION ALL SELECT * FROM curated WHERE event_id % 20 = 0)""",
    "monitoring": """
monitoring AS (
  SELECT date_trunc('hour', event_ts) AS batch_hour_utc, type, count(*) AS txn_count,
         count(*) FILTER (is_alert) AS alert_count, avg(fraud_score) AS avg_fraud_score,
         quantile_disc(fraud_score, 0.95) AS p95_fraud_score,
         avg(isFraud) FILTER (is_label_available) AS observed_fraud_rate,
         count(*) FILTER (is_alert) / count(*) AS alert_rate
  FROM curated GROUP BY 1, 2)""",
}


def scored_cte(name: str, source: str) -> str:
    return f"""
{name}_featured AS (
  SELECT *, CAST(count(*) OVER (PARTITION BY nameOrig, floor(epoch(event_ts) / 300)) AS DOUBLE) AS velocity_5min,
         CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE CAST(0 AS DOUBLE) END AS balance_change_ratio,
         CASE WHEN oldbalanceDest = 0 AND newbalanceDest = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS is_new_merchant,
         oldbalanceOrg - newbalanceOrig AS origin_balance_delta,
         newbalanceDest - oldbalanceDest AS dest_balance_delta
  FROM (SELECT * REPLACE (least(CAST(1 AS DOUBLE), amount / CAST(400000 AS DOUBLE)) AS fraud_score) FROM {source})),
{name} AS (
  SELECT *, fraud_score > 0.5 AS predicted_is_fraud, fraud_score >= 0.8 AS rule_high_score,
         type IN ('TRANSFER', 'CASH_OUT') AND amount >= 200000 AS rule_high_amount_transfer,
         velocity_5min >= 5 AS rule_high_velocity,
         fraud_score >= 0.8 OR (type IN ('TRANSFER', 'CASH_OUT') AND amount >= 200000) OR velocity_5min >= 5 AS is_alert
  FROM {name}_featured)"""


CTES["scored"] = scored_cte("scored", "txn")
CTES["streamed"] = scored_cte("streamed", "received")


def fct_cte(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT md5(concat_ws('|', CAST(step AS VARCHAR), coalesce(type, ''), nameOrig, nameDest,
                       strftime(event_ts, {TS}), source_partition, source_offset)) AS transaction_key,
         event_ts, date_trunc('hour', event_ts) AS event_hour_utc, CAST(event_ts AS DATE) AS event_date,
         CAST(step AS BIGINT) AS step, type AS transaction_type, md5(type) AS transaction_type_key,
         nameOrig AS origin_account, md5(nameOrig) AS origin_account_key,
         nameDest AS destination_account, md5(nameDest) AS destination_account_key,
         CAST(amount AS DECIMAL(38,9)) AS amount,
         CAST(oldbalanceOrg AS DECIMAL(38,9)) AS old_balance_origin,
         CAST(newbalanceOrig AS DECIMAL(38,9)) AS new_balance_origin,
         CAST(oldbalanceDest AS DECIMAL(38,9)) AS old_balance_destination,
         CAST(newbalanceDest AS DECIMAL(38,9)) AS new_balance_destination,
         velocity_5min, balance_change_ratio, is_new_merchant = 1 AS is_new_merchant,
         origin_balance_delta, dest_balance_delta AS destination_balance_delta,
         fraud_score, predicted_is_fraud, is_alert, CAST(isFraud AS BIGINT) AS is_fraud_label,
         is_label_available, label_delay_hours, source_topic,
         CAST(source_partition AS BIGINT) AS source_partition, CAST(source_offset AS BIGINT) AS source_offset
  FROM {source})"""


def dim_account_cte(name: str, fct: str, sides: tuple[str, ...] = ("origin", "destination")) -> str:
    touches = " UNION ALL ".join(
        f"SELECT {side}_account AS account_id, event_ts, amount FROM {fct}" for side in sides)
    return f"""
{name} AS (
  SELECT md5(account_id) AS account_key, account_id, min(event_ts) AS first_seen_ts, max(event_ts) AS last_seen_ts,
         count(*) AS transaction_touch_count, sum(amount) AS total_amount_touched
  FROM ({touches}) WHERE account_id IS NOT NULL GROUP BY account_id)"""


def mart_cte(name: str, fct: str) -> str:
    return f"""
{name} AS (
  SELECT s.*, CAST(s.alert_count AS DOUBLE) / s.transaction_count AS alert_rate_recomputed,
         m.alert_rate AS alert_rate_batch, m.p95_fraud_score
  FROM (SELECT event_hour_utc, transaction_type, count(*) AS transaction_count,
               count(*) FILTER (is_alert) AS alert_count, avg(fraud_score) AS avg_fraud_score,
               max(fraud_score) AS max_fraud_score,
               avg(is_fraud_label) FILTER (is_label_available) AS observed_fraud_rate
        FROM {fct} GROUP BY 1, 2) s
  LEFT JOIN monitoring m ON s.event_hour_utc = m.batch_hour_utc AND s.transaction_type = m.type)"""


CTES["fct"] = fct_cte("fct", "curated")
CTES["fct_doubled"] = fct_cte("fct_doubled", "doubled")
CTES["alerts"] = "alerts AS (SELECT * FROM fct WHERE is_alert)"
CTES["dim_account"] = dim_account_cte("dim_account", "fct")
CTES["mart"] = mart_cte("mart", "fct")

CURATED = ["txn", "scored", "curated"]
FCT = [*CURATED, "fct"]
MART = [*FCT, "monitoring", "mart"]
RECONCILED = ["txn", "scored", "again", "first", "labels", "unique_labels", "reconciled"]


def sql(ctes: list[str], body: str, *extra: str) -> str:
    return "WITH " + ",\n".join([CTES[name].strip() for name in ctes] + [e.strip() for e in extra]) + "\n" + body


SHOWN = ("source_topic source_partition source_offset kafka_ingest_ts event_ts:t type amount:f "
         "velocity_5min:f fraud_score:f is_alert:b")
FEATURES = "velocity_5min:f balance_change_ratio:f is_new_merchant:f origin_balance_delta:f dest_balance_delta:f"
RULES = "rule_high_score:b rule_high_amount_transfer:b rule_high_velocity:b"
BRONZE = ("source_topic source_partition source_offset kafka_ingest_ts event_emitted_at_utc event_ts:t step type "
          "amount:f nameOrig oldbalanceOrg:f newbalanceOrig:f nameDest oldbalanceDest:f newbalanceDest:f")
SILVER = f"{BRONZE} {FEATURES} fraud_score:f predicted_is_fraud:b is_alert:b {RULES}"
STG = ("step transaction_type amount:m origin_account destination_account old_balance_origin:m new_balance_origin:m "
       "old_balance_destination:m new_balance_destination:m event_ts:t fraud_score:f predicted_is_fraud:b is_alert:b "
       "is_fraud_label:n is_label_available:b label_delay_hours:f velocity_5min:f balance_change_ratio:f "
       "is_new_merchant:b origin_balance_delta:f destination_balance_delta:f source_topic source_partition "
       "source_offset event_date:d event_hour_utc:t")
FCT_COLUMNS = STG + " transaction_key transaction_type_key origin_account_key destination_account_key"
ALERT_COLUMNS = ("transaction_key event_ts:t event_hour_utc:t event_date:d transaction_type transaction_type_key "
                 "origin_account origin_account_key destination_account destination_account_key amount:m fraud_score:f "
                 "predicted_is_fraud:b is_fraud_label:n is_label_available:b label_delay_hours:f source_topic "
                 "source_partition source_offset")
MART_COLUMNS = ("event_hour_utc:t transaction_type transaction_count alert_count alert_rate_recomputed:f "
                "alert_rate_batch:f avg_fraud_score:f p95_fraud_score:f max_fraud_score:f observed_fraud_rate:f")
LAKE = "source_offset event_ts:t type amount:f is_alert:b"

TILES = """
SELECT count(transaction_key) AS total_transactions,
       count(*) FILTER (is_label_available AND is_fraud_label = 1) AS real_fraud_transactions,
       count(*) FILTER (is_alert) AS alerted_transactions,
       count(*) FILTER (is_label_available AND is_fraud_label = 1 AND is_alert) AS real_fraud_alerted,
       count(*) FILTER (is_label_available AND is_fraud_label = 1 AND NOT is_alert) AS real_fraud_not_alerted,
       round(1e-9 + CAST(count(*) FILTER (is_alert) AS DOUBLE) / count(*), 6) AS alert_share,
       round(1e-9 + CAST(count(*) FILTER (is_label_available AND is_fraud_label = 1 AND is_alert) AS DOUBLE)
             / count(*) FILTER (is_label_available AND is_fraud_label = 1), 6) AS real_fraud_alerted_share,
       round(1e-9 + CAST(count(*) FILTER (is_label_available AND is_fraud_label = 1 AND NOT is_alert) AS DOUBLE)
             / count(*) FILTER (is_label_available AND is_fraud_label = 1), 6) AS real_fraud_not_alerted_share,
       round(1e-9 + CAST(count(*) FILTER (is_label_available) AS DOUBLE) / count(*), 6) AS label_coverage
FROM fct"""

DIGEST = ("md5(concat_ws('|', CAST(step AS VARCHAR), type, CAST(CAST(floor(amount * 100) AS BIGINT) AS VARCHAR), "
          "nameOrig, nameDest, " + ", ".join(
              f"CAST(CAST(floor({c} * 100) AS BIGINT) AS VARCHAR)" for c in
              ["oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]) + "))")


def missing_fk(dim: str, fk: str, pk: str) -> str:
    return f"SELECT f.transaction_key FROM fct f LEFT JOIN {dim} d ON f.{fk} = d.{pk} WHERE f.{fk} IS NOT NULL AND d.{pk} IS NULL"


def top_accounts(side: str) -> str:
    return (f"(SELECT '{side}' AS side, {side}_account AS account, count(*) AS alert_count, "
            f"round(1e-9 + avg(fraud_score), 6) AS avg_fraud_score FROM alerts GROUP BY {side}_account "
            f"ORDER BY alert_count DESC, account LIMIT 10)")


def duplicates(table: str, key: str) -> str:
    return (f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS key, count(*) AS row_count "
            f"FROM {table} GROUP BY {key} HAVING count(*) > 1")


def nulls(name: str, source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows, "
        f"count(*) AS total_rows FROM {source}" for c in columns)


def gate(tag: str, condition: str) -> str:
    return f"""
SELECT '{tag}' AS labels, count(isFraud) AS labelled_rows, count(*) FILTER (isFraud = 1) AS fraud_rows,
       count(*) FILTER (isFraud = 0) AS nonfraud_rows, count(*) FILTER (isFraud NOT IN (0, 1)) AS other_rows,
       CAST(count(*) FILTER (isFraud = 1) > 0 AND count(*) FILTER (isFraud = 0) > 0 AS VARCHAR) AS may_refresh,
       CASE WHEN count(isFraud) = 0 THEN 'no labelled rows'
            WHEN count(*) FILTER (isFraud = 1) = 0 OR count(*) FILTER (isFraud = 0) = 0
            THEN 'labels are not exactly {{0, 1}}' ELSE 'ok' END AS reason
FROM txn WHERE {condition}"""


CONTRACT = [
    ("transaction_key", "string", "string"), ("event_ts", "timestamp", "timestamp"),
    ("event_hour_utc", "timestamp", "timestamp"), ("event_date", "date", "date"), ("step", "bigint", "int"),
    ("transaction_type", "string", "string"), ("transaction_type_key", "string", "string"),
    ("origin_account", "string", "string"), ("origin_account_key", "string", "string"),
    ("destination_account", "string", "string"), ("destination_account_key", "string", "string"),
    ("amount", "decimal(38,9)", "decimal(38,9)"), ("old_balance_origin", "decimal(38,9)", "decimal(38,9)"),
    ("new_balance_origin", "decimal(38,9)", "decimal(38,9)"),
    ("old_balance_destination", "decimal(38,9)", "decimal(38,9)"),
    ("new_balance_destination", "decimal(38,9)", "decimal(38,9)"), ("velocity_5min", "double", "double"),
    ("balance_change_ratio", "double", "double"), ("is_new_merchant", "boolean", "boolean"),
    ("origin_balance_delta", "double", "double"), ("destination_balance_delta", "double", "double"),
    ("fraud_score", "double", "double"), ("predicted_is_fraud", "boolean", "boolean"),
    ("is_alert", "boolean", "boolean"), ("is_fraud_label", "bigint", "bigint"),
    ("is_label_available", "boolean", "boolean"), ("label_delay_hours", "double", "missing"),
    ("source_topic", "string", "string"), ("source_partition", "bigint", "bigint"),
    ("source_offset", "bigint", "bigint"),
]


def contract_line(name: str, wanted: str, found: str) -> str:
    counted = "count(*)" if found == "missing" else f"count(*) FILTER ({name} IS NULL)"
    return (f"SELECT '{name}' AS column_name, '{wanted}' AS expected_type, '{found}' AS actual_type, "
            f"'{str(wanted == found).lower()}' AS matches, {counted} AS null_rows FROM fct")


def each_of(columns: str, source: str, tag: str, names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS {tag}, {columns} FROM {source}" for n in names)


SPELLINGS = ["true", "true", "true", "true", "true", "false", "false", "false", "false", "false", None, None]

MESSAGE_BODY = (
    "'High-risk transaction detected.' || chr(10) || chr(10) || 'nameOrig: ' || nameOrig || chr(10) || "
    "'nameDest: ' || nameDest || chr(10) || 'type: ' || type || chr(10) || "
    "'amount: ' || {amount} || chr(10) || 'fraud_score: ' || {score} || chr(10) || "
    "'predicted_is_fraud: ' || CASE WHEN predicted_is_fraud THEN 'True' ELSE 'False' END || chr(10) || "
    f"'is_alert: True' || chr(10) || 'event_ts: ' || strftime(event_ts, {TS}) || chr(10)"
)


def plain(col: str) -> str:
    def long(scale: int) -> str:
        # By way of text, so that the number's own digits are cut and not those of its binary value.
        return f"regexp_replace(CAST(CAST(CAST({col} AS VARCHAR) AS DECIMAL(38,{scale})) AS VARCHAR), '0+$', '')"

    return (f"CASE WHEN {col} = 0 OR abs({col}) BETWEEN 0.001 AND 9999999.0 THEN CAST({col} AS VARCHAR) "
            f"ELSE regexp_replace(CASE WHEN abs({col}) < 0.001 THEN {long(30)} ELSE {long(9)} END, '\\.$', '.0') END")


ORACLES: dict[str, str] = {
    "coerce_defaults": sql(["txn", "raw"], f"SELECT source_offset, {shown(KEYS)} FROM raw"),
    "event_time": sql(["txn", "raw"], f"SELECT {shown('source_offset event_ts:t')} FROM raw"),
    "velocity_5min": sql(["txn", "scored"], f"SELECT {shown('source_offset nameOrig event_ts:t velocity_5min:f')} FROM scored"),
    "features": sql(["txn", "scored"], "SELECT source_offset, " + shown(FEATURES.replace("velocity_5min:f ", "")) + " FROM scored"),
    "alert_rules": sql(["txn", "scored"], "SELECT " + shown(
        f"source_offset type amount:f fraud_score:f velocity_5min:f {RULES} is_alert:b") + " FROM scored"),
    "to_bool": sql(["txn"], "SELECT source_offset, CASE event_id % 12 " + " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(SPELLINGS)) + """ END AS as_text,
       CASE event_id % 3 WHEN 1 THEN 'true' WHEN 0 THEN 'false' END AS as_number,
       CAST(event_id % 2 = 0 AS VARCHAR) AS as_flag FROM txn"""),
    "model_features": sql(["txn", "scored"], f"""
SELECT 'stored' AS features_from, source_offset, isFraud, {shown(FEATURES)} FROM (
  SELECT * REPLACE (CASE WHEN event_id % 7 <> 0 THEN balance_change_ratio ELSE CAST(0 AS DOUBLE) END AS balance_change_ratio)
  FROM scored)
UNION ALL
SELECT 'recomputed' AS features_from, source_offset, isFraud, {shown(FEATURES)} FROM (
  SELECT * REPLACE (CAST(0 AS DOUBLE) AS velocity_5min) FROM scored)"""),
    "dedup_scored": sql(["txn", "scored", "again", "first"], f"SELECT {shown(SHOWN)} FROM first"),
    "dedup_scored_fallback": sql(["txn", "scored", "again"], "SELECT " + shown(
        " ".join(SHOWN.split()[3:]) + " step nameOrig nameDest oldbalanceOrg:f newbalanceOrig:f oldbalanceDest:f newbalanceDest:f")
        + f" FROM again QUALIFY row_number() OVER (PARTITION BY {KEY_LIST}, event_ts ORDER BY kafka_ingest_ts) = 1"),
    "labels_unique": sql(["txn", "labels", "unique_labels"], f"SELECT {shown(KEYS)}, isFraud FROM unique_labels"),
    "labels_scan": sql(["txn"], f"SELECT {shown(KEYS)}, isFraud FROM txn"),
    "reconcile_labels": sql(RECONCILED, "SELECT " + shown(
        SHOWN + " isFraud is_label_available:b label_delay_hours:f") + " FROM reconciled"),
    "reconcile_labels_bucketed": sql(RECONCILED, "SELECT " + shown(
        SHOWN + " isFraud is_label_available:b label_delay_hours:f") + " FROM reconciled"),
    "hour_filter": sql(["txn"], "SELECT " + shown("source_offset event_ts:t type amount:f") + """ FROM txn
WHERE date_trunc('hour', event_ts) = TIMESTAMP '2024-01-01 05:00:00'"""),
    "hourly_monitoring": sql([*CURATED, "monitoring"], "SELECT " + shown(
        "batch_hour_utc:t type txn_count alert_count avg_fraud_score:f p95_fraud_score:f observed_fraud_rate:f "
        "alert_rate:f") + " FROM monitoring"),
    "hourly_overwrite": sql(RECONCILED, f"""
SELECT source_offset, strftime(date_trunc('hour', event_ts), {TS}) AS batch_hour_utc,
       CASE WHEN date_trunc('hour', event_ts) <> TIMESTAMP '2024-01-01 05:00:00' THEN isFraud END AS isFraud,
       CAST(date_trunc('hour', event_ts) <> TIMESTAMP '2024-01-01 05:00:00' AND is_label_available AS VARCHAR)
         AS is_label_available
FROM reconciled"""),
    "hourly_retraining_rerun": sql(RECONCILED, f"""
SELECT source_offset, strftime(date_trunc('hour', event_ts), {TS}) AS batch_hour_utc, isFraud
FROM reconciled WHERE is_label_available AND date_trunc('hour', event_ts) <> TIMESTAMP '2024-01-01 05:00:00'"""),
    "batch_metrics": sql(RECONCILED, """
SELECT 'silver_rows' AS metric, count(*) AS row_count FROM again
UNION ALL SELECT 'curated_rows', count(*) FROM reconciled
UNION ALL SELECT 'labelled_rows', count(*) FROM reconciled WHERE is_label_available
UNION ALL SELECT 'retraining_rows', count(*) FROM reconciled WHERE is_label_available
UNION ALL SELECT 'monitoring_rows', count(DISTINCT (date_trunc('hour', event_ts), type)) FROM reconciled"""),
    "stg_curated_scored": sql(FCT, f"SELECT {shown(STG)} FROM fct"),
    "stg_monitoring_hourly": sql([*CURATED, "monitoring"], f"""
SELECT strftime(batch_hour_utc, {TS}) AS event_hour_utc, type AS transaction_type, txn_count AS transaction_count,
       {shown("alert_count avg_fraud_score:f p95_fraud_score:f observed_fraud_rate:f alert_rate:f")} FROM monitoring"""),
    "dim_account": sql([*FCT, "dim_account"], "SELECT " + shown(
        "account_key account_id first_seen_ts:t last_seen_ts:t transaction_touch_count total_amount_touched:m")
        + " FROM dim_account"),
    "dim_transaction_type": sql(["txn"], "SELECT DISTINCT md5(type) AS transaction_type_key, type AS transaction_type FROM txn"),
    "dim_time_hour": sql(["txn"], f"""
SELECT strftime(h, {TS}) AS time_hour_utc, CAST(CAST(h AS DATE) AS VARCHAR) AS event_date, year(h) AS event_year,
       month(h) AS event_month, day(h) AS event_day, hour(h) AS event_hour, strftime(h, '%A') AS day_name,
       strftime(h, '%Y-%m-%d %H:00:00 UTC') AS hour_label_utc
FROM (SELECT DISTINCT date_trunc('hour', event_ts) AS h FROM txn)"""),
    "fct_scored_transactions": sql(FCT, f"SELECT {shown(FCT_COLUMNS)} FROM fct"),
    "fct_fraud_alerts": sql([*FCT, "alerts"], f"SELECT {shown(ALERT_COLUMNS)} FROM alerts"),
    "mart_fraud_hourly_kpis": sql(MART, f"SELECT {shown(MART_COLUMNS)} FROM mart"),
    "warehouse_incremental": sql(MART, f"SELECT {shown(MART_COLUMNS)} FROM mart"),
    "warehouse_incremental_accounts": sql([*FCT, "dim_account"], "SELECT " + shown(
        "account_key account_id first_seen_ts:t last_seen_ts:t transaction_touch_count total_amount_touched:m")
        + " FROM dim_account"),
    "warehouse_job": sql([*MART, "alerts", "dim_account"], """
SELECT 'dim_account' AS table_name, count(*) AS row_count FROM dim_account
UNION ALL SELECT 'dim_transaction_type', count(DISTINCT transaction_type) FROM fct
UNION ALL SELECT 'dim_time_hour', count(DISTINCT event_hour_utc) FROM fct
UNION ALL SELECT 'fct_scored_transactions', count(*) FROM fct
UNION ALL SELECT 'fct_fraud_alerts', count(*) FROM alerts
UNION ALL SELECT 'mart_fraud_hourly_kpis', count(*) FROM mart
UNION ALL SELECT 'violations', 0"""),
    "load_job": sql([*CURATED, "monitoring"], """
SELECT 'curated_scored' AS table_name, count(*) AS row_count, count(DISTINCT batch_hour_utc) AS hours FROM curated
UNION ALL SELECT 'curated_scored_after_failure', count(*), count(DISTINCT batch_hour_utc) FROM curated
UNION ALL SELECT 'retraining_dataset', count(*), count(DISTINCT batch_hour_utc) FROM curated WHERE is_label_available
UNION ALL SELECT 'monitoring_hourly', count(*), count(DISTINCT batch_hour_utc) FROM monitoring"""),
    "percentiles_merged": sql(CURATED, """
SELECT CAST(CAST(event_ts AS DATE) AS VARCHAR) AS event_date, kind AS transaction_type, count(*) AS txn_count, 'true' AS within_error
FROM (SELECT event_ts, unnest([type, 'ALL']) AS kind FROM curated) GROUP BY 1, 2"""),
    "dq_unique": sql([*CURATED, "doubled"], " UNION ALL ".join([
        duplicates("dim_account", "account_key"), duplicates("dim_time_hour", "time_hour_utc"),
        duplicates("dim_transaction_type", "transaction_type_key"),
        duplicates("fct_scored_transactions", "transaction_key")]),
        fct_cte("fct_scored_transactions", "doubled"),
        dim_account_cte("dim_account", "fct_scored_transactions"),
        "dim_time_hour AS (SELECT DISTINCT event_hour_utc AS time_hour_utc FROM fct_scored_transactions)",
        "dim_transaction_type AS (SELECT DISTINCT transaction_type_key FROM fct_scored_transactions)"),
    "dq_nonnull": sql([*CURATED, "monitoring"], " UNION ALL ".join([
        nulls("dim_account", "dim_holed", ["account_key", "account_id"]),
        nulls("dim_time_hour", "(SELECT DISTINCT event_hour_utc AS time_hour_utc FROM holed_fct)", ["time_hour_utc"]),
        nulls("dim_transaction_type", "(SELECT DISTINCT transaction_type_key, transaction_type FROM holed_fct "
              "WHERE transaction_type IS NOT NULL)", ["transaction_type_key", "transaction_type"]),
        nulls("fct_scored_transactions", "holed_fct", ["transaction_key"]),
        nulls("fct_fraud_alerts", "(SELECT * FROM holed_fct WHERE is_alert)", ["transaction_key"]),
        nulls("mart_fraud_hourly_kpis", "holed_mart", ["event_hour_utc", "transaction_type"])]),
        "holed AS (SELECT * REPLACE (CASE WHEN event_id % 89 <> 0 THEN type END AS type) FROM curated)",
        fct_cte("holed_fct", "holed"), dim_account_cte("dim_holed", "holed_fct"), mart_cte("holed_mart", "holed_fct")),
    "dq_fk_origin": sql(FCT, missing_fk("dim", "origin_account_key", "account_key"),
                        dim_account_cte("dim", "fct", ("destination",))),
    "dq_fk_destination": sql(FCT, missing_fk("dim", "destination_account_key", "account_key"),
                             dim_account_cte("dim", "fct", ("origin",))),
    "dq_fk_type": sql(FCT, missing_fk("dim", "transaction_type_key", "transaction_type_key"),
                      "dim AS (SELECT DISTINCT transaction_type_key FROM fct WHERE is_fraud_label = 1)"),
    "parity_rowcount": sql([*CURATED, "doubled"], """
SELECT a AS rows_a, b AS rows_b, round(1e-9 + CAST(abs(b - a) AS DOUBLE) / a, 6) AS relative_delta,
       CAST(CAST(abs(b - a) AS DOUBLE) / a <= 0.005 AS VARCHAR) AS within_limit
FROM (SELECT (SELECT count(*) FROM curated) AS a, (SELECT count(*) FROM doubled) AS b)"""),
    "parity_kpi": sql([*MART, "doubled"], f"""
SELECT strftime(coalesce(a.event_hour_utc, b.event_hour_utc), {TS}) AS event_hour_utc,
       coalesce(a.transaction_type, b.transaction_type) AS transaction_type,
       round(1e-9 + a.observed_fraud_rate, 6) AS rate_a, round(1e-9 + b.observed_fraud_rate, 6) AS rate_b,
       round(1e-9 + abs(coalesce(b.observed_fraud_rate, 0) - coalesce(a.observed_fraud_rate, 0)), 6) AS abs_delta,
       CAST(a.transaction_type IS NOT NULL AND b.transaction_type IS NOT NULL
            AND abs(coalesce(b.observed_fraud_rate, 0) - coalesce(a.observed_fraud_rate, 0))
            <= 0.01 * abs(coalesce(a.observed_fraud_rate, 0)) AS VARCHAR) AS within_limit
FROM mart a FULL JOIN other_mart b
  ON a.event_hour_utc = b.event_hour_utc AND a.transaction_type = b.transaction_type""",
        fct_cte("other_fct", "(SELECT * FROM doubled WHERE type <> 'DEBIT')"), mart_cte("other_mart", "other_fct")),
    "schema_contract": sql(FCT, " UNION ALL ".join(contract_line(*line) for line in CONTRACT)),
    "kpi_tiles": sql(FCT, TILES),
    "kpi_filtered": sql(FCT, TILES + """ WHERE event_hour_utc >= TIMESTAMP '2024-01-01 02:00:00'
  AND event_hour_utc <= TIMESTAMP '2024-01-01 09:00:00' AND transaction_type IN ('TRANSFER', 'CASH_OUT')"""),
    "alert_trend": sql(MART, f"""
SELECT strftime(CAST(date_trunc('month', event_hour_utc) AS TIMESTAMP), {TS}) AS event_month, transaction_type,
       CAST(sum(alert_count) AS BIGINT) AS alert_count, CAST(sum(transaction_count) AS BIGINT) AS transaction_count,
       round(1e-9 + CAST(sum(alert_count) AS DOUBLE) / CAST(sum(transaction_count) AS DOUBLE), 6) AS alert_rate
FROM mart GROUP BY date_trunc('month', event_hour_utc), transaction_type"""),
    "volume_vs_alerts": sql(MART, f"""
SELECT strftime(event_hour_utc, {TS}) AS event_hour_utc, CAST(sum(transaction_count) AS BIGINT) AS transaction_count,
       CAST(sum(alert_count) AS BIGINT) AS alert_count, round(1e-9 + avg(alert_rate_recomputed), 6) AS avg_alert_rate,
       round(1e-9 + avg(avg_fraud_score), 6) AS avg_fraud_score, round(1e-9 + max(max_fraud_score), 6) AS max_fraud_score,
       round(1e-9 + avg(p95_fraud_score), 6) AS avg_p95_fraud_score
FROM mart GROUP BY mart.event_hour_utc"""),
    "alerts_by_type": sql([*FCT, "alerts"], """
SELECT transaction_type, count(*) AS alert_count,
       round(1e-9 + CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM alerts), 6) AS share
FROM alerts GROUP BY transaction_type"""),
    "top_risky_accounts": sql([*FCT, "alerts"], top_accounts("origin") + " UNION ALL " + top_accounts("destination")),
    "alert_drill": sql([*FCT, "alerts"], "SELECT " + shown(
        ALERT_COLUMNS + " velocity_5min:f balance_change_ratio:f is_new_merchant:b origin_balance_delta:f "
        "destination_balance_delta:f") + " FROM alerts"),
    "source_offsets": sql(["txn", "scored", "again"], """
SELECT source_topic, source_partition, count(*) AS message_count, min(CAST(source_offset AS BIGINT)) AS min_offset,
       max(CAST(source_offset AS BIGINT)) AS max_offset
FROM again GROUP BY source_topic, source_partition"""),
    "lake_preview": sql(["txn", "scored"], f"""
SELECT {shown(SHOWN)} FROM (SELECT * FROM scored WHERE is_alert ORDER BY event_ts DESC, source_offset LIMIT 20)"""),
    "class_weights": sql(["txn"], """
SELECT f AS fraud_count, n AS nonfraud_count, f + n AS total_count,
       round(1e-9 + (f + n) / (2.0 * f), 6) AS fraud_weight, round(1e-9 + (f + n) / (2.0 * n), 6) AS nonfraud_weight
FROM (SELECT greatest(count(*) FILTER (isFraud = 1), 1) AS f, greatest(count(*) FILTER (isFraud = 0), 1) AS n FROM txn)"""),
    "training_dataset": sql([*CURATED], "SELECT " + shown(SHOWN + " isFraud label_delay_hours:f") + """,
       round(1e-9 + CAST((SELECT count(isFraud) FROM curated) AS DOUBLE) / (2.0 * (CASE WHEN isFraud = 1
         THEN (SELECT greatest(count(*), 1) FROM curated WHERE isFraud = 1)
         ELSE (SELECT greatest(count(*), 1) FROM curated WHERE isFraud = 0) END)), 6) AS class_weight
FROM curated WHERE is_label_available"""),
    "training_join": sql(["txn", "scored", "again", "labels", "unique_labels"], "SELECT " + shown(
        f"{KEYS} {FEATURES} isFraud") + f" FROM (SELECT DISTINCT ON ({KEY_LIST}) * EXCLUDE (isFraud) FROM again "
        f"ORDER BY {KEY_LIST}, velocity_5min, balance_change_ratio) JOIN unique_labels USING ({KEY_LIST})"),
    "dataset_split_md5": sql(["txn"], f"""
SELECT source_offset, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'validation' ELSE 'test' END AS dataset_split
FROM (SELECT source_offset, CAST('0x' || substr({DIGEST}, 1, 8) AS BIGINT) % 100 AS b FROM txn WHERE isFraud IS NOT NULL)"""),
    "train_cap": sql(["txn"], f"""
SELECT {shown(KEYS)}, isFraud FROM (SELECT *, {DIGEST} AS digest FROM txn ORDER BY digest LIMIT 500)"""),
    "refresh_gate": sql(["txn"], " UNION ALL ".join([
        gate("both", "true"), gate("one", "isFraud = 0"), gate("none", "isFraud IS NULL")])),
    "auc_exact": sql(["txn"], " UNION ALL ".join(f"""
SELECT '{tag}' AS scores, p AS positives, n AS negatives, round(1e-9 + (ranks - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n), 6) AS auc
FROM (SELECT count(*) FILTER (isFraud = 1) AS p, count(*) FILTER (isFraud = 0) AS n, sum(r) FILTER (isFraud = 1) AS ranks
      FROM (SELECT isFraud, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
            FROM (SELECT isFraud, {score} AS s FROM txn WHERE isFraud IS NOT NULL)))""" for tag, score in [
                ("as_scored", "fraud_score"), ("coarse", "floor(fraud_score * 4)")])),
    "refresh_job": sql(["txn"], "SELECT g.labels AS attempt, moved, useful, CAST(versions AS BIGINT) AS versions, g.* EXCLUDE (labels) FROM (VALUES "
        "('first', 'true', 'true', 1), ('no_fraud', 'false', 'false', 1), ('again', 'true', 'true', 2), "
        "('too_little_better', 'false', 'true', 3)) v(attempt, moved, useful, versions) JOIN (" + " UNION ALL ".join([
            gate("first", "isFraud IS NOT NULL"), gate("no_fraud", "isFraud = 0"), gate("again", "isFraud IS NOT NULL"),
            gate("too_little_better", "isFraud IS NOT NULL")]) + ") g ON g.labels = v.attempt"),
    "retraining_scan": sql(CURATED, f"SELECT {shown(KEYS)}, isFraud, {shown(FEATURES)} FROM curated WHERE isFraud IS NOT NULL"),
    "envelope_decode": sql(["txn", "raw", "received"], """
SELECT source_topic, source_partition, source_offset, kafka_ingest_ts, CAST(step AS VARCHAR) AS step,
       CASE WHEN event_id % 89 = 0 THEN '' WHEN event_id % 79 = 0 AND type = 'CASH_OUT' THEN 'CASH-OUT' ELSE type END AS type,
       CASE WHEN event_id % 97 <> 0 THEN round(amount + 1e-9, 6) END AS amount, nameOrig, nameDest, event_emitted_at_utc
FROM received"""),
    "envelope_quarantine": sql(["txn"], """
SELECT source_topic, source_partition, source_offset, 40 AS message_length FROM txn WHERE event_id % 71 = 0"""),
    "alert_envelopes": sql(["txn", "scored"], """
SELECT '1.0' AS schema_version,
       md5(concat_ws('|', source_topic, source_partition, source_offset)) AS event_id, 'fraud.alert' AS event_type,
       'tallyward.score_stream' AS source, '2024-02-01T00:00:00.000000+00:00' AS emitted_at_utc, type AS transaction_type, """
        + shown(SILVER.replace(" type ", " ")) + " FROM scored WHERE is_alert"),
    "alert_messages": sql(["txn", "scored"], f"""
SELECT source_offset, subject, {MESSAGE_BODY.format(amount=plain("amount"), score=plain("fraud_score"))} AS body,
       subject AS payload_subject, nameDest AS payload_destination
FROM (SELECT *, '[Fraud Alert] ' || type || ' from ' || nameOrig || ' score=' || printf('%.4f', fraud_score) AS subject
      FROM (SELECT * REPLACE (fraud_score / CAST(1.0007 AS DOUBLE) AS fraud_score) FROM scored WHERE is_alert))"""),
    "lake_read_formats": sql(["txn", "scored"], each_of(shown(LAKE), "scored", "format", ["parquet", "json", "csv"])),
    "load_layouts": sql(CURATED, each_of(
        shown("source_offset type amount:f batch_hour_utc:t"), "curated", "layout", ["by_hour", "nested", "flat"])),
    "load_dispositions": sql(["txn"], each_of(
        shown("source_offset type amount:f"), "txn", "disposition",
        ["WRITE_TRUNCATE", "WRITE_APPEND", "WRITE_APPEND", "WRITE_EMPTY"])),
    "compaction": sql(["txn", "scored"], f"SELECT {shown(LAKE)} FROM scored"),
    "stream_bronze": sql(["txn", "raw", "received"], f"SELECT {shown(BRONZE)} FROM received"),
    "stream_silver": sql(["txn", "raw", "received", "streamed"], f"SELECT {shown(SILVER)} FROM streamed"),
    "stream_alerts": sql(["txn", "raw", "received", "streamed"], f"SELECT {shown(SILVER)} FROM streamed WHERE is_alert"),
    "stream_silver_many_batches": sql(["txn", "raw", "received", "streamed"], f"SELECT {shown(SILVER)} FROM streamed"),
    "stream_alerts_many_batches": sql(
        ["txn", "raw", "received", "streamed"], f"SELECT {shown(SILVER.replace('velocity_5min:f ', ''))} FROM streamed WHERE is_alert"),
    "stream_events_many_batches": sql(["txn", "raw", "received", "streamed"], """
SELECT source_offset, md5(concat_ws('|', source_topic, source_partition, source_offset)) AS event_id, 'true' AS is_alert
FROM streamed WHERE is_alert"""),
    "stream_late_rows": sql(["txn", "raw", "received"], f"""
SELECT source_offset, CASE WHEN held_back AND timed AND ended <= latest - INTERVAL 600 SECOND THEN 'late' ELSE 'silver' END AS written_to
FROM (SELECT *, event_id % 50 = 7 AS held_back, event_id % 83 <> 0 AS timed,
             make_timestamp(CAST((floor(epoch(event_ts) / 300) + 1) * 300000000 AS BIGINT)) AS ended,
             max(event_ts) FILTER (event_id % 50 <> 7 AND event_id % 83 <> 0 AND CAST(substr(kafka_ingest_ts, 12, 2) AS INTEGER) < 9) OVER () AS latest
      FROM received)"""),
    "stream_pull_offsets": sql(["txn"], """
SELECT source_topic AS topic, source_partition AS "partition", source_offset AS "offset", 1 AS times, 'true' AS within_limit FROM txn"""),
    "stream_metrics": sql(["txn"], """
SELECT turn AS ingest_batch_id, count(*) AS input_rows, count(*) FILTER (whole) AS bronze_rows,
       count(*) FILTER (whole AND NOT again) AS silver_rows, count(*) FILTER (NOT whole) AS undecodable_rows,
       CAST(0 AS BIGINT) AS late_rows, count(*) FILTER (whole AND again) AS repeated_rows,
       CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS dropped_rows
FROM (SELECT event_id % 8 AS turn, event_id % 71 <> 0 AS whole, false AS again FROM txn
      UNION ALL SELECT event_id % 8 + 1, event_id % 71 <> 0, true FROM txn WHERE event_id % 20 = 0 AND event_id % 8 < 7)
GROUP BY turn"""),
    "stream_velocity": sql(["txn", "scored"], f"SELECT {shown('source_offset nameOrig event_ts:t velocity_5min:f')} FROM scored"),
    "stream_dedup": sql(["txn"], f"SELECT {shown('source_topic source_partition source_offset event_ts:t amount:f')} FROM txn"),
}
