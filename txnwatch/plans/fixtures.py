"""Fixture tables derived from the driver tables.

Each fixture is one SQL text.  Spark runs it through ``spark.sql`` with the
input DataFrames passed as arguments; the DuckDB oracle inlines the same text
as a CTE, so both engines read identical rows.  Literal braces are doubled
(format-string escaping) and inputs are ``{name}`` placeholders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# name -> (sql text, input names)
FIXTURE_SQL: dict[str, tuple[str, tuple[str, ...]]] = {}

FIXTURE_SQL["txn"] = ("""
SELECT event_id AS seq,
       'tx-' || CAST(event_id AS STRING) AS transaction_id,
       date_trunc('minute', ts) AS timestamp,
       'B' || lpad(CAST(user_id % 30 AS STRING), 3, '0') AS from_bank,
       'A' || lpad(CAST(user_id AS STRING), 7, '0') AS from_account,
       'B' || lpad(CAST(k % 30 AS STRING), 3, '0') AS to_bank,
       'A' || lpad(CAST(k AS STRING), 7, '0') AS to_account,
       CASE WHEN event_id % 12 = 0 THEN amt * CAST(0.75 AS DOUBLE) ELSE amt END AS amount_received,
       CASE WHEN event_id % 12 = 0 THEN 'CHF' WHEN user_id % 3 = 0 THEN 'EUR' ELSE 'USD' END AS receiving_currency,
       amt AS amount_paid,
       CASE WHEN user_id % 3 = 0 THEN 'EUR' ELSE 'USD' END AS payment_currency,
       CASE event_type WHEN 'signup' THEN 'ACH' WHEN 'error' THEN 'Wire' WHEN 'click' THEN 'Cheque'
            WHEN 'view' THEN 'Credit Card' ELSE 'Cash' END AS payment_format,
       CASE WHEN event_id % 50 = 0 AND event_type IN ('error','purchase') THEN 1
            WHEN user_id % 15 = 7 AND value > 80 THEN 1 ELSE 0 END AS is_laundering
FROM (SELECT event_id, ts, user_id, event_type, value,
             CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
             CASE WHEN event_id % 50 = 0 THEN CAST(1000 * (1 + event_id % 9) AS DOUBLE)
                  ELSE CAST(round(value * 100) AS DOUBLE) END AS amt
      FROM {events})
""", ("events",))

FIXTURE_SQL["raw_txn"] = ("""
SELECT event_id AS seq,
       CASE WHEN event_id % 101 = 5 THEN 'not-a-date' ELSE replace(substr(CAST(timestamp AS STRING), 1, 16), '-', '/') END AS `Timestamp`,
       from_bank AS `From Bank`,
       CASE WHEN event_id % 107 = 3 THEN NULL ELSE from_account END AS `Account`,
       to_bank AS `To Bank`, to_account AS `Account.1`,
       CASE WHEN event_id % 109 = 2 THEN 'abc' ELSE CAST(amount_received AS STRING) END AS `Amount Received`,
       receiving_currency AS `Receiving Currency`,
       CASE WHEN event_id % 103 = 4 THEN '-10' ELSE CAST(amount_paid AS STRING) END AS `Amount Paid`,
       CASE WHEN event_id % 127 = 1 THEN NULL ELSE payment_currency END AS `Payment Currency`,
       payment_format AS `Payment Format`,
       CASE WHEN event_id % 113 = 6 THEN NULL ELSE CAST(is_laundering AS STRING) END AS `Is Laundering`
FROM (SELECT seq AS event_id, timestamp, from_bank, from_account, to_bank, to_account, amount_received,
             receiving_currency, amount_paid, payment_currency, payment_format, is_laundering FROM {txn}
      UNION ALL
      SELECT seq, timestamp, from_bank, from_account, to_bank, to_account, amount_received,
             receiving_currency, amount_paid, payment_currency, payment_format, is_laundering FROM {txn} WHERE seq % 97 = 0)
""", ("txn",))

# Label-correlated fixture score, so evaluation needs no model.
RISK_SCORE_SQL = """CAST(CASE WHEN is_laundering = 1 THEN 400 + ((seq * 7919) % 1000) % 600
                 ELSE ((seq * 7919) % 1000) % 700 END AS DOUBLE) / CAST(1000 AS DOUBLE)"""

FIXTURE_SQL["scored"] = ("""
SELECT seq, transaction_id, timestamp, from_bank, from_account, to_bank, to_account, amount_paid,
       payment_currency, payment_format, is_laundering,
       """ + RISK_SCORE_SQL + """ AS risk_score
FROM {txn}
""", ("txn",))

FIXTURE_SQL["alerts"] = ("""
SELECT seq AS id, 'ALT-' || substr(md5('v1|' || transaction_id), 1, 16) AS alert_id, transaction_id,
       timestamp AS created_at, risk_score, CAST(0.65 AS DOUBLE) AS threshold, TRUE AS decision, 'v1' AS model_version,
       CASE WHEN seq % 3 = 0 THEN '["NEW_SENDER","ROUND_AMOUNT_PATTERN"]' WHEN seq % 3 = 1 THEN '["CROSS_CURRENCY_TRANSFER"]' ELSE '[]' END AS reason_codes,
       '{{"from_bank":"' || from_bank || '","from_account":"' || from_account || '","to_account":"' || to_account
         || '","amount_paid":' || CAST(amount_paid AS STRING) || ',"payment_format":"' || payment_format || '"}}' AS payload,
       CASE WHEN seq % 5 = 0 THEN 'false_positive' WHEN seq % 5 = 1 THEN 'confirmed_laundering' WHEN seq % 5 = 2 THEN 'needs_review' ELSE NULL END AS analyst_outcome,
       CAST(NULL AS STRING) AS analyst_notes
FROM {scored} WHERE risk_score >= CAST(0.65 AS DOUBLE)
""", ("scored",))

FIXTURE_SQL["txn_orders"] = ("""
SELECT o_orderkey AS seq, 'ord-' || CAST(o_orderkey AS STRING) AS transaction_id, CAST(o_orderdate AS TIMESTAMP) AS timestamp,
       'B' || lpad(CAST(o_custkey % 30 AS STRING), 3, '0') AS from_bank,
       'A' || lpad(CAST(o_custkey AS STRING), 7, '0') AS from_account,
       'B' || lpad(CAST(((o_orderkey * 7919) % 1000) % 30 AS STRING), 3, '0') AS to_bank,
       'A' || lpad(CAST((o_orderkey * 7919) % 1000 AS STRING), 7, '0') AS to_account,
       CAST(round(o_totalprice) AS DOUBLE) AS amount_received, 'USD' AS receiving_currency,
       CAST(round(o_totalprice) AS DOUBLE) AS amount_paid,
       CASE WHEN o_orderkey % 10 = 0 THEN 'EUR' ELSE 'USD' END AS payment_currency,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Wire' WHEN '2-HIGH' THEN 'Cash' WHEN '3-MEDIUM' THEN 'ACH' WHEN '5-LOW' THEN 'Cheque' ELSE 'Credit Card' END AS payment_format,
       CASE WHEN o_orderkey % 40 = 0 THEN 1 ELSE 0 END AS is_laundering
FROM {orders}
""", ("orders",))

# Analyst feedback log: every reviewed alert once, a second (later) verdict for
# some of them, and feedback naming alerts that do not exist.
FIXTURE_SQL["feedback"] = ("""
SELECT alert_id, analyst_outcome AS outcome, CAST(NULL AS STRING) AS notes, id AS submitted_seq
FROM {alerts} WHERE analyst_outcome IS NOT NULL
UNION ALL
SELECT alert_id, 'needs_review' AS outcome, 'second look' AS notes, id + 1000000000 AS submitted_seq
FROM {alerts} WHERE analyst_outcome IS NOT NULL AND id % 7 = 0
UNION ALL
SELECT 'ALT-missing-' || CAST(id AS STRING) AS alert_id, 'false_positive' AS outcome, 'unknown id' AS notes,
       id + 2000000000 AS submitted_seq
FROM {alerts} WHERE id % 11 = 0
""", ("alerts",))

# Score requests: transactions without the label, with each validation rule
# broken on some rows and lower-case currencies on others (accepted).
FIXTURE_SQL["requests"] = ("""
SELECT seq,
       CASE WHEN seq % 211 = 1 THEN '' ELSE transaction_id END AS transaction_id,
       CASE WHEN seq % 239 = 6 THEN 'bad-time' ELSE CAST(timestamp AS STRING) END AS timestamp,
       CASE WHEN seq % 223 = 2 THEN repeat('B', 65) ELSE from_bank END AS from_bank,
       from_account,
       to_bank,
       CASE WHEN seq % 227 = 3 THEN '' ELSE to_account END AS to_account,
       amount_received,
       CASE WHEN seq % 229 = 4 THEN 'US' WHEN seq % 5 = 0 THEN lower(receiving_currency) ELSE receiving_currency END AS receiving_currency,
       CASE WHEN seq % 233 = 5 THEN CAST(-1 AS DOUBLE) WHEN seq % 251 = 8 THEN CAST('NaN' AS DOUBLE) ELSE amount_paid END AS amount_paid,
       CASE WHEN seq % 5 = 1 THEN lower(payment_currency) ELSE payment_currency END AS payment_currency,
       CASE WHEN seq % 241 = 7 THEN '' ELSE payment_format END AS payment_format
FROM {txn}
""", ("txn",))

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Base transaction fixtures are derived with string functions from one raw
# file each; they are written once per query as a table in the shared
# checkpoint folder (spread over the shuffle partitions), the way a cleaned
# transaction table would be stored, so every branch of a plan reads it
# instead of re-deriving it.
MATERIALIZED = {"txn", "txn_orders"}


def fixture(spark: SparkSession, sf_dir: str, name: str, _memo: dict | None = None) -> DataFrame:
    """Build fixture ``name`` (and the fixtures it reads) as a DataFrame."""
    memo = {} if _memo is None else _memo
    if name in memo:
        return memo[name]
    if name in DRIVER_TABLES:
        df = driver_table(spark, sf_dir, name)
    else:
        sql, inputs = FIXTURE_SQL[name]
        args = {i: fixture(spark, sf_dir, i, memo) for i in inputs}
        df = spark.sql(sql, **args)
        if name in MATERIALIZED:
            from txnwatch.session import ensure_checkpoint_dir
            ensure_checkpoint_dir(spark)
            df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "seq").checkpoint()
    memo[name] = df
    return df


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "txn")


def _deps(name: str, out: list[str]) -> None:
    if name in DRIVER_TABLES or name in out:
        return
    for i in FIXTURE_SQL[name][1]:
        _deps(i, out)
    out.append(name)


def duckdb_with(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for DuckDB, dependencies first."""
    order: list[str] = []
    for n in names:
        _deps(n, order)
    parts = []
    for n in order:
        sql, inputs = FIXTURE_SQL[n]
        text = sql.format(**{i: i for i in inputs}).replace("`", '"')
        parts.append(f"{n} AS ({text})")
    return "WITH " + ",\n".join(parts) + "\n"
