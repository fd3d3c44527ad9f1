"""Queries for row features (F1-F9), history features (W1-W12) and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.config import DEFAULT
from txnwatch.functions.reasons import reason_codes
from txnwatch.operators.history import causal_features
from txnwatch.plans.fixtures import RISK_SCORE_SQL, duckdb_with, txn
from txnwatch.plans.registry import r6, register

# DuckDB reference formulation: full-history windows per account, straight
# from the definitions (no chunking).
FEAT_SQL = """
f0 AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY from_account, to_account ORDER BY timestamp, seq) = 1
                 THEN 1 ELSE 0 END AS first_pair
  FROM txn),
f1 AS (
  SELECT *,
    ln(1 + greatest(amount_paid, 0)) AS amount_log1p,
    coalesce(amount_received / greatest(amount_paid, 1e-9), 1.0) AS amount_ratio,
    CAST(hour(timestamp) AS INTEGER) AS hour,
    CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week,
    CAST(isodow(timestamp) >= 6 AS INTEGER) AS is_weekend,
    CAST(hour(timestamp) <= 5 AS INTEGER) AS is_night,
    CAST(from_bank IS DISTINCT FROM to_bank AS INTEGER) AS cross_bank,
    CAST(payment_currency IS DISTINCT FROM receiving_currency AS INTEGER) AS cross_currency,
    CAST(abs(amount_paid % 1000) <= 1.0 AS INTEGER) AS is_round_amount,
    CAST(row_number() OVER (PARTITION BY from_account ORDER BY timestamp, seq) - 1 AS INTEGER) AS sender_prev_tx_count,
    CAST(row_number() OVER (PARTITION BY to_account ORDER BY timestamp, seq) - 1 AS INTEGER) AS receiver_prev_tx_count,
    coalesce(sum(amount_paid) OVER (PARTITION BY from_account ORDER BY timestamp, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS s_sum,
    coalesce(sum(amount_paid) OVER (PARTITION BY to_account ORDER BY timestamp, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS r_sum,
    lag(timestamp) OVER (PARTITION BY from_account ORDER BY timestamp, seq) AS s_prev,
    lag(timestamp) OVER (PARTITION BY to_account ORDER BY timestamp, seq) AS r_prev,
    CAST(row_number() OVER (PARTITION BY from_account, to_account ORDER BY timestamp, seq) - 1 AS INTEGER) AS pair_prev_count,
    CAST(coalesce(sum(first_pair) OVER (PARTITION BY from_account ORDER BY timestamp, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS sender_unique_counterparties,
    CAST(coalesce(sum(first_pair) OVER (PARTITION BY to_account ORDER BY timestamp, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS receiver_unique_counterparties
  FROM f0),
f2 AS (
  SELECT *,
    coalesce(s_sum / nullif(CAST(sender_prev_tx_count AS DOUBLE), 0), 0.0) AS sender_prev_avg_amount,
    coalesce(r_sum / nullif(CAST(receiver_prev_tx_count AS DOUBLE), 0), 0.0) AS receiver_prev_avg_amount,
    least(greatest(coalesce((epoch_us(timestamp) - epoch_us(s_prev)) / 60000000.0, 1000000.0), 0.0), 1000000.0) AS sender_minutes_since_last,
    least(greatest(coalesce((epoch_us(timestamp) - epoch_us(r_prev)) / 60000000.0, 1000000.0), 0.0), 1000000.0) AS receiver_minutes_since_last
  FROM f1),
feat AS (
  SELECT *,
    least(coalesce(amount_paid / nullif(sender_prev_avg_amount, 0), 1.0), 1000.0) AS sender_amount_to_avg,
    least(coalesce(amount_paid / nullif(receiver_prev_avg_amount, 0), 1.0), 1000.0) AS receiver_amount_to_avg
  FROM f2)
"""

# name -> (is double)
ROW_FEATURES = {
    "amount_log1p": True, "amount_ratio": True, "hour": False, "day_of_week": False,
    "is_weekend": False, "is_night": False, "cross_bank": False, "cross_currency": False,
    "is_round_amount": False,
}
HISTORY_FEATURES = {
    "sender_prev_tx_count": False, "receiver_prev_tx_count": False,
    "sender_prev_avg_amount": True, "receiver_prev_avg_amount": True,
    "sender_amount_to_avg": True, "receiver_amount_to_avg": True,
    "sender_minutes_since_last": True, "receiver_minutes_since_last": True,
    "pair_prev_count": False, "sender_unique_counterparties": False,
    "receiver_unique_counterparties": False,
}
ALL_FEATURES = {"amount_paid": True, "amount_received": True, **ROW_FEATURES, **HISTORY_FEATURES}


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return causal_features(txn(spark, sf_dir), DEFAULT.history_rows_per_chunk)


def feature_sql(names: dict[str, bool]) -> str:
    cols = ", ".join(f"round({n}, 6) AS {n}" if d else n for n, d in names.items())
    return duckdb_with("txn") + "," + FEAT_SQL + f"SELECT seq, {cols} FROM feat"


def _feature_query(names: dict[str, bool]):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        f = features(spark, sf_dir)
        return f.select("seq", *[r6(n) if d else F.col(n) for n, d in names.items()])
    return q


for _name, _dbl in {**ROW_FEATURES, **HISTORY_FEATURES}.items():
    register(_name, feature_sql({_name: _dbl}))(_feature_query({_name: _dbl}))

register("causal_features",
         feature_sql({**ALL_FEATURES, "payment_format": False, "payment_currency": False,
                      "receiving_currency": False}))(
    _feature_query({**ALL_FEATURES, "payment_format": False, "payment_currency": False,
                    "receiving_currency": False}))


REASONS_SQL = """
reasons AS (
  SELECT *, list_slice(CASE WHEN len(fired) = 0 AND risk_score >= 0.5 THEN ['MULTIVARIATE_MODEL_PATTERN'] ELSE fired END, 1, 5) AS reason_codes
  FROM (SELECT *, list_filter([
      CASE WHEN sender_amount_to_avg >= 5 THEN 'AMOUNT_ABOVE_SENDER_BASELINE' END,
      CASE WHEN receiver_amount_to_avg >= 5 THEN 'AMOUNT_ABOVE_RECEIVER_BASELINE' END,
      CASE WHEN sender_minutes_since_last <= 10 THEN 'RAPID_REPEAT_SENDER_ACTIVITY' END,
      CASE WHEN cross_currency <> 0 THEN 'CROSS_CURRENCY_TRANSFER' END,
      CASE WHEN is_round_amount <> 0 THEN 'ROUND_AMOUNT_PATTERN' END,
      CASE WHEN sender_prev_tx_count = 0 THEN 'NEW_SENDER' END,
      CASE WHEN payment_format IN ('Cash', 'Wire') THEN 'HIGHER_RISK_PAYMENT_FORMAT' END], lambda x: x IS NOT NULL) AS fired
    FROM (SELECT *, """ + RISK_SCORE_SQL + """ AS risk_score FROM feat)))
"""


def scored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Causal features with the fixture risk score and reason codes."""
    f = features(spark, sf_dir).withColumn("risk_score", F.expr(RISK_SCORE_SQL))
    return f.withColumn("reason_codes", reason_codes())


@register("reason_codes", duckdb_with("txn") + "," + FEAT_SQL + "," + REASONS_SQL
          + "SELECT seq, array_to_string(reason_codes, ',') AS reason_codes, "
            "CAST(len(reason_codes) AS INTEGER) AS n_reasons FROM reasons")
def q_reason_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = scored_features(spark, sf_dir)
    return f.select("seq", F.array_join("reason_codes", ",").alias("reason_codes"),
                    F.size("reason_codes").alias("n_reasons"))


TOP_REASON_ACCOUNTS_SQL = (
    duckdb_with("txn") + "," + FEAT_SQL + "," + REASONS_SQL + """
SELECT from_account, CAST(sum(len(reason_codes)) AS BIGINT) AS reason_count,
       CAST(count(*) AS BIGINT) AS transactions,
       round(max(risk_score), 6) AS max_risk_score
FROM reasons GROUP BY from_account
ORDER BY reason_count DESC, from_account LIMIT 20""")


def top_reason_accounts(f: DataFrame, k: int = 20) -> DataFrame:
    """Flagship: accounts whose transactions fire the most reason codes (top-k report)."""
    agg = f.groupBy("from_account").agg(
        F.sum(F.size("reason_codes")).cast("long").alias("reason_count"),
        F.count(F.lit(1)).alias("transactions"),
        F.round(F.max("risk_score"), 6).alias("max_risk_score"),
    )
    return agg.orderBy(F.col("reason_count").desc(), F.col("from_account")).limit(k)


@register("top_reason_accounts", TOP_REASON_ACCOUNTS_SQL)
def q_top_reason_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_reason_accounts(scored_features(spark, sf_dir))
