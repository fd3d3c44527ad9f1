"""Queries for online feature state.

The history is the transaction fixture before ``CUT``; the batch is the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.config import DEFAULT
from txnwatch.operators import history, state, state_tables
from txnwatch.plans.catalog_features import FEAT_SQL, HISTORY_FEATURES
from txnwatch.plans.fixtures import duckdb_with, txn
from txnwatch.plans.registry import r6, register
from txnwatch.sources import files

CUT = "2024-01-16 00:00:00"


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = txn(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp")
    return t.where(F.col("timestamp") < cut), t.where(F.col("timestamp") >= cut)


def stored(spark: SparkSession, hist: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The state of the history as a job finds it: saved to bucketed tables."""
    path = files.scratch_path(spark, "state")
    state_tables.save(state.account_state(hist), state.pair_state(hist), path)
    return state_tables.load(spark, path)


def _state_sql(src: str) -> str:
    return f"""
s AS (SELECT from_account AS account, count(*) AS sent_count, sum(amount_paid) AS sent_total,
             max(timestamp) AS last_sent_ts, count(DISTINCT to_account) AS sent_unique FROM {src} GROUP BY 1),
r AS (SELECT to_account AS account, count(*) AS received_count, sum(amount_paid) AS received_total,
             max(timestamp) AS last_received_ts, count(DISTINCT from_account) AS received_unique FROM {src} GROUP BY 1),
st AS (SELECT coalesce(s.account, r.account) AS account,
         CAST(coalesce(sent_count, 0) AS BIGINT) AS sent_count, CAST(coalesce(received_count, 0) AS BIGINT) AS received_count,
         coalesce(sent_total, 0.0) AS sent_total, coalesce(received_total, 0.0) AS received_total,
         last_sent_ts, last_received_ts,
         CAST(coalesce(sent_unique, 0) AS BIGINT) AS sent_unique, CAST(coalesce(received_unique, 0) AS BIGINT) AS received_unique
       FROM s FULL OUTER JOIN r ON s.account = r.account)
"""


STATE_SELECT = ("SELECT account, sent_count, received_count, round(sent_total, 6) AS sent_total, "
                "round(received_total, 6) AS received_total, last_sent_ts, last_received_ts, "
                "sent_unique, received_unique FROM st")


def _round_state(df: DataFrame) -> DataFrame:
    return df.withColumn("sent_total", r6("sent_total")).withColumn("received_total", r6("received_total"))


@register("account_state", duckdb_with("txn") + "," + _state_sql("txn") + STATE_SELECT)
def q_account_state(spark, sf_dir):
    return _round_state(state.account_state(txn(spark, sf_dir)))


@register("pair_state", duckdb_with("txn") + """
SELECT from_account, to_account, CAST(count(*) AS BIGINT) AS pair_count FROM txn GROUP BY 1, 2""")
def q_pair_state(spark, sf_dir):
    return state.pair_state(txn(spark, sf_dir))


@register("merge_state", duckdb_with("txn") + "," + _state_sql("txn") + STATE_SELECT)
def q_merge_state(spark, sf_dir):
    hist, batch = split(spark, sf_dir)
    acct, _ = state.merge_state(*stored(spark, hist), batch)
    return _round_state(acct)


def _feature_cols(df: DataFrame) -> DataFrame:
    return df.select("seq", *[r6(n) if d else F.col(n) for n, d in HISTORY_FEATURES.items()])


HIST_COLS = ", ".join(f"round({n}, 6) AS {n}" if d else n for n, d in HISTORY_FEATURES.items())


@register("score_features_live", duckdb_with("txn") + "," + FEAT_SQL
          + f"SELECT seq, {HIST_COLS} FROM feat WHERE timestamp >= TIMESTAMP '{CUT}'")
def q_live(spark, sf_dir):
    hist, batch = split(spark, sf_dir)
    f = history.live_features(batch, *stored(spark, hist), DEFAULT.history_rows_per_chunk)
    return _feature_cols(f)


SNAPSHOT_SQL = duckdb_with("txn") + f"""
, hist AS (SELECT * FROM txn WHERE timestamp < TIMESTAMP '{CUT}'),
batch AS (SELECT * FROM txn WHERE timestamp >= TIMESTAMP '{CUT}'),
""" + _state_sql("hist") + """,
p AS (SELECT from_account, to_account, count(*) AS pair_count FROM hist GROUP BY 1, 2),
j AS (
  SELECT b.seq, b.timestamp, b.amount_paid,
         coalesce(ss.sent_count, 0) AS sc, coalesce(ss.sent_total, 0.0) AS st, ss.last_sent_ts AS sl,
         coalesce(ss.sent_unique, 0) AS su,
         coalesce(rr.received_count, 0) AS rc, coalesce(rr.received_total, 0.0) AS rt,
         rr.last_received_ts AS rl, coalesce(rr.received_unique, 0) AS ru,
         coalesce(p.pair_count, 0) AS pc
  FROM batch b LEFT JOIN st ss ON b.from_account = ss.account
               LEFT JOIN st rr ON b.to_account = rr.account
               LEFT JOIN p ON b.from_account = p.from_account AND b.to_account = p.to_account),
k AS (
  SELECT *, coalesce(st / nullif(CAST(sc AS DOUBLE), 0), 0.0) AS sa, coalesce(rt / nullif(CAST(rc AS DOUBLE), 0), 0.0) AS ra FROM j)
SELECT seq,
  CAST(sc AS INTEGER) AS sender_prev_tx_count, CAST(rc AS INTEGER) AS receiver_prev_tx_count,
  round(sa, 6) AS sender_prev_avg_amount, round(ra, 6) AS receiver_prev_avg_amount,
  round(least(coalesce(amount_paid / nullif(sa, 0), 1.0), 1000.0), 6) AS sender_amount_to_avg,
  round(least(coalesce(amount_paid / nullif(ra, 0), 1.0), 1000.0), 6) AS receiver_amount_to_avg,
  round(least(greatest(coalesce((epoch_us(timestamp) - epoch_us(sl)) / 60000000.0, 1000000.0), 0.0), 1000000.0), 6) AS sender_minutes_since_last,
  round(least(greatest(coalesce((epoch_us(timestamp) - epoch_us(rl)) / 60000000.0, 1000000.0), 0.0), 1000000.0), 6) AS receiver_minutes_since_last,
  CAST(pc AS INTEGER) AS pair_prev_count, CAST(su AS INTEGER) AS sender_unique_counterparties,
  CAST(ru AS INTEGER) AS receiver_unique_counterparties
FROM k
"""


@register("score_features_snapshot", SNAPSHOT_SQL)
def q_snapshot(spark, sf_dir):
    hist, batch = split(spark, sf_dir)
    f = history.snapshot_features(batch, *stored(spark, hist))
    return _feature_cols(f)
