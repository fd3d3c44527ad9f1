"""Batch W12 = live T4 at any cut; plan shape of the feature job."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from txnwatch.operators import history, state
from txnwatch.operators.ordinal import with_ordinal
from txnwatch.plans.fixtures import txn
from txnwatch.streaming import replay as rp


@pytest.mark.parametrize("frac", [0.0, 0.001, 0.5, 0.999])
def test_live_features_equal_batch_at_any_cut(spark, frac):
    t = with_ordinal(txn(spark, SF_SMALL), ["timestamp", "seq"], "_o").checkpoint()
    n = t.count()
    cut = int(n * frac)
    hist, batch = t.where(F.col("_o") < cut).drop("_o"), t.where(F.col("_o") >= cut).drop("_o")
    full = history.causal_features(t.drop("_o"))
    live = history.live_features(batch, state.account_state(hist), state.pair_state(hist))
    cols = ["seq", "sender_prev_tx_count", "receiver_prev_tx_count", "pair_prev_count",
            "sender_unique_counterparties", "receiver_unique_counterparties", "sender_minutes_since_last"]
    want = sorted(map(tuple, full.join(batch.select("seq"), "seq").select(*cols).collect()))
    got = sorted(map(tuple, live.select(*cols).collect()))
    assert got == want


@pytest.mark.parametrize("rows_per_chunk,sender_side,receiver_side", [(10**9, 1, 1), (100, 3, 2)])
def test_feature_plan_shuffles_rows_twice(spark, rows_per_chunk, sender_side, receiver_side):
    """Rows are shuffled once per side.  With several chunks the carry rows (pair and
    sender, receiver) are dealt the same way for the unions; with one there are none."""
    f = history.causal_features(txn(spark, SF_SMALL), rows_per_chunk)
    plan = f._jdf.queryExecution().executedPlan().toString()
    sender = re.findall(r"Exchange hashpartitioning\(from_account#\d+, (?:_chunk#\d+L|0), \d+\), REPARTITION_BY_COL", plan)
    receiver = re.findall(r"Exchange hashpartitioning\(to_account#\d+, (?:_chunk#\d+L|0), \d+\), REPARTITION_BY_COL", plan)
    assert (len(sender), len(receiver)) == (sender_side, receiver_side)
    assert "SinglePartition" not in plan
    if sender_side == 1:
        assert plan.count("Exchange ") == 2
    others = re.findall(r"Exchange (\w+)", plan)
    assert set(others) <= {"hashpartitioning", "HashedRelationBroadcastMode"}


def test_many_chunks_equal_one(spark):
    t = txn(spark, SF_SMALL)
    cols = ["seq", "sender_prev_tx_count", "receiver_prev_tx_count", "pair_prev_count", "sender_unique_counterparties",
            "receiver_unique_counterparties", "sender_minutes_since_last", "receiver_minutes_since_last"]
    one = sorted(map(tuple, history.causal_features(t).select(*cols).collect()))
    many = sorted(map(tuple, history.causal_features(t, 90).select(*cols).collect()))
    assert one == many


def test_parquet_scan_prunes_columns(spark):
    from txnwatch.plans.fixtures import FIXTURE_SQL, driver_table
    raw_txn = spark.sql(FIXTURE_SQL["txn"][0], events=driver_table(spark, SF_SMALL, "events"))
    f = raw_txn.select("seq", "amount_paid")
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_corrupt_stream_lines(spark):
    msgs = spark.createDataFrame([("stream-0", "not json"), ("stream-1", "{}"),
                                  ("stream-2", '{"transaction_id":"x","amount_paid":"abc"}')], "key string, value string")
    d = {r["seq"]: r for r in rp.decode_transactions(msgs).collect()}
    assert d[0]["_corrupt_record"] == "not json"
    assert d[1]["_corrupt_record"] is None and d[1]["transaction_id"] is None
    assert d[2]["_corrupt_record"] is not None


@pytest.mark.parametrize("frac", [0.25, 0.75])
def test_snapshot_on_next_row_equals_batch(spark, frac):
    """T3 against the state of all earlier rows, applied to the next row,
    equals the batch features of that row."""
    t = with_ordinal(txn(spark, SF_SMALL), ["timestamp", "seq"], "_o").checkpoint()
    k = int(t.count() * frac)
    hist, nxt = t.where(F.col("_o") < k).drop("_o"), t.where(F.col("_o") == k).drop("_o")
    snap = history.snapshot_features(nxt, state.account_state(hist), state.pair_state(hist))
    full = history.causal_features(t.drop("_o")).join(nxt.select("seq"), "seq")
    cols = ["seq", "sender_prev_tx_count", "receiver_prev_tx_count", "sender_prev_avg_amount",
            "receiver_prev_avg_amount", "sender_minutes_since_last", "receiver_minutes_since_last",
            "pair_prev_count", "sender_unique_counterparties", "receiver_unique_counterparties"]
    got = [tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in snap.select(*cols).collect()]
    want = [tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in full.select(*cols).collect()]
    assert got == want and len(got) == 1


def test_file_order_over_files_and_splits(spark):
    """seq is unique and in file order for CSV files of several splits and for Parquet."""
    from txnwatch.sources.files import scan_csv, scan_parquet, scratch_path
    path = scratch_path(spark, "ordered files")
    rows = spark.range(3000).selectExpr("id", "repeat('x', cast(id % 50 as int)) as pad")
    rows.repartitionByRange(3, "id").sortWithinPartitions("id").write.option("header", True).csv(path + "/csv")
    rows.repartitionByRange(3, "id").sortWithinPartitions("id").write.parquet(path + "/pq")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        csv = scan_csv(spark, path + "/csv")
        assert csv.rdd.getNumPartitions() > 5
        for df in (csv, scan_parquet(spark, path + "/pq")):
            got = [int(r["id"]) for r in sorted(df.collect(), key=lambda r: r["seq"])]
            assert got == list(range(3000)) and df.select("seq").distinct().count() == 3000
        assert [int(r["id"]) for r in scan_csv(spark, path + "/csv", max_rows=10).collect()] == list(range(10))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_reports_and_limits(spark):
    from txnwatch.operators.alerts import load_alerts, recent_alerts
    from txnwatch.sources.files import scan_report_json, scratch_path
    path = scratch_path(spark, "bad")
    spark.createDataFrame([("{not json",)], "value string").write.text(path)
    schema = spark.createDataFrame([], "rows long").schema
    assert scan_report_json(spark, path, schema) is None and scan_report_json(spark, path) is None
    table = spark.createDataFrame([], "alert_id string, created_at timestamp")
    for call in (lambda: recent_alerts(table, 501), lambda: load_alerts(table, 0), lambda: load_alerts(table, 50_001)):
        with pytest.raises(ValueError):
            call()
