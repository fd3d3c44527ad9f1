"""Paths that only large tables take, made to run on small ones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from txnwatch.operators import history, model
from txnwatch.plans.fixtures import txn
from txnwatch.sources import files, jdbc
from txnwatch.streaming import replay as rp

FEATURES = ["seq", "sender_prev_tx_count", "receiver_prev_tx_count", "pair_prev_count", "sender_unique_counterparties",
            "receiver_unique_counterparties", "sender_minutes_since_last", "receiver_minutes_since_last"]


def rows_of(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_a_time_of_very_many_rows_is_split(spark):
    """One timestamp holds ten times rows_per_chunk rows, among ordinary ones."""
    t = txn(spark, SF_SMALL).where("seq < 900")
    burst = F.lit(dt.datetime(2024, 1, 10, 12, 0)).cast("timestamp")
    one = t.withColumn("timestamp", F.when(F.col("seq") % 9 < 6, burst).otherwise(F.col("timestamp"))).checkpoint()
    bounds = history.chunk_bounds(one, 60)
    sizes = [r["count"] for r in history.with_chunk(one, bounds).groupBy(history.CHUNK).count().collect()]
    assert sum(sizes) == 900 and max(sizes) <= 90 and any(cuts for _, cuts in bounds)
    assert rows_of(history.causal_features(one, 60), FEATURES) == rows_of(history.causal_features(one, 10 ** 9), FEATURES)


def test_chunks_follow_time_and_seq(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i // 100 if i < 300 or i >= 800 else 3)) for i in range(1000)]
    df = spark.createDataFrame([*rows, (1000, None)], "seq long, timestamp timestamp")
    out = history.with_chunk(df, history.chunk_bounds(df, 50)).where("timestamp is not null").orderBy("timestamp", "seq").collect()
    chunks = [r[history.CHUNK] for r in out]
    assert chunks == sorted(chunks) and max(chunks.count(c) for c in set(chunks)) <= 110


def test_very_many_categories(spark, tmp_path):
    values = spark.range(100_000).select(F.format_string("v%06d", F.col("id") * 7 % 100_000).alias("payment_format"))
    found = model.fit_categories(values, "payment_format", None)
    assert isinstance(found, str)
    rows = spark.createDataFrame([("v000000",), ("v099999",), ("v000123",), ("new",), (None,)], "payment_format string")
    out = model.ordinal_encode(rows, "payment_format", found, "v000007", "code").collect()
    assert {(r["payment_format"], r["code"]) for r in out} == {("v000000", 0.0), ("v099999", 99_999.0), ("v000123", 123.0),
                                                              ("new", -1.0), (None, 7.0)}
    few = values.limit(50)
    assert rows_of(model.ordinal_encode(few, "payment_format", model.fit_categories(few, "payment_format", None), None, "code"), ["code"]) == \
        rows_of(model.ordinal_encode(few, "payment_format", model.fit_categories(few, "payment_format", None, literal=0), None, "code"), ["code"])


def test_files_are_numbered_without_the_driver(spark, monkeypatch):
    path = files.scratch_path(spark, "many files")
    spark.range(300).selectExpr("id", "'x' as pad").repartitionByRange(6, "id").sortWithinPartitions("id").write.option(
        "header", True).csv(path)
    monkeypatch.setattr(type(spark.range(1)), "inputFiles", None)
    df = files.scan_csv(spark, path)
    assert [int(r["id"]) for r in sorted(df.collect(), key=lambda r: r["seq"])] == list(range(300))
    monkeypatch.setattr(files, "TOP_ROWS", 10)
    for n in (5, 10, 11, 299, 300, 1000):
        assert sorted(int(r["id"]) for r in files.scan_csv(spark, path, max_rows=n).collect()) == list(range(min(n, 300)))


def test_database_alerts_stay_unique(spark):
    schema = "id long, alert_id string, risk_score double"
    first = spark.createDataFrame([(i, f"a{i}", 0.5) for i in range(40)], schema)
    url = jdbc.write_alerts_jdbc(first, files.scratch_path(spark, "derby"))
    more = spark.createDataFrame([(100 + i, f"a{i % 30 + 20}", 0.6) for i in range(60)], schema)
    for _ in range(2):
        jdbc.append_alerts_jdbc(spark, more, url)
    got = jdbc.read_alerts_jdbc(spark, url, rows_per_partition=9)
    assert got.rdd.getNumPartitions() == 6
    assert rows_of(got, ["alert_id", "id"]) == sorted([(f"a{i}", i) for i in range(40)] + [(f"a{i}", 100 + i - 20) for i in range(40, 50)])
    assert jdbc.read_alerts_jdbc(spark, url).rdd.getNumPartitions() == 1


def test_messages_are_numbered_by_the_order_column_only(spark):
    t = txn(spark, SF_SMALL).limit(200)
    got = rp.encode_transactions(t)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    keys = [r["key"] for r in got.orderBy("row_index").collect()]
    assert keys == [f"stream-{i}" for i in range(200)]
