"""Substring search through the inverted index equals the scan and reads matching files only."""

import re

import pytest

from conftest import SF_SMALL
from txnwatch.operators import alerts, search_index
from txnwatch.plans.catalog_alerts import flat
from txnwatch.sources.files import scratch_path


@pytest.fixture(scope="module")
def table(spark):
    return flat(spark, SF_SMALL).checkpoint()


@pytest.fixture(scope="module")
def index(spark, table):
    path = scratch_path(spark, "search")
    search_index.build(table, path)
    return path


@pytest.mark.parametrize("text", ["A000001", "a000001", "alt-", "ALT", "tx-1", "x", "", "1", "zzzz", "0000", "-0", "A0000012 ", "%_a", "é"])
def test_search_equals_the_scan(table, index, text):
    want = sorted(r["id"] for r in alerts.alert_search(table, text).collect())
    assert sorted(r["id"] for r in search_index.search(table, index, text).collect()) == want


def test_every_id_is_found(table, index):
    for r in table.orderBy("id").limit(5).collect():
        for text in (r["alert_id"], r["transaction_id"], r["from_account"], r["alert_id"][3:12]):
            assert r["id"] in {x["id"] for x in search_index.search(table, index, text).collect()}


def test_only_matching_posting_files_are_read(spark, index):
    text = "A000001"
    keys = search_index.postings(spark, index, text)
    read = {int(re.search(r"slot=(\d+)", f)[1]) for f in keys.inputFiles()}
    pieces = {text.lower()[i:i + 3] for i in range(len(text) - 2)}
    found = spark.read.parquet(f"{index}/pieces").where(f"piece in ({', '.join(map(repr, sorted(pieces)))})").collect()
    rare = sorted(found, key=lambda r: (r["n"], r["piece"]))[:search_index.PIECES]
    assert read <= {r["slot"] for r in rare}
    every = {int(re.search(r"slot=(\d+)", f)[1]) for f in spark.read.parquet(f"{index}/postings").inputFiles()}
    assert len(read) < len(every)
    assert "piece IN" in keys._jdf.queryExecution().toString() or "In(piece" in keys._jdf.queryExecution().toString()


def test_empty_table(spark, table):
    path = scratch_path(spark, "search")
    search_index.build(table.limit(0), path)
    assert search_index.search(table.limit(0), path, "abc").count() == 0
