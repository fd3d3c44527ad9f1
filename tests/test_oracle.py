"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from helpers import duck_rows, spark_rows

def general(entries):
    """Without the training-data operators, which have their own tests."""
    return {k: v for k, v in entries.items() if not re.match(r"op\d+_|pipeline$", k)}


ORACLE = general(entry.oracle_sql())
QUERIES = general(entry.queries())


def test_every_query_has_an_oracle_or_a_reason():
    rows_only = {"train_gbt", "predict_score"}
    assert set(QUERIES) - set(ORACLE) == rows_only


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got, gcols = spark_rows(QUERIES[name](spark, SF_SMALL))
    want, wcols = duck_rows(duck, ORACLE[name])
    assert gcols == wcols
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["from_account", "reason_count", "transactions", "max_risk_score"]
