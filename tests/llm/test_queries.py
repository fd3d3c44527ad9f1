"""Registered queries on the sf0.001 tables: oracles, and result columns of all."""

import importlib

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from helpers import duck_rows, spark_rows

queries = importlib.import_module("txnwatch.llm.queries")
COLUMNS = {
    "op1": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op2": "doc_id n_shingles component_id kept",
    "op3": "vec_id n_links component_id kept",
    "op4": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op6": "doc_id n_lines n_dropped kept_sha256", "op7": "page_id host path rule verdict",
    "op8": "doc_id size source_size target taken",
    "op9": "doc_id n_words n_hit n_items items_sha256 contaminated", "op10": "doc_id held_out score predicted",
    "op11": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"}


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted(COLUMNS)
    assert set(queries.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got, gcols = spark_rows(entry.queries()[name](spark, SF_SMALL))
    want, wcols = duck_rows(duck, queries.ORACLE[name])
    assert gcols == wcols and got == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_has_a_row_for_each_row(spark, name):
    out = entry.queries()[name](spark, SF_SMALL)
    need = COLUMNS[name.split("_")[0]].split()
    assert out.columns[:len(need)] == need
    table = "embeddings" if name.startswith("op3") else "documents"
    assert out.count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
