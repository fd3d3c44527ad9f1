"""Queries for the contract (C1-C14) and file sources / sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch import jobs
from txnwatch.operators import contract as ct
from txnwatch.operators.ordinal import with_ordinal
from txnwatch.plans.fixtures import duckdb_with, fixture
from txnwatch.plans.registry import r6, register
from txnwatch.schema import CANONICAL_COLUMNS, TXN_SCHEMA
from txnwatch.sources import files

RAW_COLS = {
    "timestamp": '"Timestamp"', "from_bank": '"From Bank"', "from_account": '"Account"',
    "to_bank": '"To Bank"', "to_account": '"Account.1"', "amount_received": '"Amount Received"',
    "receiving_currency": '"Receiving Currency"', "amount_paid": '"Amount Paid"',
    "payment_currency": '"Payment Currency"', "payment_format": '"Payment Format"',
    "is_laundering": '"Is Laundering"',
}
NORMALIZED_SQL = "SELECT seq, " + ", ".join(f"{v} AS {k}" for k, v in RAW_COLS.items()) + " FROM raw_txn"


def _dbl(x: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END"


TYPED_SQL = f"""
typed AS (
  SELECT seq,
    coalesce(try_strptime("Timestamp", '%Y/%m/%d %H:%M'), TRY_CAST("Timestamp" AS TIMESTAMP)) AS timestamp,
    CAST("From Bank" AS VARCHAR) AS from_bank, CAST("Account" AS VARCHAR) AS from_account,
    CAST("To Bank" AS VARCHAR) AS to_bank, CAST("Account.1" AS VARCHAR) AS to_account,
    {_dbl('"Amount Received"')} AS amount_received,
    coalesce("Receiving Currency", 'UNKNOWN') AS receiving_currency,
    {_dbl('"Amount Paid"')} AS amount_paid,
    coalesce("Payment Currency", 'UNKNOWN') AS payment_currency,
    coalesce("Payment Format", 'UNKNOWN') AS payment_format,
    coalesce(CAST(trunc({_dbl('"Is Laundering"')}) AS INTEGER), 0) AS is_laundering
  FROM raw_txn),
valid AS (
  SELECT * FROM typed
  WHERE timestamp IS NOT NULL AND from_account IS NOT NULL AND to_account IS NOT NULL
    AND amount_paid IS NOT NULL AND amount_received IS NOT NULL AND amount_paid >= 0 AND amount_received >= 0),
cleaned AS (
  SELECT min(seq) AS seq, {", ".join(CANONICAL_COLUMNS)} FROM valid GROUP BY ALL)
"""
CANON = ", ".join(CANONICAL_COLUMNS)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "raw_txn")


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.coerce_types(raw(spark, sf_dir))


@register("normalize_columns", duckdb_with("raw_txn") + NORMALIZED_SQL)
def q_normalize(spark, sf_dir):
    return ct.normalize_columns(raw(spark, sf_dir))


@register("coerce_timestamp", duckdb_with("raw_txn") + "," + TYPED_SQL + "SELECT seq, timestamp FROM typed")
def q_coerce_timestamp(spark, sf_dir):
    return typed(spark, sf_dir).select("seq", "timestamp")


@register("coerce_amounts", duckdb_with("raw_txn") + "," + TYPED_SQL
          + "SELECT seq, amount_received, amount_paid FROM typed")
def q_coerce_amounts(spark, sf_dir):
    return typed(spark, sf_dir).select("seq", "amount_received", "amount_paid")


@register("coerce_identifiers", duckdb_with("raw_txn") + "," + TYPED_SQL
          + "SELECT seq, from_bank, from_account, to_bank, to_account FROM typed")
def q_coerce_identifiers(spark, sf_dir):
    return typed(spark, sf_dir).select("seq", *ct.IDENTIFIERS)


@register("fill_categories", duckdb_with("raw_txn") + "," + TYPED_SQL
          + "SELECT seq, receiving_currency, payment_currency, payment_format FROM typed")
def q_fill_categories(spark, sf_dir):
    return typed(spark, sf_dir).select("seq", *ct.CATEGORIES)


@register("coerce_label", duckdb_with("raw_txn") + "," + TYPED_SQL + "SELECT seq, is_laundering FROM typed")
def q_coerce_label(spark, sf_dir):
    return typed(spark, sf_dir).select("seq", "is_laundering")


QUALITY_SQL = duckdb_with("raw_txn") + "," + TYPED_SQL + f"""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows,
       CAST(coalesce(sum(ts), 0) AS BIGINT) AS invalid_timestamps, CAST(coalesce(sum(neg), 0) AS BIGINT) AS negative_amounts,
       CAST(coalesce(sum(acct), 0) AS BIGINT) AS missing_accounts,
       round(coalesce(sum(lab) / nullif(sum(n), 0), 0.0), 6) AS label_rate
FROM (SELECT {CANON}, count(*) AS n, count_if(timestamp IS NULL) AS ts,
             count_if(coalesce(amount_paid < 0 OR amount_received < 0, false)) AS neg,
             count_if(from_account IS NULL OR to_account IS NULL) AS acct, sum(is_laundering) AS lab
      FROM typed GROUP BY ALL)
"""


@register("quality_report", QUALITY_SQL)
def q_quality_report(spark, sf_dir):
    r = ct.quality_report(typed(spark, sf_dir))
    return r.withColumn("label_rate", r6("label_rate"))


@register("drop_invalid", duckdb_with("raw_txn") + "," + TYPED_SQL + f"SELECT seq, {CANON} FROM valid")
def q_drop_invalid(spark, sf_dir):
    return ct.drop_invalid(typed(spark, sf_dir))


@register("dedupe", duckdb_with("raw_txn") + "," + TYPED_SQL
          + f"SELECT min(seq) AS seq, {CANON} FROM typed GROUP BY ALL")
def q_dedupe(spark, sf_dir):
    # dedupe alone over the typed rows: nulls compare equal
    return ct.dedupe(typed(spark, sf_dir))


@register("clean", duckdb_with("raw_txn") + "," + TYPED_SQL + f"SELECT seq, {CANON} FROM cleaned")
def q_clean(spark, sf_dir):
    cleaned, _ = ct.clean(raw(spark, sf_dir))
    return cleaned


@register("order_by_time", duckdb_with("raw_txn") + "," + TYPED_SQL
          + "SELECT seq, row_number() OVER (ORDER BY timestamp, seq) - 1 AS row_index FROM cleaned")
def q_order_by_time(spark, sf_dir):
    """Stable time order of the cleaned table, shown as each row's position."""
    from txnwatch.operators.ordinal import with_ordinal
    cleaned, _ = ct.clean(raw(spark, sf_dir))
    ordered = ct.order_by_time(cleaned)
    return with_ordinal(ordered, ["timestamp", "seq"], "row_index").select("seq", "row_index")


def _rule(col: str, lo: int, hi: int) -> str:
    return (f"CASE WHEN {col} IS NULL OR length({col}) < {lo} OR length({col}) > {hi} "
            f"THEN '{col}:length_{lo}_{hi}' END")


REQUEST_ERRORS_SQL = "list_filter([" + ", ".join([
    _rule("transaction_id", 1, 128),
    "CASE WHEN TRY_CAST(timestamp AS TIMESTAMP) IS NULL THEN 'timestamp:invalid' END",
    _rule("from_bank", 1, 64), _rule("from_account", 1, 128),
    _rule("to_bank", 1, 64), _rule("to_account", 1, 128),
    "CASE WHEN amount_received IS NULL OR isnan(amount_received) OR amount_received < 0 THEN 'amount_received:ge_0' END",
    _rule("receiving_currency", 3, 64),
    "CASE WHEN amount_paid IS NULL OR isnan(amount_paid) OR amount_paid < 0 THEN 'amount_paid:ge_0' END",
    _rule("payment_currency", 3, 64), _rule("payment_format", 1, 64),
]) + "], lambda x: x IS NOT NULL)"


@register("validate_requests", duckdb_with("requests") + f"""
SELECT seq, array_to_string(e, ',') AS errors, len(e) = 0 AS valid
FROM (SELECT seq, {REQUEST_ERRORS_SQL} AS e FROM requests)""")
def q_validate_requests(spark, sf_dir):
    v = ct.validate_requests(fixture(spark, sf_dir, "requests"))
    return v.select("seq", F.array_join("errors", ",").alias("errors"), "valid")


@register("upper_currency", duckdb_with("requests") + f"""
SELECT seq, upper(receiving_currency) AS receiving_currency, upper(payment_currency) AS payment_currency
FROM requests WHERE len({REQUEST_ERRORS_SQL}) = 0""")
def q_upper_currency(spark, sf_dir):
    v = ct.validate_requests(fixture(spark, sf_dir, "requests")).where("valid")
    return ct.upper_currency(v).select("seq", "receiving_currency", "payment_currency")


@register("validate_feedback", duckdb_with("feedback") + """
SELECT alert_id, submitted_seq, array_to_string(e, ',') AS errors, len(e) = 0 AS valid
FROM (SELECT alert_id, submitted_seq, list_filter([
        CASE WHEN outcome IS NULL OR outcome NOT IN ('confirmed_laundering', 'false_positive', 'needs_review') THEN 'outcome:invalid' END,
        CASE WHEN notes IS NOT NULL AND length(notes) > 2000 THEN 'notes:too_long' END], lambda x: x IS NOT NULL) AS e
      FROM feedback)""")
def q_validate_feedback(spark, sf_dir):
    v = ct.validate_feedback(fixture(spark, sf_dir, "feedback"))
    return v.select("alert_id", "submitted_seq", F.array_join("errors", ",").alias("errors"), "valid")


# ---- sources and sinks: write with the sink, read back with the source ----

IN_FILE_ORDER = "SELECT row_number() OVER (ORDER BY seq) - 1 AS position, * EXCLUDE (seq) FROM "


def _in_parts(df: DataFrame) -> DataFrame:
    """The rows in several files whose names have the order of seq."""
    return df.repartitionByRange(5, "seq").sortWithinPartitions("seq").drop("seq")


def _positions(df: DataFrame) -> DataFrame:
    """File order as numbers from 0 in place of seq."""
    cols = [c for c in df.columns if c != "seq"]
    return with_ordinal(df, ["seq"], "position").select("position", *cols)


@register("scan_csv", duckdb_with("raw_txn") + IN_FILE_ORDER + "(" + NORMALIZED_SQL + ")")
def q_scan_csv(spark, sf_dir):
    path = files.scratch_path(spark, "raw-csv")
    files.sink_csv(_in_parts(raw(spark, sf_dir)), path)
    return _positions(ct.normalize_columns(files.scan_csv(spark, path)))


@register("scan_parquet", duckdb_with("txn") + IN_FILE_ORDER + "txn")
def q_scan_parquet(spark, sf_dir):
    path = files.scratch_path(spark, "txn-parts")
    files.sink_parquet(_in_parts(fixture(spark, sf_dir, "txn")), path, partition_by=None)
    return _positions(files.scan_parquet(spark, path))


@register("limit_rows", duckdb_with("txn") + "SELECT * FROM txn ORDER BY seq LIMIT 500")
def q_limit_rows(spark, sf_dir):
    return files.limit_rows(fixture(spark, sf_dir, "txn"), 500)


@register("sink_csv", duckdb_with("txn") + "SELECT * FROM txn")
def q_sink_csv(spark, sf_dir):
    path = files.scratch_path(spark, "txn-csv")
    files.sink_csv(fixture(spark, sf_dir, "txn"), path)
    return spark.read.option("header", True).schema(TXN_SCHEMA).csv(path)


@register("sink_parquet", duckdb_with("txn") + "SELECT * FROM txn")
def q_sink_parquet(spark, sf_dir):
    path = files.scratch_path(spark, "txn-parquet")
    files.sink_parquet(fixture(spark, sf_dir, "txn"), path)
    back = files.scan_parquet(spark, path)
    return back.select(*[f.name for f in TXN_SCHEMA.fields])


@register("sink_report_json", QUALITY_SQL)
def q_sink_report_json(spark, sf_dir):
    path = files.scratch_path(spark, "quality-json")
    rep = ct.quality_report(typed(spark, sf_dir))
    files.sink_report_json(rep, path)
    back = files.scan_report_json(spark, path, schema=rep.schema)
    return back.withColumn("label_rate", r6("label_rate"))


@register("scan_report_json", QUALITY_SQL)
def q_scan_report_json(spark, sf_dir):
    path = files.scratch_path(spark, "quality-json")
    missing = files.scan_report_json(spark, path + "-absent")
    assert missing is None
    rep = ct.quality_report(typed(spark, sf_dir))
    files.sink_report_json(rep, path)
    return files.scan_report_json(spark, path).select(
        *[F.col(c).cast(rep.schema[c].dataType).alias(c) for c in rep.columns]
    ).withColumn("label_rate", r6("label_rate"))


@register("ingest_job", duckdb_with("raw_txn") + "," + TYPED_SQL + f"SELECT {CANON} FROM cleaned")
def q_ingest_job(spark, sf_dir):
    """A CSV folder ingested into a cleaned table, read back."""
    path = files.scratch_path(spark, "ingest")
    files.sink_csv(_in_parts(raw(spark, sf_dir)), f"{path}/raw")
    jobs.ingest(spark, f"{path}/raw", f"{path}/table", f"{path}/report")
    return spark.read.parquet(f"{path}/table").select(*CANONICAL_COLUMNS)
