"""Queries for scoring (R1-R5), alert operations (A1-A19) and monitoring
(D4, D5, D7, D8, S13) on the fixture score and alert tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.operators import alerts as al
from txnwatch.operators import monitoring as mo
from txnwatch.operators import scoring as sc
from txnwatch.operators import search_index
from txnwatch.operators.contract import validate_requests
from txnwatch.plans.catalog_contract import REQUEST_ERRORS_SQL
from txnwatch.plans.catalog_features import FEAT_SQL, REASONS_SQL, scored_features
from txnwatch.plans.fixtures import RISK_SCORE_SQL, duckdb_with, fixture
from txnwatch.plans.registry import ORACLE, r6, register
from txnwatch.schema import EXPORT_COLUMNS, REQUEST_FIELDS, RISK_SCORE_BUCKETS
from txnwatch.sources import files

THRESHOLD = 0.65
VERSION = "v1"

ALERT_ID_SQL = ("CASE WHEN risk_score >= 0.65 THEN 'ALT-' || substr(sha256(concat_ws(chr(31), 'v1', "
                + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in REQUEST_FIELDS)
                + ")), 1, 16) END")
TXN_SCORE_SQL = duckdb_with("txn") + f", ts AS (SELECT *, {RISK_SCORE_SQL} AS risk_score FROM txn)\n"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.score_batch(scored_features(spark, sf_dir), THRESHOLD, VERSION)


@register("decide", TXN_SCORE_SQL + "SELECT seq, CASE WHEN risk_score >= 0.65 THEN 'alert' ELSE 'allow' END AS decision FROM ts")
def q_decide(spark, sf_dir):
    return scored(spark, sf_dir).select("seq", "decision")


@register("alert_id", TXN_SCORE_SQL + f"SELECT seq, {ALERT_ID_SQL} AS alert_id FROM ts")
def q_alert_id(spark, sf_dir):
    return scored(spark, sf_dir).select("seq", "alert_id")


@register("score_batch", duckdb_with("txn") + "," + FEAT_SQL + "," + REASONS_SQL + f"""
SELECT seq, transaction_id, {ALERT_ID_SQL} AS alert_id, round(risk_score, 6) AS risk_score, CAST(0.65 AS DOUBLE) AS threshold,
       CASE WHEN risk_score >= 0.65 THEN 'alert' ELSE 'allow' END AS decision,
       array_to_string(reason_codes, ',') AS reason_codes, 'v1' AS model_version
FROM reasons""")
def q_score_batch(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select("seq", "transaction_id", "alert_id", r6("risk_score"), "threshold", "decision",
                    F.array_join("reason_codes", ",").alias("reason_codes"), "model_version")


@register("alert_records", TXN_SCORE_SQL + f"""
SELECT seq AS id, {ALERT_ID_SQL} AS alert_id, transaction_id, timestamp AS created_at, round(risk_score, 6) AS risk_score,
       TRUE AS decision, from_account AS payload_from_account, to_account AS payload_to_account,
       amount_paid AS payload_amount_paid, payment_format AS payload_payment_format
FROM ts WHERE risk_score >= 0.65""")
def q_alert_records(spark, sf_dir):
    rec = sc.alert_records(scored(spark, sf_dir), created_at=F.col("timestamp"))
    return rec.select("id", "alert_id", "transaction_id", "created_at", r6("risk_score"), "decision",
                      *[F.col(f"payload.{c}").alias(f"payload_{c}") for c in
                        ("from_account", "to_account", "amount_paid", "payment_format")])


# ---- alert table operations ------------------------------------------------

def table(spark, sf_dir) -> DataFrame:
    return fixture(spark, sf_dir, "alerts")


def loaded(spark, sf_dir, limit: int = 5000) -> tuple[DataFrame, DataFrame]:
    return al.load_alerts(table(spark, sf_dir), limit)


def typed(spark, sf_dir) -> DataFrame:
    return al.typed_alerts(table(spark, sf_dir))


def flat(spark, sf_dir) -> DataFrame:
    return al.flatten_alerts(typed(spark, sf_dir))


@register("append_alerts", duckdb_with("alerts") + f""", ts AS (SELECT *, {RISK_SCORE_SQL} AS risk_score FROM txn),
r5 AS (SELECT seq AS id, {ALERT_ID_SQL} AS alert_id, transaction_id, risk_score FROM ts WHERE risk_score >= 0.65)
SELECT id, alert_id, transaction_id, round(risk_score, 6) AS risk_score FROM alerts
UNION ALL SELECT id, alert_id, transaction_id, round(risk_score, 6) FROM r5 WHERE alert_id NOT IN (SELECT alert_id FROM alerts)
""")
def q_append(spark, sf_dir):
    t = table(spark, sf_dir)
    new = sc.as_stored(sc.alert_records(scored(spark, sf_dir), created_at=F.col("timestamp")))
    out = al.append_alerts(t, t.unionByName(new.drop("alert_digest")))
    return out.select("id", "alert_id", "transaction_id", r6("risk_score"))


ALERTS_WITH = duckdb_with("alerts", "feedback")


@register("apply_feedback", ALERTS_WITH + """,
fb AS (SELECT alert_id, arg_max({'o': outcome, 'n': notes}, submitted_seq) AS s FROM feedback
       WHERE outcome IN ('confirmed_laundering', 'false_positive', 'needs_review')
         AND (notes IS NULL OR length(notes) <= 2000) GROUP BY alert_id)
SELECT a.alert_id, CASE WHEN fb.s IS NOT NULL THEN fb.s.o ELSE a.analyst_outcome END AS analyst_outcome,
       CASE WHEN fb.s IS NOT NULL THEN fb.s.n ELSE a.analyst_notes END AS analyst_notes
FROM alerts a LEFT JOIN fb ON a.alert_id = fb.alert_id""")
def q_apply_feedback(spark, sf_dir):
    out = al.apply_feedback(table(spark, sf_dir), fixture(spark, sf_dir, "feedback"))
    return out.select("alert_id", "analyst_outcome", "analyst_notes")


@register("unmatched_feedback", ALERTS_WITH + """
SELECT alert_id, outcome, notes, submitted_seq FROM feedback WHERE alert_id NOT IN (SELECT alert_id FROM alerts)""")
def q_unmatched(spark, sf_dir):
    return al.unmatched_feedback(table(spark, sf_dir), fixture(spark, sf_dir, "feedback"))


@register("recent_alerts", ALERTS_WITH + """
SELECT alert_id, transaction_id, created_at, round(risk_score, 6) AS risk_score, decision, reason_codes, analyst_outcome
FROM alerts ORDER BY created_at DESC, alert_id LIMIT 100""")
def q_recent(spark, sf_dir):
    return al.recent_alerts(table(spark, sf_dir), 100).withColumn("risk_score", r6("risk_score"))


@register("load_alerts", ALERTS_WITH + """
SELECT alert_id, created_at, round(risk_score, 6) AS risk_score, threshold, analyst_outcome IS NOT NULL AS reviewed,
       (SELECT count(*) FROM alerts) AS total_alerts
FROM (SELECT * FROM alerts ORDER BY created_at DESC, alert_id LIMIT 5000)""")
def q_load(spark, sf_dir):
    lo, total = loaded(spark, sf_dir)
    return lo.select("alert_id", "created_at", r6("risk_score"), "threshold", "reviewed",
                     total.select("total_alerts").scalar().alias("total_alerts"))


@register("decode_json", ALERTS_WITH + """
SELECT alert_id, CAST(len(r) AS INTEGER) AS n_reasons, array_to_string(r, ', ') AS reason_text
FROM (SELECT alert_id, coalesce(from_json(reason_codes, '["VARCHAR"]'), []) AS r FROM alerts)""")
def q_decode(spark, sf_dir):
    d = al.decode_json(table(spark, sf_dir))
    return d.select("alert_id", F.size("reason_codes").alias("n_reasons"),
                    F.array_join("reason_codes", ", ").alias("reason_text"))


PAYLOAD_SQL = ", ".join(
    (f"TRY_CAST(json_extract_string(payload, '$.{f}') AS DOUBLE) AS {f}" if f.startswith("amount")
     else f"json_extract_string(payload, '$.{f}') AS {f}")
    for f in al.PAYLOAD_FIELDS)


@register("flatten_alerts", ALERTS_WITH + f"""
SELECT alert_id, {PAYLOAD_SQL}, array_to_string(coalesce(from_json(reason_codes, '["VARCHAR"]'), []), ', ') AS reason_text
FROM alerts""")
def q_flatten(spark, sf_dir):
    return flat(spark, sf_dir).select("alert_id", *al.PAYLOAD_FIELDS, "reason_text")


@register("alert_summary", ALERTS_WITH + """
SELECT (SELECT count(*) FROM alerts) AS total_alerts, count(*) AS loaded_alerts,
       CAST(count_if(analyst_outcome IS NOT NULL) AS BIGINT) AS reviewed,
       round(coalesce(count_if(analyst_outcome IS NOT NULL) / nullif(count(*), 0), 0.0), 6) AS review_rate,
       round(coalesce(avg(risk_score), 0.0), 6) AS average_risk, round(coalesce(median(risk_score), 0.0), 6) AS median_risk,
       max(created_at) AS latest_alert
FROM alerts""")
def q_summary(spark, sf_dir):
    s = al.alert_summary(typed(spark, sf_dir), al.alert_total(table(spark, sf_dir)))
    return s.select("total_alerts", "loaded_alerts", "reviewed", r6("review_rate"), r6("average_risk"),
                    r6("median_risk"), "latest_alert")


REASONS_TABLE = "(SELECT unnest(coalesce(from_json(reason_codes, '[\"VARCHAR\"]'), [])) AS reason_code FROM alerts)"


@register("reason_counts", ALERTS_WITH + f"""
SELECT reason_code, count(*) AS count FROM {REASONS_TABLE} WHERE reason_code IS NOT NULL GROUP BY 1""")
def q_reason_counts(spark, sf_dir):
    return al.reason_counts(typed(spark, sf_dir))


@register("top_reasons", ALERTS_WITH + f"""
SELECT reason_code, count(*) AS count FROM {REASONS_TABLE} WHERE reason_code IS NOT NULL GROUP BY 1
ORDER BY count DESC, reason_code LIMIT 12""")
def q_top_reasons(spark, sf_dir):
    return al.top_reasons(typed(spark, sf_dir))


@register("daily_alert_volume", ALERTS_WITH + """
SELECT date_trunc('day', created_at) AS day, count(*) AS alerts FROM alerts WHERE created_at IS NOT NULL GROUP BY 1""")
def q_daily(spark, sf_dir):
    return al.daily_alert_volume(typed(spark, sf_dir))


@register("risk_histogram", ALERTS_WITH + """
SELECT bin, bin / 20.0 AS lower, (bin + 1) / 20.0 AS upper, count(*) AS alerts
FROM (SELECT CAST(least(floor(risk_score * 20), 19) AS INTEGER) AS bin FROM alerts WHERE risk_score IS NOT NULL) GROUP BY bin""")
def q_hist(spark, sf_dir):
    return al.risk_histogram(typed(spark, sf_dir))


@register("outcome_counts", ALERTS_WITH + """
SELECT coalesce(analyst_outcome, 'unreviewed') AS outcome, count(*) AS count FROM alerts GROUP BY 1""")
def q_outcomes(spark, sf_dir):
    return al.outcome_counts(typed(spark, sf_dir))


@register("risk_by_payment_format", ALERTS_WITH + """
SELECT payment_format, count(alert_id) AS alerts, round(avg(risk_score), 6) AS average_risk
FROM (SELECT alert_id, risk_score, json_extract_string(payload, '$.payment_format') AS payment_format FROM alerts)
WHERE payment_format IS NOT NULL GROUP BY 1""")
def q_by_format(spark, sf_dir):
    return al.risk_by_payment_format(flat(spark, sf_dir)).withColumn("average_risk", r6("average_risk"))


@register("alert_explorer", ALERTS_WITH + """
SELECT alert_id, round(risk_score, 6) AS risk_score FROM alerts
WHERE risk_score >= 0.7 AND analyst_outcome IS NULL AND json_extract_string(payload, '$.from_bank') = 'B007'""")
def q_explorer(spark, sf_dir):
    f = al.alert_explorer(flat(spark, sf_dir), min_risk=0.7, outcome="Unreviewed", from_bank="B007")
    return f.select("alert_id", r6("risk_score"))


@register("alert_search", ALERTS_WITH + """
SELECT alert_id FROM alerts
WHERE contains(lower(coalesce(transaction_id, '')), 'a000001') OR contains(lower(coalesce(alert_id, '')), 'a000001')
   OR contains(lower(coalesce(json_extract_string(payload, '$.from_account'), '')), 'a000001')
   OR contains(lower(coalesce(json_extract_string(payload, '$.to_account'), '')), 'a000001')""")
def q_search(spark, sf_dir):
    return al.alert_search(flat(spark, sf_dir), "A000001").select("alert_id")


@register("alert_search_index", ORACLE["alert_search"])
def q_search_index(spark, sf_dir):
    """The same search through the inverted index of the whole table."""
    table, path = flat(spark, sf_dir), files.scratch_path(spark, "search")
    search_index.build(table, path)
    return search_index.search(table, path, "A000001").select("alert_id")


@register("explorer_options", ALERTS_WITH + """
SELECT DISTINCT 'analyst_outcome' AS option, analyst_outcome AS value FROM alerts WHERE analyst_outcome IS NOT NULL
UNION SELECT DISTINCT 'from_bank', json_extract_string(payload, '$.from_bank') FROM alerts
WHERE json_extract_string(payload, '$.from_bank') IS NOT NULL""")
def q_options(spark, sf_dir):
    return al.explorer_options(flat(spark, sf_dir))


@register("export_alerts", ALERTS_WITH + f"""
SELECT created_at, alert_id, transaction_id, round(risk_score, 6) AS risk_score, threshold,
       TRY_CAST(json_extract_string(payload, '$.amount_paid') AS DOUBLE) AS amount_paid,
       json_extract_string(payload, '$.payment_currency') AS payment_currency,
       json_extract_string(payload, '$.payment_format') AS payment_format,
       json_extract_string(payload, '$.from_bank') AS from_bank, json_extract_string(payload, '$.to_bank') AS to_bank,
       -- CSV keeps no difference between an empty and a missing value: '' reads back as NULL
       nullif(array_to_string(coalesce(from_json(reason_codes, '["VARCHAR"]'), []), ', '), '') AS reason_text, analyst_outcome
FROM alerts""")
def q_export(spark, sf_dir):
    f = flat(spark, sf_dir)
    path = files.scratch_path(spark, "alerts-export")
    al.export_alerts(f, path)
    schema = f.select(*EXPORT_COLUMNS).schema
    back = spark.read.option("header", True).schema(schema).csv(path)
    return back.withColumn("risk_score", r6("risk_score"))


@register("alert_detail", ALERTS_WITH + f"""
SELECT alert_id, round(risk_score, 6) AS risk_score, {PAYLOAD_SQL}
FROM alerts WHERE alert_id = (SELECT alert_id FROM alerts ORDER BY risk_score DESC, alert_id LIMIT 1)""")
def q_detail(spark, sf_dir):
    f = flat(spark, sf_dir)
    top = f.orderBy(F.col("risk_score").desc(), "alert_id").limit(1).select("alert_id").scalar()
    return al.alert_detail(f, top).select("alert_id", r6("risk_score"), *al.PAYLOAD_FIELDS)


# ---- monitoring ------------------------------------------------------------

REQUEST_STATUS_SQL = duckdb_with("requests", "scored") + """,
rq AS (SELECT x.seq, x.e, s.risk_score, s.timestamp
       FROM (SELECT seq, """ + REQUEST_ERRORS_SQL + """ AS e
             FROM requests) x JOIN scored s ON x.seq = s.seq),
st AS (SELECT CASE WHEN len(e) > 0 THEN 'unknown' WHEN risk_score >= 0.65 THEN 'alert' ELSE 'allow' END AS decision,
              CASE WHEN len(e) > 0 THEN 'rejected' ELSE 'success' END AS status FROM rq)
"""


def request_status(spark, sf_dir) -> DataFrame:
    v = validate_requests(fixture(spark, sf_dir, "requests"))
    s = fixture(spark, sf_dir, "scored").select("seq", "risk_score")
    return _status(v.join(s, "seq"))


@register("score_request_counts", REQUEST_STATUS_SQL + "SELECT decision, status, count(*) AS requests FROM st GROUP BY 1, 2")
def q_request_counts(spark, sf_dir):
    return mo.score_request_counts(request_status(spark, sf_dir))


def _bucket_sql(col: str, src: str, bounds: list[float]) -> str:
    parts = [f"SELECT {i} AS i, '{b!r}' AS le, CAST(count_if({col} <= {b!r}) AS BIGINT) AS count FROM {src}"
             for i, b in enumerate(bounds)]
    parts.append(f"SELECT {len(bounds)} AS i, '+Inf' AS le, count({col}) AS count FROM {src}")
    return "SELECT le, count FROM (" + " UNION ALL ".join(parts) + ")"


@register("risk_score_buckets", duckdb_with("scored") + _bucket_sql("risk_score", "scored", RISK_SCORE_BUCKETS))
def q_risk_buckets(spark, sf_dir):
    return mo.cumulative_histogram(fixture(spark, sf_dir, "scored"), "risk_score", RISK_SCORE_BUCKETS)


@register("feedback_counts", ALERTS_WITH + """
SELECT outcome, count(*) AS feedback FROM feedback
WHERE outcome IN ('confirmed_laundering', 'false_positive', 'needs_review') AND (notes IS NULL OR length(notes) <= 2000)
  AND alert_id IN (SELECT alert_id FROM alerts) GROUP BY 1""")
def q_feedback_counts(spark, sf_dir):
    return mo.feedback_counts(table(spark, sf_dir), fixture(spark, sf_dir, "feedback"))


# Metrics text: two scrapes (history before the cut, then everything); the
# parser keeps the later value of each series.
CUT = "2024-01-16 00:00:00"


def _exposition(counts: DataFrame, buckets: DataFrame) -> DataFrame:
    req = counts.select(F.format_string('txnwatch_score_requests_total{decision="%s",status="%s"} %s',
                                        "decision", "status", F.col("requests").cast("double")).alias("value"))
    bk = buckets.select(F.format_string('txnwatch_risk_score_bucket{le="%s"} %s', "le",
                                        F.col("count").cast("double")).alias("value"))
    spark = counts.sparkSession
    fixed = spark.createDataFrame([("# HELP txnwatch_score_requests_total Scoring requests",),
                                   ("# TYPE txnwatch_score_requests_total counter",), ("",),
                                   ("txnwatch_model_ready 1.0",), ("garbage",), ("txnwatch_bad_value abc",)], "value string")
    return fixed.unionByName(req).unionByName(bk)


def _status(df: DataFrame) -> DataFrame:
    return df.select(
        F.when(~F.col("valid"), F.lit("unknown")).when(F.col("risk_score") >= THRESHOLD, F.lit("alert"))
        .otherwise(F.lit("allow")).alias("decision"),
        F.when(F.col("valid"), F.lit("success")).otherwise(F.lit("rejected")).alias("status"))


def metrics_text(spark, sf_dir) -> DataFrame:
    """Render two scrapes of exposition text from the request and score
    tables, write them, and parse them back (S13)."""
    path = files.scratch_path(spark, "metrics-text")
    sc_ = fixture(spark, sf_dir, "scored")
    req = validate_requests(fixture(spark, sf_dir, "requests")).join(
        sc_.select("seq", "risk_score", F.col("timestamp").alias("_t")), "seq")
    early = F.col("_t") < F.lit(CUT).cast("timestamp")
    scrapes = [
        (_status(req.where(early)), sc_.where(F.col("timestamp") < F.lit(CUT).cast("timestamp"))),
        (_status(req), sc_),
    ]
    for i, (st, scores) in enumerate(scrapes, start=1):
        _exposition(mo.score_request_counts(st), mo.cumulative_histogram(scores, "risk_score", RISK_SCORE_BUCKETS)) \
            .write.mode("overwrite").text(f"{path}/scrape-{i}")
    return mo.parse_metrics_text(spark, path + "/scrape-*")


METRICS_SQL = REQUEST_STATUS_SQL + f""",
bk AS ({_bucket_sql("risk_score", "scored", RISK_SCORE_BUCKETS)}),
parsed AS (
  SELECT 'txnwatch_score_requests_total{{decision="' || decision || '",status="' || status || '"}}' AS metric,
         CAST(count(*) AS DOUBLE) AS value FROM st GROUP BY decision, status
  UNION ALL SELECT 'txnwatch_risk_score_bucket{{le="' || le || '"}}', CAST(count AS DOUBLE) FROM bk
  UNION ALL SELECT 'txnwatch_model_ready', 1.0)
""".replace("{{", "{").replace("}}", "}")


@register("parse_metrics_text", METRICS_SQL + "SELECT metric, value FROM parsed")
def q_parse_metrics(spark, sf_dir):
    return metrics_text(spark, sf_dir)


@register("metric_prefix_sum", METRICS_SQL + """
SELECT coalesce(sum(value), 0.0) AS total FROM parsed
WHERE starts_with(metric, 'txnwatch_score_requests_total') AND contains(metric, 'status="success"')""")
def q_prefix_sum(spark, sf_dir):
    return mo.metric_prefix_sum(metrics_text(spark, sf_dir), "txnwatch_score_requests_total", 'status="success"')
