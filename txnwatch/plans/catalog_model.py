"""Queries for model preprocessing, training and scoring.

Features are built over the whole transaction fixture, then split by time;
preprocessing is fitted on the training split.  The queries that need a model share
one run of the training job per session and input (default settings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch import jobs
from txnwatch.config import DEFAULT, PRODUCTION
from txnwatch.functions.contract import parse_timestamp
from txnwatch.operators import evaluate as ev
from txnwatch.operators import history, state
from txnwatch.operators import model as ml
from txnwatch.operators.contract import upper_currency, validate_requests
from txnwatch.operators.ordinal import with_ordinal
from txnwatch.plans.catalog_contract import REQUEST_ERRORS_SQL
from txnwatch.plans.catalog_evaluate import TRAIN_FRAC, VAL_FRAC
from txnwatch.plans.catalog_features import FEAT_SQL, features
from txnwatch.plans.fixtures import duckdb_with, fixture, txn
from txnwatch.plans.registry import r6, register
from txnwatch.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from txnwatch.sources import files
from txnwatch.streaming.replay import encode_transactions, replay_sink
from txnwatch.streaming.scoring import read_alerts, stream_score


def split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.temporal_split(features(spark, sf_dir)).checkpoint()


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_features(spark, sf_dir).where(F.col("split") == "train")


TRAIN_SQL = duckdb_with("txn") + "," + FEAT_SQL + f""",
ordf AS (SELECT *, row_number() OVER (ORDER BY timestamp, seq) - 1 AS ord, count(*) OVER () AS n FROM feat),
train AS (SELECT * FROM ordf WHERE ord < CAST(floor(n * CAST({TRAIN_FRAC} AS DOUBLE)) AS BIGINT))
"""


@register("impute_median", TRAIN_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(median(CAST({c} AS DOUBLE)), 6) AS median FROM train" for c in NUMERIC_FEATURES))
def q_median(spark, sf_dir):
    med = ml.impute_median(train_rows(spark, sf_dir))
    df = spark.createDataFrame([(c, med[c]) for c in NUMERIC_FEATURES], "feature string, median double")
    return df.select("feature", r6("median"))


def _key_sql(c: str) -> str:
    return f"upper({c})" if c in ml.CURRENCY_COLUMNS else c


@register("impute_mode", TRAIN_SQL + " UNION ALL ".join(
    f"(SELECT '{c}' AS feature, v AS mode FROM (SELECT {_key_sql(c)} AS v, count(*) AS n FROM train "
    f"WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1)" for c in CATEGORICAL_FEATURES))
def q_mode(spark, sf_dir):
    t = train_rows(spark, sf_dir)
    return spark.createDataFrame([(c, ml.impute_mode(t, c)) for c in CATEGORICAL_FEATURES], "feature string, mode string")


@register("ordinal_encode", TRAIN_SQL + ", cats AS (SELECT " + ", ".join(
    f"list_sort(list(DISTINCT {_key_sql(c)})) AS l_{c}" for c in CATEGORICAL_FEATURES) + " FROM train)\nSELECT seq, " + ", ".join(
    f"CAST(coalesce(list_position(l_{c}, {_key_sql(c)}) - 1, -1) AS DOUBLE) AS {c}_code" for c in CATEGORICAL_FEATURES)
    + " FROM feat, cats")
def q_encode(spark, sf_dir):
    s = split_features(spark, sf_dir)
    prep = ml.fit_preprocess(s.where(F.col("split") == "train"))
    return ml.apply_preprocess(s, prep, keep=["seq"]).select("seq", *[f"{c}_code" for c in CATEGORICAL_FEATURES])


@register("class_weights", TRAIN_SQL + """
SELECT is_laundering, round((SELECT count(*) FROM train) / (2.0 * count(*)), 6) AS weight FROM train GROUP BY 1""")
def q_weights(spark, sf_dir):
    w = ml.class_weights(train_rows(spark, sf_dir))
    return spark.createDataFrame(sorted(w.items()), "is_laundering int, weight double").select("is_laundering", r6("weight"))


_TRAINED: dict[tuple[str, str], tuple[ml.Bundle, str]] = {}


def trained(spark: SparkSession, sf_dir: str) -> tuple[ml.Bundle, str]:
    """The bundle of the training job and the folder of its bundle, report and scores."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        path = files.scratch_path(spark, "train")
        bundle = jobs.train(spark, txn(spark, sf_dir), f"{path}/bundle", f"{path}/report", f"{path}/scores",
                            model_version="check")
        _TRAINED[key] = (bundle, path)
    return _TRAINED[key]


ORDERED_SQL = duckdb_with("txn") + """,
o AS (SELECT *, row_number() OVER (ORDER BY timestamp, seq) - 1 AS ord, count(*) OVER () AS n FROM txn)
"""


def _after(frac: str) -> str:
    return f"ord >= CAST(floor(n * CAST({frac} AS DOUBLE)) AS BIGINT)"


@register("train_gbt")
def q_train(spark, sf_dir):
    return ml.feature_importances(trained(spark, sf_dir)[0].model, spark)


@register("predict_score")
def q_predict(spark, sf_dir):
    b, _ = trained(spark, sf_dir)
    s = split_features(spark, sf_dir)
    return ml.predict_score(b.model, b.prep, s.where(F.col("split") == "test"), keep=["seq"])


@register("train_job", ORDERED_SQL + f"""
SELECT CASE WHEN {_after(VAL_FRAC)} THEN 'test' ELSE 'validation' END AS split, count(*) AS rows,
       CAST(sum(is_laundering) AS BIGINT) AS positives, TRUE AS counts_agree, TRUE AS within_budget
FROM o WHERE {_after(TRAIN_FRAC)} GROUP BY 1""")
def q_train_job(spark, sf_dir):
    """The metrics that the job saved, against the scores that it wrote."""
    b, path = trained(spark, sf_dir)
    scores = spark.read.parquet(f"{path}/scores")
    alert = F.col("risk_score") >= b.threshold
    seen = scores.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("is_laundering").cast("long").alias("positives"),
        F.count_if(alert & (F.col("is_laundering") == 1)).alias("tp"),
        F.count_if(alert & (F.col("is_laundering") == 0)).alias("fp"))
    saved = ml.load_bundle(spark, f"{path}/bundle").metadata["metrics"]
    told = spark.createDataFrame([(k, m["tp"], m["fp"], m["recall"], m["alert_rate"]) for k, m in saved.items()],
                                 "split string, tp_saved long, fp_saved long, recall double, alert_rate double")
    sweep = ev.threshold_sweep(scores.where("split = 'validation'"))
    feasible = sweep.where((F.col("alert_rate") <= DEFAULT.max_alert_rate) & (F.col("recall") >= DEFAULT.min_recall))
    any_feasible = not feasible.isEmpty()
    kept = (F.col("alert_rate") <= DEFAULT.max_alert_rate) & (F.col("recall") >= DEFAULT.min_recall)
    return seen.join(told, "split").select(
        "split", "rows", "positives", ((F.col("tp") == F.col("tp_saved")) & (F.col("fp") == F.col("fp_saved"))).alias("counts_agree"),
        (kept if any_feasible else F.lit(True)).alias("_kept")).select(
        "split", "rows", "positives", "counts_agree",
        (F.col("_kept") | (F.col("split") == "test")).alias("within_budget"))


@register("model_bundle_save", duckdb_with("txn") + """
SELECT 'check' AS model_version, count(*) AS rows,
       (SELECT count(*) FROM (SELECT from_account FROM txn UNION SELECT to_account FROM txn)) AS accounts,
       (SELECT count(*) FROM (SELECT DISTINCT from_account, to_account FROM txn)) AS pairs
FROM txn""")
def q_bundle_save(spark, sf_dir):
    """What a saved bundle holds, read back from storage."""
    _, path = trained(spark, sf_dir)
    b = ml.load_bundle(spark, f"{path}/bundle")
    accounts, pairs = ml.load_state(spark, f"{path}/bundle")
    return spark.createDataFrame([(b.model_version, int(b.metadata["dataset"]["rows"]), accounts.count(), pairs.count())],
                                 "model_version string, rows long, accounts long, pairs long")


@register("model_bundle_load", ORDERED_SQL + f"SELECT seq, TRUE AS same FROM o WHERE {_after(VAL_FRAC)}")
def q_bundle_load(spark, sf_dir):
    """Scores of a loaded bundle's scorer equal those the training job wrote."""
    _, path = trained(spark, sf_dir)
    b = ml.load_bundle(spark, f"{path}/bundle")
    test = split_features(spark, sf_dir).where(F.col("split") == "test")
    wrote = spark.read.parquet(f"{path}/scores").select("seq", F.col("risk_score").alias("written"))
    again = ml.bundle_scorer(b)(test).select("seq", "risk_score")
    return again.join(wrote, "seq").select("seq", (F.abs(F.col("risk_score") - F.col("written")) < 1e-12).alias("same"))


@register("score_job", duckdb_with("requests") + f"""
SELECT seq, 'check' AS model_version, TRUE AS scored, TRUE AS decided FROM requests WHERE len({REQUEST_ERRORS_SQL}) = 0""")
def q_score_job(spark, sf_dir):
    """Requests scored with the saved bundle and its frozen state, against the scores of the
    trained model on features from the folded (not saved) state."""
    b, path = trained(spark, sf_dir)
    requests = fixture(spark, sf_dir, "requests")
    out = jobs.score_requests(spark, requests, f"{path}/bundle", PRODUCTION)
    t = txn(spark, sf_dir)
    valid = validate_requests(requests).where("valid").drop("errors", "valid")
    valid = upper_currency(valid).withColumn("timestamp", parse_timestamp(F.col("timestamp")))
    feats = history.snapshot_features(valid, state.account_state(t), state.pair_state(t))
    want = ml.predict_score(b.model, b.prep, feats, keep=["seq"]).withColumnRenamed("risk_score", "_want")
    return out.join(want, "seq").select(
        "seq", "model_version", (F.abs(F.col("risk_score") - F.col("_want")) < 1e-9).alias("scored"),
        ((F.col("decision") == "alert") == (F.col("risk_score") >= F.lit(b.threshold))).alias("decided"))


@register("stream_score_bundle", duckdb_with("txn") + """,
o AS (SELECT row_number() OVER (ORDER BY seq) - 1 AS ri FROM txn)
SELECT ri AS seq, TRUE AS same_score, TRUE AS alert_iff_over FROM o""")
def q_stream_bundle(spark, sf_dir):
    """A stream scored with the trained bundle: its scores equal those of the batch features,
    and the stored alerts are the requests at or above the threshold."""
    b, _ = trained(spark, sf_dir)
    t = txn(spark, sf_dir)
    topic, out = files.scratch_path(spark, "topic"), files.scratch_path(spark, "stream-out")
    replay_sink(encode_transactions(t), topic)
    limit = max(1, -(-t.count() // 2))
    stream_score(spark, topic, out, scorer=ml.bundle_scorer(b), threshold=b.threshold, model_version=b.model_version,
                 max_per_trigger=limit, checkpoint=files.scratch_path(spark, "stream-ck"))
    numbered = with_ordinal(features(spark, sf_dir), ["seq"], "_ri")
    batch = ml.predict_score(b.model, b.prep, numbered, keep=["_ri"]).select(F.col("_ri").alias("seq"), F.col("risk_score").alias("_want"))
    streamed = ml.bundle_scorer(b)(spark.read.parquet(f"{out}/features")).select("seq", "risk_score")
    alerts = read_alerts(spark, out).select(F.col("id").alias("seq"), F.col("risk_score").alias("_alert"))
    return batch.join(streamed, "seq").join(alerts, "seq", "left").select(
        "seq", (F.abs(F.col("risk_score") - F.col("_want")) < 1e-9).alias("same_score"),
        F.when(F.col("_want") >= b.threshold, F.coalesce(F.abs(F.col("_alert") - F.col("_want")) < 1e-9, F.lit(False)))
        .otherwise(F.col("_alert").isNull()).alias("alert_iff_over"))
