"""Jobs from file to result: ingest, train, score, drift."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.config import DEFAULT, Params
from txnwatch.functions.contract import parse_timestamp
from txnwatch.operators import contract, drift, evaluate, history, model, state
from txnwatch.operators.contract import upper_currency, validate_requests
from txnwatch.operators.scoring import score_batch
from txnwatch.sources import files


def ingest(spark: SparkSession, source: str, table: str, report: str, max_rows: int | None = None) -> DataFrame:
    """Scan a CSV or Parquet source, clean it, write the table (partitioned by day) and
    the quality report; returns the report."""
    raw = files.scan_transactions(spark, source, max_rows)
    cleaned, quality = contract.clean(raw, write_once=True)
    files.sink_parquet(cleaned, table)
    files.sink_report_json(quality, report)
    return files.scan_report_json(spark, report, schema=quality.schema)


def train(spark: SparkSession, table: DataFrame, bundle_path: str, report_path: str, scores_path: str | None = None,
          params: Params = DEFAULT, model_version: str = "v1") -> model.Bundle:
    """Features, temporal split, boosted trees, threshold from the validation part, metrics
    of validation and test; saves the bundle with the state of the whole table, the
    report (JSON) and, if asked for, the scores of both parts."""
    feats = evaluate.temporal_split(history.causal_features(table, params.history_rows_per_chunk), params).checkpoint()
    fitted, prep = model.train_gbt(feats.where("split = 'train'"), params)
    scored = model.predict_score(fitted, prep, feats.where("split <> 'train'"),
                                 keep=["seq", "timestamp", "split", "is_laundering"]).checkpoint()
    validation = scored.where("split = 'validation'")
    selected = evaluate.select_threshold(evaluate.threshold_sweep(validation, params=params), params).first()
    metrics = {r["split"]: {k: v for k, v in r.asDict().items() if k != "split"}
               for r in evaluate.evaluate_splits(scored, selected["threshold"], params=params).collect()}
    summary = evaluate.dataset_summary(feats).first().asDict()
    bundle = model.Bundle(fitted, prep, float(selected["threshold"]), model_version,
                          json.loads(json.dumps({"dataset": summary, "metrics": metrics}, default=str)))
    model.save_bundle(bundle, bundle_path, state.account_state(table), state.pair_state(table))
    report = {"model_version": model_version, **bundle.metadata, "threshold_selection": selected.asDict(),
              "configuration": asdict(params)}
    files.sink_report_json(spark.createDataFrame([(json.dumps(report, default=str),)], "report string"), report_path)
    if scores_path:
        scored.write.mode("overwrite").parquet(scores_path)
    return bundle


def score_requests(spark: SparkSession, requests: DataFrame, bundle_path: str, params: Params = DEFAULT) -> DataFrame:
    """Valid requests scored with a saved bundle against its state.  With
    ``params.update_state`` later requests see earlier ones, else the saved state only."""
    bundle = model.load_bundle(spark, bundle_path)
    accounts, pairs = model.load_state(spark, bundle_path)
    valid = validate_requests(requests).where("valid").drop("errors", "valid")
    valid = upper_currency(valid).withColumn("timestamp", parse_timestamp(F.col("timestamp")))
    feats = (history.live_features(valid, accounts, pairs, params.history_rows_per_chunk) if params.update_state
             else history.snapshot_features(valid, accounts, pairs))
    return score_batch(model.bundle_scorer(bundle)(feats), bundle.threshold, bundle.model_version)


def drift_between(spark: SparkSession, reference: str, current: str, report_path: str,
                  params: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Reads and cleans two files, builds their features, writes the drift summary and
    the values beside it; returns (values, summary)."""
    frames = [history.causal_features(contract.clean(files.scan_transactions(spark, p))[0], params.history_rows_per_chunk)
              for p in (reference, current)]
    values, summary = drift.drift_report(*frames, params)
    files.sink_report_json(summary, report_path)
    values.write.mode("overwrite").json(report_path.rstrip("/") + "-values")
    return values, summary
