"""Operational metrics as aggregations (D4-D8) and the metrics text reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.operators.contract import validate_feedback


def score_request_counts(requests_scored: DataFrame) -> DataFrame:
    """Requests by (decision, status); rejected requests have decision 'unknown'."""
    return requests_scored.groupBy("decision", "status").agg(F.count(F.lit(1)).alias("requests"))


def cumulative_histogram(df: DataFrame, col: str, bounds: list[float]) -> DataFrame:
    """Cumulative counts per upper bound ``le`` (last bound +Inf).

    Values are bucketed first (one small aggregation), then a running sum over
    the at most len(bounds)+1 buckets.
    """
    edges = sorted(float(b) for b in bounds)
    idx = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        idx = F.when(F.col(col) <= edges[i], F.lit(i)).otherwise(idx)
    per = df.where(F.col(col).isNotNull()).groupBy(idx.alias("_i")).agg(F.count(F.lit(1)).alias("_n"))
    spark = df.sparkSession
    labels = spark.createDataFrame([(i, repr(b)) for i, b in enumerate(edges)] + [(len(edges), "+Inf")],
                                   "_i int, le string")
    from pyspark.sql import Window
    # one row per bound: a bounded table
    w = Window.orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    return (labels.join(per, "_i", "left")
            .select("_i", "le", F.sum(F.coalesce("_n", F.lit(0))).over(w).cast("long").alias("count"))
            .orderBy("_i").drop("_i"))


def feedback_counts(table: DataFrame, feedback: DataFrame) -> DataFrame:
    """Accepted feedback (valid and naming a known alert) by outcome."""
    ok = validate_feedback(feedback).where("valid").join(table.select("alert_id"), "alert_id", "left_semi")
    return ok.groupBy("outcome").agg(F.count(F.lit(1)).alias("feedback"))


def parse_metrics_text(spark: SparkSession, path: str) -> DataFrame:
    """Exposition text -> (metric, value).

    Skips blank lines, ``#`` lines, lines without a space and non-numeric
    values; splits on the last space; for a repeated metric the last line
    (by file, then position) wins.
    """
    lines = spark.read.text(path).select(
        F.trim("value").alias("line"),
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    ok = lines.where((F.length("line") > 0) & ~F.startswith("line", F.lit("#")) & F.contains("line", F.lit(" ")))
    parsed = ok.select(
        F.regexp_extract("line", r"^(.*) ([^ ]*)$", 1).alias("metric"),
        F.regexp_extract("line", r"^(.*) ([^ ]*)$", 2).try_cast("double").alias("value"),
        "_f", "_b", "_pos",
    ).where(F.col("value").isNotNull())
    return parsed.groupBy("metric").agg(F.max_by("value", F.struct("_f", "_b", "_pos")).alias("value"))


def metric_prefix_sum(metrics: DataFrame, prefix: str, label_text: str | None = None) -> DataFrame:
    """Sum of the series whose name starts with ``prefix`` (and contains
    ``label_text``, e.g. 'status="success"')."""
    cond = F.startswith("metric", F.lit(prefix))
    if label_text:
        cond = cond & F.contains("metric", F.lit(label_text))
    return metrics.where(cond).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"))
