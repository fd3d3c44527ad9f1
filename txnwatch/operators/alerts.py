"""Alert-table operations and investigation queries.

The alert table keeps ``reason_codes`` and ``payload`` as JSON text (as the
source system stores them); decoding is an explicit step (A6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.operators.contract import validate_feedback
from txnwatch.operators.ordinal import grouped_medians
from txnwatch.schema import EXPORT_COLUMNS, PAYLOAD_FIELDS, SEARCH_COLUMNS

REASONS_TYPE = T.ArrayType(T.StringType())
PAYLOAD_TYPE = T.StructType([T.StructField(f, T.StringType()) for f in PAYLOAD_FIELDS])


def append_alerts(table: DataFrame, new: DataFrame) -> DataFrame:
    """A1: insert rows whose alert is not in the table; of equal ones in ``new`` the lowest
    id stays.  Alerts are told apart by ``alert_digest`` where both tables have it, else by
    alert_id.  (``alert_store`` is the same for a stored table that grows by batches.)"""
    key = "alert_digest" if "alert_digest" in table.columns and "alert_digest" in new.columns else "alert_id"
    fresh = new.join(table.select(key), key, "left_anti")
    first = fresh.groupBy(key).agg(F.min("id").alias("id"))
    fresh = fresh.join(first, [key, "id"], "left_semi")
    return table.unionByName(fresh.select(*table.columns))


def latest_feedback(feedback: DataFrame) -> DataFrame:
    """Valid feedback, last write per alert wins (by submission order)."""
    v = validate_feedback(feedback).where("valid")
    return v.groupBy("alert_id").agg(
        F.max_by(F.struct("outcome", "notes"), F.col("submitted_seq")).alias("_fb"))


def apply_feedback(table: DataFrame, feedback: DataFrame) -> DataFrame:
    """A2: set outcome and notes of known alerts from the feedback log."""
    fb = latest_feedback(feedback)
    j = table.join(fb, "alert_id", "left")
    has = F.col("_fb").isNotNull()
    return j.select(*[
        F.when(has, F.col("_fb.outcome")).otherwise(F.col("analyst_outcome")).alias("analyst_outcome")
        if c == "analyst_outcome" else
        F.when(has, F.col("_fb.notes")).otherwise(F.col("analyst_notes")).alias("analyst_notes")
        if c == "analyst_notes" else F.col(c)
        for c in table.columns
    ])


def unmatched_feedback(table: DataFrame, feedback: DataFrame) -> DataFrame:
    """A3: feedback naming an unknown alert (rejected)."""
    return feedback.join(table.select("alert_id"), "alert_id", "left_anti")


def _checked(limit: int, most: int) -> int:
    if not 1 <= int(limit) <= most:
        raise ValueError(f"limit must be between 1 and {most}: {limit}")
    return int(limit)


def recent_alerts(table: DataFrame, limit: int = 100) -> DataFrame:
    """A4: newest alerts first (1 to 500, anything else raises), 7 columns."""
    n = _checked(limit, 500)
    return table.orderBy(F.col("created_at").desc(), "alert_id").limit(n).select(
        "alert_id", "transaction_id", "created_at", "risk_score", "decision", "reason_codes", "analyst_outcome")


def decode_json(table: DataFrame) -> DataFrame:
    """JSON text -> values; missing or bad JSON gives [] / {}."""
    reasons = F.coalesce(F.from_json("reason_codes", REASONS_TYPE), F.array().cast(REASONS_TYPE))
    payload = F.coalesce(F.from_json("payload", PAYLOAD_TYPE),
                         F.struct(*[F.lit(None).cast("string").alias(f) for f in PAYLOAD_FIELDS]))
    return table.withColumn("reason_codes", reasons).withColumn("payload", payload)


def typed_alerts(table: DataFrame) -> DataFrame:
    """The whole alert table with JSON decoded, types coerced and ``reviewed``;
    the input of A7-A19."""
    return decode_json(table).select(
        *[c for c in table.columns if c not in ("created_at", "risk_score", "threshold", "reason_codes", "payload")],
        F.col("created_at").cast("string").try_cast("timestamp").alias("created_at"),
        F.col("risk_score").cast("string").try_cast("double").alias("risk_score"),
        F.col("threshold").cast("string").try_cast("double").alias("threshold"),
        "reason_codes", "payload",
        F.col("analyst_outcome").isNotNull().alias("reviewed"),
    )


def alert_total(table: DataFrame) -> DataFrame:
    """Lifetime number of alerts as a one-row frame."""
    return table.agg(F.count(F.lit(1)).alias("total_alerts"))


def load_alerts(table: DataFrame, limit: int = 5000) -> tuple[DataFrame, DataFrame]:
    """A5: (newest ``limit`` alerts, typed, lifetime count): a page of the table for
    display, 1 to 50,000 rows (anything else raises)."""
    n = _checked(limit, 50_000)
    recent = table.orderBy(F.col("created_at").desc(), "alert_id").limit(n)
    return typed_alerts(recent), alert_total(table)


def flatten_alerts(loaded: DataFrame) -> DataFrame:
    """Payload fields as columns, amounts numeric, reasons joined by ', '."""
    cols = [F.col(f"payload.{f}").alias(f) for f in PAYLOAD_FIELDS]
    out = loaded.select("*", *cols)
    for a in ("amount_paid", "amount_received"):
        out = out.withColumn(a, F.col(a).try_cast("double"))
    return out.withColumn("reason_text", F.array_join("reason_codes", ", "))


def alert_summary(loaded: DataFrame, total: DataFrame) -> DataFrame:
    """Headline numbers; zeros when nothing is loaded.  The median is exact, from
    the two middle ranks of the score histogram, so no task holds all scores."""
    median = grouped_medians(loaded.select("risk_score"), ["risk_score"])["risk_score"]
    agg = loaded.agg(
        F.count(F.lit(1)).alias("loaded_alerts"),
        F.count_if("reviewed").alias("reviewed"),
        F.avg("risk_score").alias("_avg"),
        F.max("created_at").alias("latest_alert"),
    )
    return agg.select(
        total.select("total_alerts").scalar().alias("total_alerts"),
        "loaded_alerts", "reviewed",
        F.coalesce(F.col("reviewed") / F.nullif(F.col("loaded_alerts"), F.lit(0)), F.lit(0.0)).alias("review_rate"),
        F.coalesce("_avg", F.lit(0.0)).alias("average_risk"),
        F.lit(median if median is not None else 0.0).alias("median_risk"),
        "latest_alert",
    )


def reason_counts(loaded: DataFrame) -> DataFrame:
    """Alerts per reason code, most frequent first (empty lists vanish)."""
    return (loaded.select(F.explode("reason_codes").alias("reason_code")).where(F.col("reason_code").isNotNull())
            .groupBy("reason_code").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), "reason_code"))


def top_reasons(loaded: DataFrame, k: int = 12) -> DataFrame:
    """A10: the 12 most frequent reason codes."""
    return reason_counts(loaded).limit(k)


def daily_alert_volume(loaded: DataFrame) -> DataFrame:
    """Alerts per UTC day (rows without a time are dropped)."""
    return (loaded.where(F.col("created_at").isNotNull())
            .groupBy(F.date_trunc("day", "created_at").alias("day")).agg(F.count(F.lit(1)).alias("alerts"))
            .orderBy("day"))


def risk_histogram(loaded: DataFrame, bins: int = 20) -> DataFrame:
    """``bins`` equal-width bins on [0, 1] (1.0 falls in the last bin)."""
    b = F.least(F.floor(F.col("risk_score") * bins), F.lit(bins - 1)).cast("int")
    return (loaded.where(F.col("risk_score").isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("alerts"))
            .select("bin", (F.col("bin") / F.lit(float(bins))).alias("lower"),
                    ((F.col("bin") + 1) / F.lit(float(bins))).alias("upper"), "alerts")
            .orderBy("bin"))


def outcome_counts(loaded: DataFrame) -> DataFrame:
    """Analyst outcomes with missing ones as 'unreviewed'."""
    return (loaded.groupBy(F.coalesce("analyst_outcome", F.lit("unreviewed")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "outcome"))


def risk_by_payment_format(flat: DataFrame) -> DataFrame:
    """Alert count and mean risk per payment format, most alerts first."""
    return (flat.where(F.col("payment_format").isNotNull()).groupBy("payment_format")
            .agg(F.count("alert_id").alias("alerts"), F.avg("risk_score").alias("average_risk"))
            .orderBy(F.col("alerts").desc(), "payment_format"))


def alert_explorer(flat: DataFrame, min_risk: float = 0.0, outcome: str = "All", from_bank: str = "All") -> DataFrame:
    """Minimum risk AND outcome (All / Unreviewed / value) AND sender bank."""
    out = flat.where(F.col("risk_score") >= F.lit(float(min_risk)))
    if outcome == "Unreviewed":
        out = out.where(F.col("analyst_outcome").isNull())
    elif outcome != "All":
        out = out.where(F.col("analyst_outcome") == outcome)
    if from_bank != "All":
        out = out.where(F.col("from_bank").cast("string") == from_bank)
    return out


def alert_search(flat: DataFrame, search: str) -> DataFrame:
    """Case-insensitive literal substring in any of four id columns."""
    if not search:
        return flat
    needle = F.lit(search.lower())
    cond = F.lit(False)
    for c in SEARCH_COLUMNS:
        cond = cond | F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), needle)
    return flat.where(cond)


def explorer_options(flat: DataFrame) -> DataFrame:
    """Sorted distinct outcomes and sender banks as (option, value)."""
    o = flat.select(F.lit("analyst_outcome").alias("option"), F.col("analyst_outcome").cast("string").alias("value"))
    b = flat.select(F.lit("from_bank").alias("option"), F.col("from_bank").cast("string").alias("value"))
    return o.union(b).where(F.col("value").isNotNull()).distinct().orderBy("option", "value")


def export_alerts(flat: DataFrame, path: str) -> str:
    """The 12 display columns as CSV."""
    flat.select(*EXPORT_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
    return path


def alert_detail(flat: DataFrame, alert_id) -> DataFrame:
    """One alert with its payload fields."""
    target = alert_id if not isinstance(alert_id, str) else F.lit(alert_id)
    return flat.where(F.col("alert_id") == target)
