"""Decision, reason codes and alert ids as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnwatch.schema import HIGH_RISK_FORMATS, MAX_REASONS, REASON_CODES, REQUEST_FIELDS


def decide(score: str = "risk_score", threshold: Column | float = 0.5) -> Column:
    """R1: 'alert' when score >= threshold, else 'allow'."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(F.col(score) >= t, F.lit("alert")).otherwise(F.lit("allow"))


def reason_codes(score: str = "risk_score") -> Column:
    """R2: ordered rule codes; the model-pattern code only when no rule fires
    and the score is at least 0.5; at most five codes."""
    rules = [
        F.col("sender_amount_to_avg") >= 5,
        F.col("receiver_amount_to_avg") >= 5,
        F.col("sender_minutes_since_last") <= 10,
        F.col("cross_currency") != 0,
        F.col("is_round_amount") != 0,
        F.col("sender_prev_tx_count") == 0,
        F.col("payment_format").isin(*HIGH_RISK_FORMATS),
    ]
    fired = F.array_compact(F.array(*[F.when(rule, F.lit(code)) for rule, code in zip(rules, REASON_CODES)]))
    fallback = F.array(F.lit(REASON_CODES[-1]))
    codes = F.when((F.size(fired) == 0) & (F.col(score) >= 0.5), fallback).otherwise(fired)
    return F.slice(codes, 1, MAX_REASONS)


def alert_digest(model_version: Column, fields: list[str] | None = None) -> Column:
    """Digest (64 hex digits) of the model version and every request field: the key of an
    alert.  A replayed request gets the same one, and two requests that only share a
    transaction id do not."""
    fields = fields or REQUEST_FIELDS
    parts = [model_version.cast("string")] + [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def alert_id(decision: Column, model_version: Column, fields: list[str] | None = None) -> Column:
    """R3: 'ALT-' + the digest's first 16 digits for alerts, null otherwise.  For display;
    uniqueness is by ``alert_digest``."""
    digest = alert_digest(model_version, fields)
    return F.when(decision == F.lit("alert"), F.concat(F.lit("ALT-"), F.substring(digest, 1, 16)))
