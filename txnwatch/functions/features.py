"""Row-local feature expressions (pure Column builders, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount_log1p(paid: str = "amount_paid") -> Column:
    return F.log1p(F.greatest(F.col(paid), F.lit(0.0)))


def amount_ratio(received: str = "amount_received", paid: str = "amount_paid") -> Column:
    # received / max(paid, 1e-9); a missing received amount gives 1.0
    return F.coalesce(F.col(received) / F.greatest(F.col(paid), F.lit(1e-9)), F.lit(1.0))


def hour(ts: str = "timestamp") -> Column:
    return F.hour(ts).cast("int")


def day_of_week(ts: str = "timestamp") -> Column:
    # Monday = 0 (``weekday``), not Sunday = 1 (``dayofweek``)
    return F.weekday(ts).cast("int")


def is_weekend(ts: str = "timestamp") -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_night(ts: str = "timestamp") -> Column:
    return (F.hour(ts) <= 5).cast("int")


def cross_bank(a: str = "from_bank", b: str = "to_bank") -> Column:
    # null-safe: a null bank differs from a present one, two nulls are equal
    return (~F.col(a).eqNullSafe(F.col(b))).cast("int")


def cross_currency(a: str = "payment_currency", b: str = "receiving_currency") -> Column:
    return (~F.col(a).eqNullSafe(F.col(b))).cast("int")


def is_round_amount(paid: str = "amount_paid") -> Column:
    # one-sided: paid mod 1000 within 1.0 above a multiple of 1000
    return (F.abs(F.col(paid) % F.lit(1000.0)) <= 1.0).cast("int")


def row_features() -> dict[str, Column]:
    """F1..F9 in model order."""
    return {
        "amount_log1p": amount_log1p(),
        "amount_ratio": amount_ratio(),
        "hour": hour(),
        "day_of_week": day_of_week(),
        "is_weekend": is_weekend(),
        "is_night": is_night(),
        "cross_bank": cross_bank(),
        "cross_currency": cross_currency(),
        "is_round_amount": is_round_amount(),
    }


def minutes_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60_000_000.0)


def minutes_since_last(ts: Column, prev_ts: Column) -> Column:
    """Minutes since the previous transaction; none -> 1e6; clipped to [0, 1e6]."""
    m = F.coalesce(minutes_between(ts, prev_ts), F.lit(1_000_000.0))
    return F.least(F.greatest(m, F.lit(0.0)), F.lit(1_000_000.0))


def prior_average(total: Column, count: Column) -> Column:
    return F.coalesce(total / F.nullif(count.cast("double"), F.lit(0.0)), F.lit(0.0))


def amount_to_average(paid: Column, avg: Column) -> Column:
    return F.least(F.coalesce(paid / F.nullif(avg, F.lit(0.0)), F.lit(1.0)), F.lit(1000.0))
