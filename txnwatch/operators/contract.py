"""Contract operators: projection, coercion, validation and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions import contract as cx
from txnwatch.schema import ALIASES, CANONICAL_COLUMNS

IDENTIFIERS = ["from_bank", "to_bank", "from_account", "to_account"]
CATEGORIES = ["receiving_currency", "payment_currency", "payment_format"]
AMOUNTS = ["amount_received", "amount_paid"]


def normalize_columns(df: DataFrame, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Rename by the alias map, fail listing every missing column, project
    to the canonical order (``keep`` columns such as ``seq`` pass through)."""
    mapping: dict[str, str] = {}
    for c in df.columns:
        target = ALIASES.get(c, c)
        if target in mapping.values() and target in CANONICAL_COLUMNS:
            other = [k for k, v in mapping.items() if v == target][0]
            raise ValueError(f"Columns {other!r} and {c!r} both map to {target!r}")
        mapping[c] = target
    present = set(mapping.values())
    missing = [c for c in CANONICAL_COLUMNS if c not in present]
    if missing:
        raise ValueError("no column for " + ", ".join(missing))
    by_target = {v: k for k, v in mapping.items()}
    passthrough = [F.col(f"`{k}`") for k in keep if k in df.columns and k not in CANONICAL_COLUMNS]
    return df.select(*passthrough, *[F.col(f"`{by_target[c]}`").alias(c) for c in CANONICAL_COLUMNS])


def coerce_types(df: DataFrame) -> DataFrame:
    """C2-C6 on normalized columns."""
    n = normalize_columns(df)
    exprs = {
        "timestamp": cx.parse_timestamp(F.col("timestamp")),
        **{c: cx.to_double(F.col(c)) for c in AMOUNTS},
        **{c: F.col(c).cast("string") for c in IDENTIFIERS},
        **{c: cx.fill_unknown(F.col(c)) for c in CATEGORIES},
        "is_laundering": cx.to_label(F.col("is_laundering")),
    }
    keep = [c for c in n.columns if c not in CANONICAL_COLUMNS]
    return n.select(*keep, *[exprs[c].alias(c) for c in CANONICAL_COLUMNS])


def distinct_rows(typed: DataFrame, order_col: str = "seq") -> DataFrame:
    """One row per distinct 11 columns, with its first ``seq`` and its count ``_n``;
    partial aggregation collapses duplicates before the shuffle."""
    first = [F.min(order_col).alias(order_col)] if order_col in typed.columns else []
    return typed.groupBy(*CANONICAL_COLUMNS).agg(F.count(F.lit(1)).alias("_n"), *first)


def _report(groups: DataFrame) -> DataFrame:
    n = F.col("_n")

    def rows_where(cond) -> F.Column:
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("long")
    total = F.sum(n)
    return groups.agg(
        F.coalesce(total, F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(n - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
        rows_where(F.col("timestamp").isNull()).alias("invalid_timestamps"),
        rows_where((F.col("amount_paid") < 0) | (F.col("amount_received") < 0)).alias("negative_amounts"),
        rows_where(F.col("from_account").isNull() | F.col("to_account").isNull()).alias("missing_accounts"),
        F.coalesce(F.sum(F.col("is_laundering") * n) / F.nullif(total, F.lit(0)), F.lit(0.0)).cast("double").alias("label_rate"),
    )


def quality_report(typed: DataFrame) -> DataFrame:
    """One-row report over typed, unfiltered rows."""
    return _report(distinct_rows(typed))


def drop_invalid(typed: DataFrame) -> DataFrame:
    """Drop rows missing time, accounts or amounts; keep amounts >= 0.
    Banks are not required."""
    required = ["timestamp", "from_account", "to_account", "amount_paid", "amount_received"]
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return typed.where(cond & (F.col("amount_paid") >= 0) & (F.col("amount_received") >= 0))


def dedupe(df: DataFrame, order_col: str = "seq") -> DataFrame:
    """Exact duplicates over the 11 columns (nulls equal) keep their first row."""
    return distinct_rows(df, order_col).select(order_col, *CANONICAL_COLUMNS)


def order_by_time(df: DataFrame) -> DataFrame:
    """Stable time order: ties keep source order through ``seq``."""
    return df.orderBy("timestamp", "seq")


def clean(raw: DataFrame, write_once: bool = False) -> tuple[DataFrame, DataFrame]:
    """C11: (typed rows without invalid ones and duplicates, report).  Both come from the
    same grouped table, which ``write_once`` writes to the checkpoint folder so that the
    source is read and shuffled once for the two.  The cleaned table is unsorted: every
    consumer orders by (timestamp, seq) itself."""
    groups = distinct_rows(coerce_types(raw))
    groups = groups.checkpoint() if write_once else groups
    return drop_invalid(groups).select("seq", *CANONICAL_COLUMNS), _report(groups)


def validate_requests(requests: DataFrame) -> DataFrame:
    """Add ``errors`` (broken rule names) and ``valid``."""
    return requests.withColumn("errors", cx.request_errors()).withColumn("valid", F.size("errors") == 0)


def upper_currency(requests: DataFrame) -> DataFrame:
    """Upper-case both currencies (online path)."""
    return requests.withColumn("receiving_currency", F.upper("receiving_currency")) \
        .withColumn("payment_currency", F.upper("payment_currency"))


def validate_feedback(feedback: DataFrame) -> DataFrame:
    """C14: add ``errors`` and ``valid`` to feedback rows."""
    return feedback.withColumn("errors", cx.feedback_errors()).withColumn("valid", F.size("errors") == 0)
