"""Type coercion and validation expressions of the transaction contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnwatch.schema import FEEDBACK_OUTCOMES, MAX_NOTES_LENGTH

# Tokens the pandas CSV reader turns into missing values.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Timestamp layouts tried in order; the last attempt is Spark's ISO-8601 parser.
TIMESTAMP_FORMATS = ["yyyy/MM/dd HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm",
                     "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm"]


def na_to_null(c: Column) -> Column:
    return F.when(c.isin(*NA_TOKENS), F.lit(None)).otherwise(c)


def parse_timestamp(c: Column) -> Column:
    """Explicit layouts per row (a bad value gives null, never an error)."""
    s = c.cast("string")
    attempts = [F.try_to_timestamp(s, F.lit(fmt)) for fmt in TIMESTAMP_FORMATS]
    return F.coalesce(*attempts, F.try_to_timestamp(s))


def to_double(c: Column) -> Column:
    """Numeric or null; NaN is missing, as in pandas."""
    d = c.cast("string").try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def to_label(c: Column) -> Column:
    """Numeric label truncated to int; missing or bad -> 0."""
    return F.coalesce(to_double(c).try_cast("int"), F.lit(0))


def fill_unknown(c: Column) -> Column:
    """Missing category -> 'UNKNOWN'."""
    return F.coalesce(c.cast("string"), F.lit("UNKNOWN"))


def _len_between(name: str, lo: int, hi: int) -> tuple[Column, str]:
    n = F.length(F.col(name))
    return (F.col(name).isNull() | (n < lo) | (n > hi), f"{name}:length_{lo}_{hi}")


def _not_amount(name: str) -> Column:
    """Missing, not a number, or negative."""
    c = F.col(name)
    return c.isNull() | F.isnan(c.cast("double")) | (c < 0)


def request_errors(ts_col: str = "timestamp") -> Column:
    """Names of the broken request rules, empty array when valid."""
    rules = [
        _len_between("transaction_id", 1, 128),
        (parse_timestamp(F.col(ts_col)).isNull(), "timestamp:invalid"),
        _len_between("from_bank", 1, 64),
        _len_between("from_account", 1, 128),
        _len_between("to_bank", 1, 64),
        _len_between("to_account", 1, 128),
        (_not_amount("amount_received"), "amount_received:ge_0"),
        _len_between("receiving_currency", 3, 64),
        (_not_amount("amount_paid"), "amount_paid:ge_0"),
        _len_between("payment_currency", 3, 64),
        _len_between("payment_format", 1, 64),
    ]
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in rules]))


def feedback_errors() -> Column:
    """C14: outcome in the three allowed values; notes null or <= 2000 chars."""
    return F.array_compact(F.array(
        F.when(~F.coalesce(F.col("outcome").isin(*FEEDBACK_OUTCOMES), F.lit(False)), F.lit("outcome:invalid")),
        F.when(F.col("notes").isNotNull() & (F.length("notes") > MAX_NOTES_LENGTH), F.lit("notes:too_long")),
    ))
