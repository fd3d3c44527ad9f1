"""Column lists, types and fixed values of the transaction data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# ---------------------------------------------------------------------------
CANONICAL_COLUMNS = [
    "timestamp",
    "from_bank",
    "from_account",
    "to_bank",
    "to_account",
    "amount_received",
    "receiving_currency",
    "amount_paid",
    "payment_currency",
    "payment_format",
    "is_laundering",
]

# External column name -> canonical name.  "Account2"/"Account4" are the names
# Spark's CSV reader gives the repeated "Account" header (pandas says "Account.1").
ALIASES = {
    "Timestamp": "timestamp",
    "From Bank": "from_bank",
    "Account": "from_account",
    "To Bank": "to_bank",
    "Account.1": "to_account",
    "Amount Received": "amount_received",
    "Receiving Currency": "receiving_currency",
    "Amount Paid": "amount_paid",
    "Payment Currency": "payment_currency",
    "Payment Format": "payment_format",
    "Is Laundering": "is_laundering",
    # Spark-only spellings of the duplicated header
    "Account2": "from_account",
    "Account4": "to_account",
}

CATEGORICAL_FEATURES = ["payment_format", "payment_currency", "receiving_currency"]
NUMERIC_FEATURES = [
    "amount_paid",
    "amount_received",
    "amount_log1p",
    "amount_ratio",
    "hour",
    "day_of_week",
    "is_weekend",
    "is_night",
    "cross_bank",
    "cross_currency",
    "is_round_amount",
    "sender_prev_tx_count",
    "receiver_prev_tx_count",
    "sender_prev_avg_amount",
    "receiver_prev_avg_amount",
    "sender_amount_to_avg",
    "receiver_amount_to_avg",
    "sender_minutes_since_last",
    "receiver_minutes_since_last",
    "pair_prev_count",
    "sender_unique_counterparties",
    "receiver_unique_counterparties",
]
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

REASON_CODES = [
    "AMOUNT_ABOVE_SENDER_BASELINE",
    "AMOUNT_ABOVE_RECEIVER_BASELINE",
    "RAPID_REPEAT_SENDER_ACTIVITY",
    "CROSS_CURRENCY_TRANSFER",
    "ROUND_AMOUNT_PATTERN",
    "NEW_SENDER",
    "HIGHER_RISK_PAYMENT_FORMAT",
    "MULTIVARIATE_MODEL_PATTERN",
]
HIGH_RISK_FORMATS = ["Cash", "Wire"]
MAX_REASONS = 5

FEEDBACK_OUTCOMES = ["confirmed_laundering", "false_positive", "needs_review"]
MAX_NOTES_LENGTH = 2000

RISK_SCORE_BUCKETS = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]

DRIFT_NUMERIC = [
    "amount_paid",
    "amount_log1p",
    "sender_amount_to_avg",
    "sender_minutes_since_last",
    "pair_prev_count",
]
DRIFT_CATEGORICAL = ["payment_format", "payment_currency", "receiving_currency"]

GRAPH_SCORE_COLUMNS = [
    "in_degree",
    "out_degree",
    "in_amount",
    "out_amount",
    "pagerank",
    "reciprocal_counterparties",
]

PAYLOAD_FIELDS = [
    "timestamp",
    "from_bank",
    "from_account",
    "to_bank",
    "to_account",
    "amount_paid",
    "payment_currency",
    "amount_received",
    "receiving_currency",
    "payment_format",
]
# ---------------------------------------------------------------------------

REQUEST_FIELDS = [
    "transaction_id",
    "timestamp",
    "from_bank",
    "from_account",
    "to_bank",
    "to_account",
    "amount_received",
    "receiving_currency",
    "amount_paid",
    "payment_currency",
    "payment_format",
]

TXN_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("from_bank", T.StringType()),
    T.StructField("from_account", T.StringType()),
    T.StructField("to_bank", T.StringType()),
    T.StructField("to_account", T.StringType()),
    T.StructField("amount_received", T.DoubleType()),
    T.StructField("receiving_currency", T.StringType()),
    T.StructField("amount_paid", T.DoubleType()),
    T.StructField("payment_currency", T.StringType()),
    T.StructField("payment_format", T.StringType()),
    T.StructField("is_laundering", T.IntegerType()),
])

# Columns of the alert search and the alert export.
SEARCH_COLUMNS = ["transaction_id", "from_account", "to_account", "alert_id"]

EXPORT_COLUMNS = ["created_at", "alert_id", "transaction_id", "risk_score", "threshold", "amount_paid",
                  "payment_currency", "payment_format", "from_bank", "to_bank", "reason_text", "analyst_outcome"]
