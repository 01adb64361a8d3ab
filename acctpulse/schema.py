"""Input schema, feature order and code tables."""

from __future__ import annotations

from pyspark.sql import types as T

# They must equal the source system's for results to agree.
REQUIRED_COLUMNS = [
    "account_number",
    "posting_timestamp",
    "transaction_ac_amount",
    "descr",
    "debit_credit_code",
    "input_source",
]
OPTIONAL_COLUMNS = [
    "business_date",
    "account_type",
    "status",
    "bank_code",
    "posting_mode",
    "auxiliary_transaction_code",
    "transaction_ac_currency",
]
FEATURE_COLUMNS = [
    "txn_count_1s",
    "txn_count_10s",
    "txn_count_30s",
    "time_since_last_txn",
    "time_since_last_txn_same_amount",
    "time_since_last_txn_same_descr",
    "avg_time_gap_last_5txn",
    "min_time_gap_last_10txn",
    "same_acct_amt_descr_count_10min",
    "same_acct_amt_count_10min",
    "is_exact_duplicate_10min",
    "duplicate_streak",
    "dc_sign",
    "dc_alternation_count_10txn",
    "reversal_count_10min",
    "amount_zscore_account",
    "same_amount_frequency",
    "cumulative_amount_10min",
    "descr_encoded",
    "debit_credit_code_encoded",
    "input_source_encoded",
    "hour_of_day",
    "is_business_hours",
]
VELOCITY_WINDOWS = {"txn_count_1s": 1, "txn_count_10s": 10, "txn_count_30s": 30}
DESCR_CODES = {
    "ATM": 0,
    "Charges": 1,
    "Fund Transfer": 2,
    "GIRO": 3,
    "PayNow": 4,
    "Payment to IBT": 5,
}
DEBIT_CREDIT_CODES = {"C": 0, "D": 1}
INPUT_SOURCE_CODES = {"A": 0, "M": 1, "T": 2, "Z": 3}
CHANNEL_LABELS = {"T": "Teller", "Z": "Online"}
LOOKBACK_SECONDS = 600
HISTORY_CAP = 1000
RETENTION_SECONDS = 600
# End of fixed values.

# Tie-break column: orders rows of one account that carry equal timestamps.
SEQ = "seq"

AMOUNT_TYPE = T.DecimalType(18, 2)

# Raw files keep the timestamp as text because second- and microsecond-precision
# values are mixed; the account key is text so that no reader turns it into a double.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(SEQ, T.LongType()),
        T.StructField("account_number", T.StringType()),
        T.StructField("posting_timestamp", T.StringType()),
        T.StructField("transaction_ac_amount", AMOUNT_TYPE),
        T.StructField("descr", T.StringType()),
        T.StructField("debit_credit_code", T.StringType()),
        T.StructField("input_source", T.StringType()),
    ]
    + [T.StructField(c, T.StringType()) for c in OPTIONAL_COLUMNS]
)

# The same events once the timestamp is parsed; streams start from this form.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampType() if f.name == "posting_timestamp" else f.dataType)
        for f in RAW_SCHEMA.fields
    ]
)
