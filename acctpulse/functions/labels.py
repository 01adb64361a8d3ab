"""Reader-facing feature texts."""

# Display texts that must read the same as before.
FEATURE_DESCRIPTIONS = {
    "amount_zscore_account": "How far this amount is from the account's usual amount pattern (z-score).",
    "same_amount_frequency": "How often this exact amount has appeared before for this account.",
    "cumulative_amount_10min": "Total transacted amount within the last 10 minutes.",
    "descr_encoded": "Encoded transaction description/type used by the model.",
    "debit_credit_code_encoded": "Encoded debit/credit indicator used by the model.",
    "input_source_encoded": "Encoded transaction channel (for example teller vs online).",
    "hour_of_day": "Hour when the transaction occurred (0-23).",
    "is_business_hours": "Whether the transaction was during business hours on weekdays.",
    "txn_count_1s": "Number of account transactions in the past 1 second.",
    "txn_count_10s": "Number of account transactions in the past 10 seconds.",
    "txn_count_30s": "Number of account transactions in the past 30 seconds.",
    "time_since_last_txn": "Seconds since the previous transaction for this account.",
    "time_since_last_txn_same_amount": "Seconds since the last transaction with the same amount.",
    "time_since_last_txn_same_descr": "Seconds since the last transaction with the same description.",
    "avg_time_gap_last_5txn": "Average time gap between the last 5 transaction intervals.",
    "min_time_gap_last_10txn": "Smallest time gap among the last 10 transaction intervals.",
    "same_acct_amt_descr_count_10min": "Count of transactions with same account, amount, and description in 10 minutes.",
    "same_acct_amt_count_10min": "Count of transactions with same account and amount in 10 minutes.",
    "is_exact_duplicate_10min": "Flag indicating repeated identical amount+description in 10 minutes.",
    "duplicate_streak": "Current streak length of repeated duplicate-like transactions.",
    "dc_sign": "Transaction direction represented as numeric sign (debit/credit).",
    "dc_alternation_count_10txn": "How many debit/credit flips occurred in the last 10 transactions.",
    "reversal_count_10min": "Count of potential reversal-like transactions in the last 10 minutes.",
}
