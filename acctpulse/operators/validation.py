"""Row checks, rejects and small projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.functions import scalar


def require_columns(df: DataFrame, required: Sequence[str] = schema.REQUIRED_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"the events lack these columns: {missing}")
    return df


def reject_reason(extra: Mapping[str, Column] | None = None) -> Column:
    """First rule a row breaks, null for a valid row.  Works on batch and stream."""
    reason = F.lit(None).cast("string")
    rules = {
        **{f"missing {c}": F.col(c).isNull() for c in schema.REQUIRED_COLUMNS},
        "negative amount": F.col("transaction_ac_amount") < 0,
        "bad debit_credit_code": ~F.col("debit_credit_code").rlike("^[DC]$"),
        **(extra or {}),
    }
    for name, broken in reversed(rules.items()):
        reason = F.when(broken, F.lit(name)).otherwise(reason)
    return reason


def with_reject_reason(df: DataFrame) -> DataFrame:
    return require_columns(df).withColumn("reject_reason", reject_reason())


def validate_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reason``); no row is lost."""
    return split_checked(with_reject_reason(df))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for rows that have their ``reject_reason`` already."""
    valid = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, checked.where(F.col("reject_reason").isNotNull())


def parse_timestamps(df: DataFrame, strict: bool = True, name: str = "posting_timestamp"):
    """Parse mixed-precision text; ``strict`` fails with a sample of what does not parse."""
    if strict:
        sample = [r[name] for r in bad_timestamp_sample(df, name).collect()]
        if sample:
            raise ValueError(f"{name} holds text that is no time, such as {sample}")
    return df.withColumn(name, scalar.parse_mixed_ts(F.col(name)))


def bad_timestamp_sample(df: DataFrame, name: str = "posting_timestamp", n: int = 5) -> DataFrame:
    """The first ``n`` texts by seq that are present but do not parse."""
    bad = F.col(name).isNotNull() & scalar.parse_mixed_ts(F.col(name)).isNull()
    return df.where(bad).orderBy(schema.SEQ).select(schema.SEQ, name).limit(n)


def fill_missing(df: DataFrame, columns: Sequence[str], infinities: bool = False) -> DataFrame:
    return df.withColumns({c: scalar.finite_or_zero(F.col(c), infinities) for c in columns})


def ordered_vector(columns: Sequence[str]) -> Column:
    """Features as doubles in configured order."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def select_cast_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Named columns only, account key as text.

    Of columns that share a name the last one wins, as after a query that adds
    a cast copy of the key to ``t.*``.
    """
    last = {name: i for i, name in enumerate(df.columns)}
    unique = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return unique.select(
        *[
            F.col(f"_{last[c]}").cast("string").alias(c)
            if c == "account_number"
            else F.col(f"_{last[c]}").alias(c)
            for c in columns
        ]
    )


def add_constant_label(df: DataFrame, name: str = "is_anomaly", value: int = 0) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def union_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both; a column that one side lacks is null there."""
    return left.unionByName(right, allowMissingColumns=True)
