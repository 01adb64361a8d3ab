"""Event views over the given tables.

``dense``: the events table with time compressed 600-fold and cut to whole
seconds, so that windows of seconds hold several rows and ties occur.
``sparse``: the same with times as they are.  ``nation_orders``: orders keyed by
nation, a few large accounts with many equal times and an unknown code.
``scored``: dense rows with a score derived from the event's value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.models.forest import with_labels

DESCR_OF_TYPE = {
    "click": "ATM",
    "view": "GIRO",
    "purchase": "PayNow",
    "signup": "Fund Transfer",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _events_as(events: DataFrame, ts: Column, amount: Column) -> DataFrame:
    descr = F.col("event_type")
    for source, target in DESCR_OF_TYPE.items():
        descr = F.when(F.col("event_type") == source, F.lit(target)).otherwise(descr)
    return events.select(
        F.col("event_id").alias(schema.SEQ),
        (F.lit(1_000_000_000_000_000_000) + F.col("user_id"))
        .cast("string")
        .alias("account_number"),
        ts.alias("posting_timestamp"),
        amount.cast(schema.AMOUNT_TYPE).alias("transaction_ac_amount"),
        descr.alias("descr"),
        F.when(_k() % 2 == 0, "D").otherwise("C").alias("debit_credit_code"),
        F.substring(F.lit("TZMAX"), _k() % 5 + 1, F.lit(1)).alias("input_source"),
        "event_type",
        "value",
    )


def dense_of(events: DataFrame) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    second = F.floor(micros / F.lit(600_000_000)) * 1_000_000
    return _events_as(events, F.timestamp_micros(second), F.floor(F.col("value") / 25) * 25)


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_of(table(spark, sf_dir, "events"))


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _events_as(events, F.col("ts").cast("timestamp"), F.col("value"))


def scored_of(rows: DataFrame) -> DataFrame:
    return with_labels(rows.withColumn("anomaly_score", F.lit(0.25) - F.col("value") / 400))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_of(dense(spark, sf_dir))


def nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    code = (
        F.when(F.col("o_orderstatus") == "O", "D")
        .when(F.col("o_orderstatus") == "F", "C")
        .otherwise("U")
    )
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias(schema.SEQ),
        F.col("c_nationkey").cast("string").alias("account_number"),
        F.timestamp_seconds(day * 20).alias("posting_timestamp"),
        (F.floor(F.col("o_totalprice") / 50000) * 50000)
        .cast(schema.AMOUNT_TYPE)
        .alias("transaction_ac_amount"),
        F.col("o_orderpriority").alias("descr"),
        code.alias("debit_credit_code"),
        F.substring(F.lit("TZMAX"), (F.col("o_orderkey") % 5 + 1).cast("int"), F.lit(1)).alias(
            "input_source"
        ),
    )


def tidy(df: DataFrame) -> DataFrame:
    """Plain result types: whole numbers as bigint, decimals as double."""
    kinds = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint"}
    out = []
    for name, kind in df.dtypes:
        target = "double" if kind.startswith("decimal") else kinds.get(kind)
        out.append(F.col(name).cast(target).alias(name) if target else F.col(name))
    return df.select(*out)
