"""Batch and stream sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from acctpulse.functions import scalar


# Spark's own format for text files keeps milliseconds only.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def default_output(path: str) -> str:
    """Where scored rows go if no output is named: ``scored_`` before the file name."""
    folder, slash, name = path.rstrip("/").rpartition("/")
    return f"{folder}{slash}scored_{name}"


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which CSV cannot hold otherwise."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def guard_first_column(df: DataFrame) -> DataFrame:
    first = df.columns[0]
    return df.withColumn(first, scalar.text_guard(F.col(first)))


def write_scored_csv(df: DataFrame, path: str, guard: bool = True) -> None:
    """CSV parts with header; the key column is protected from spreadsheets."""
    out = flatten_for_csv(df)
    out = guard_first_column(out) if guard else out
    options = {"header": True, "escape": '"', "timestampFormat": TIMESTAMP_TEXT}
    out.write.mode("overwrite").options(**options).csv(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def alerts(scored: DataFrame) -> DataFrame:
    """Flagged rows as JSON text, keyed by account."""
    flagged = scored.where("is_anomaly")
    return flagged.select(
        F.col("account_number").alias("key"), scalar.result_json("*").alias("value")
    )


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Append a stream to files; ``available_now`` drains the source and stops."""
    writer = (
        df.writeStream.format(file_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def write_alerts(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Alert stream as lines of JSON."""
    return write_stream(alerts(scored).select("value"), path, checkpoint, "text")
