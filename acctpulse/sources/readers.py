"""Batch and stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctpulse import schema
from acctpulse.operators.reports import arrival_index


#: Names, per row, of the columns whose text did not fit their type.
BAD_FIELDS = "bad_fields"


def read_csv(spark: SparkSession, path: str, columns: T.StructType = schema.RAW_SCHEMA) -> DataFrame:
    """CSV with header; types are given, so the key stays text and nothing is inferred.

    Columns are found by their header names, in any order; a file may lack some (null) and have
    others (left out).  Files of one folder must share a header, or the read fails.  Text
    that does not fit its type is null, and ``bad_fields`` names the column.
    """
    reader = spark.read.option("header", True)
    names = reader.csv(path).columns
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = reader.option("enforceSchema", False).schema(texts).csv(path)
    typed = {
        f.name: F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in names
        else F.lit(None).cast(f.dataType)
        for f in columns.fields
    }
    misfits = [
        F.when(F.col(f"`{n}`").isNotNull() & c.isNull(), F.lit(n))
        for n, c in typed.items()
        if n in names
    ]
    bad = F.array_compact(F.array(*misfits)) if misfits else F.array().cast("array<string>")
    return rows.select(*[c.alias(n) for n, c in typed.items()], bad.alias(BAD_FIELDS))


def with_sequence(df: DataFrame, column: str | None = None) -> DataFrame:
    """Adds ``seq``: the numbers in ``column``, or the rows' order in their files.

    Files go by name; inside a file rows keep their order.  Numbers come from a range sort and one
    count per range, so no task sees all rows.
    """
    if column is not None:
        return df.withColumn(schema.SEQ, F.col(column).try_cast("bigint"))
    placed = df.withColumn(
        "_order",
        F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()),
    )
    return arrival_index(placed, "_order", schema.SEQ).drop("_order")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_events(spark: SparkSession, path: str, **options) -> DataFrame:
    """Events by file suffix; anything else is refused."""
    if path.endswith(".csv"):
        return read_csv(spark, path, **options)
    if path.endswith((".parquet", ".pq")):
        return read_parquet(spark, path)
    raise ValueError(f"Unsupported file format: {path}")


def jdbc_options(
    url: str,
    user: str,
    password: str,
    query: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    driver: str | None = None,
) -> dict[str, str]:
    """Options of a JDBC read.

    A plain query is read by one task.  Given a partition column with bounds the
    query becomes a derived table and is read by ``partitions`` tasks.
    """
    if (query is None) == (table is None):
        raise ValueError("give either query or table")
    options = {"url": url, "user": user, "password": password, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if partition_column is None:
        return {**options, **({"query": query} if query else {"dbtable": table})}
    if None in (lower_bound, upper_bound, partitions):
        raise ValueError("a partitioned read needs lower_bound, upper_bound and partitions")
    return {
        **options,
        "dbtable": table or f"({query}) AS source_rows",
        "partitionColumn": partition_column,
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """Load from a database; credentials come from the caller and are stored nowhere."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def stream_files(
    spark: SparkSession,
    path: str,
    columns: T.StructType = schema.EVENT_SCHEMA,
    file_format: str = "parquet",
    max_files: int = 100,
    **options: str,
) -> DataFrame:
    """File stream; ``max_files`` bounds what one micro-batch may hold."""
    reader = spark.readStream.format(file_format).schema(columns)
    return reader.option("maxFilesPerTrigger", max_files).options(**options).load(path)


def kafka_options(servers: str, topic: str, max_offsets: int = 1_000_000) -> dict[str, str]:
    """Options of a Kafka stream (the connector jar has to be on the class path)."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(max_offsets),
    }


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, columns: T.StructType = schema.EVENT_SCHEMA
) -> DataFrame:
    """Events sent as JSON."""
    from pyspark.sql import functions as F

    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic)).load()
    parsed = F.from_json(F.col("value").cast("string"), columns)
    return raw.select(parsed.alias("event")).select("event.*")
