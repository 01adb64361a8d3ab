"""Row keys, written tables and running sums that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctpulse.session import scratch_path

#: Internal columns; inputs may hold columns of any other name.
FILE, ROW, PART = "_acct_file", "_acct_row", "_acct_part"
KEY = [FILE, ROW]


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hands texts to Python in batches of ``TEXT_ROWS`` rows; the usual 10,000 are tens of MB."""
    usual = spark.conf.get(ARROW_ROWS)
    if 0 < int(usual) <= TEXT_ROWS:
        yield
        return
    spark.conf.set(ARROW_ROWS, TEXT_ROWS)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, usual)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as a query has ended; otherwise they stay until the driver collects garbage."""
    usual = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, usual)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` once below the shared folder and reads it back.

    Cuts the lineage, survives lost executors, and costs less disk than a checkpoint.
    """
    path = scratch_path(df.sparkSession, label)
    with small_batches(df.sparkSession), shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame) -> DataFrame:
    """Adds a key that is unique per row and the same in every scan.

    Rows of a file are named by file and position, which needs no copy. A table that does not
    come straight from files is written first.
    """
    if "_metadata" not in df.columns:
        try:
            return df.withColumns(
                {FILE: F.xxhash64("_metadata.file_path"), ROW: F.col("_metadata.row_index")}
            )
        except AnalysisException:
            pass
    numbered = df.withColumns({FILE: F.lit(0).cast("bigint"), ROW: F.monotonically_increasing_id()})
    return keep(numbered, "rows")


def pick_rows(docs: DataFrame, keyed: DataFrame, verdict: DataFrame, how: str) -> DataFrame:
    """Rows of ``keyed`` that join ``verdict`` on the row key, with the columns of ``docs``."""
    return keyed.join(verdict, KEY, how).select(*[F.col(f"`{c}`") for c in docs.columns])


def running_sums(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], sums: dict[str, Column]
) -> DataFrame:
    """Adds for each of ``sums`` the total over the group's rows up to and including this one.

    ``order`` must end in a unique key. Groups may be of any size: rows are dealt by
    range and written, sums run inside a range, and each range starts from
    the totals of those before it (one row per range and group).
    """
    cols = [f"_acct_s{i}" for i in range(len(sums))]
    keys = [f"_acct_o{i}" for i in range(len(order))]
    fixed = df.withColumns(
        dict(zip(cols, sums.values(), strict=True)) | dict(zip(keys, order, strict=True))
    )
    dealt = keep(
        fixed.repartitionByRange(*groups, *keys).withColumn(PART, F.spark_partition_id()), "ranges"
    )
    totals = dealt.groupBy(PART, *groups).agg(*[F.sum(c).alias(f"{c}_all") for c in cols])
    before = Window.partitionBy(*groups).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_acct_g{i}" for i in range(len(groups))]
    starts = totals.select(
        F.col(PART),
        *[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)],
        *[F.coalesce(F.sum(f"{c}_all").over(before), F.lit(0)).alias(f"{c}_0") for c in cols],
    )
    inside = Window.partitionBy(PART, *groups).orderBy(*keys)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumns({c: F.sum(c).over(inside) for c in cols}).alias("rows")
    match = F.col(f"rows.{PART}") == F.col(f"starts.{PART}")
    for g, n in zip(groups, names, strict=True):
        match &= F.col(f"rows.{g}").eqNullSafe(F.col(f"starts.{n}"))
    joined = summed.join(starts.alias("starts"), match)
    return joined.select(
        *[F.col(f"rows.{c}") for c in df.columns],
        *[(F.col(c) + F.col(f"{c}_0")).alias(n) for c, n in zip(cols, sums, strict=True)],
    )


#: A key with more than this part of all rows is joined without a shuffle of its rows.
HOT_PART = 1000


def join_facts(rows: DataFrame, facts: DataFrame, key: str, weight: str) -> DataFrame:
    """Left join of ``rows`` to ``facts``, which has one row a ``key`` and that key's number of rows.

    Keys that hold more than 1 / ``HOT_PART`` of all rows are fewer than ``HOT_PART`` by counting, so
    their facts are broadcast; the others are shuffled, and none of them fills a task.
    Rows whose key is null get null facts and are not shuffled. ``facts`` is read several times: keep it first.
    """
    total = facts.agg(F.sum(weight)).first()[0] or 0
    least = total // HOT_PART
    hot = facts.where(F.col(weight) > least)
    cold = facts.where(F.col(weight) <= least)
    known = rows.where(F.col(key).isNotNull())
    names = [*rows.columns, *[c for c in facts.columns if c != key]]
    often = known.join(F.broadcast(hot), key).select(*names)
    rest = known.join(F.broadcast(hot.select(key)), key, "left_anti")
    rarely = rest.join(cold, key, "left").select(*names)
    null = rows.where(F.col(key).isNull())
    return often.unionByName(rarely).unionByName(null, allowMissingColumns=True)
