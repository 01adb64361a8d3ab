"""Look-ups by account and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.functions import scalar
from acctpulse.operators.features import feature_table
from acctpulse.operators.topn import top_n_per_key
from acctpulse.session import cut_lineage

def newest_first():
    return [F.desc("us"), F.desc(schema.SEQ)]


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("us", scalar.epoch_micros(F.col("posting_timestamp")))


def account_positions(rows: DataFrame, order: Sequence[str], counted: Column) -> DataFrame:
    """Adds ``position``: how many ``counted`` rows of the account lie at or before a row.

    Rows are cut into ranges by (account, ``order``), so no task holds more than
    one range, however large the account.  The ranges are written once because
    their number is used as a key; counts of earlier ranges are then added.
    """
    keys = ["account_number", *order]
    placed = cut_lineage(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()})
    )
    one = F.when(counted, 1)
    parts = placed.groupBy("account_number", "_part").agg(F.count(one).alias("_n"))
    earlier = W.partitionBy("account_number").orderBy("_part")
    earlier = earlier.rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(
        "account_number", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = W.partitionBy("account_number", "_part").orderBy("_pos")
    inside = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        placed.withColumn("_inside", F.count(one).over(inside))
        .join(parts, ["account_number", "_part"])
        .withColumn("position", F.col("_before") + F.col("_inside"))
        .drop("_part", "_pos", "_before", "_inside")
    )


def window_lookup(
    events: DataFrame,
    asks: DataFrame,
    window_seconds: float,
    cap: int = schema.HISTORY_CAP,
) -> DataFrame:
    """Events of an account within ``window_seconds`` up to the asked time.

    ``asks`` has (ask_id, account_number, asked_at).  Only the newest ``cap`` rows
    count, as the history holds no more.  Asks and rows first get their position
    in the account; they then meet on (account, position / cap), where an ask
    looks at two buckets of at most ``cap`` rows, also in a crowded account.
    """
    width = int(round(window_seconds * 1_000_000))
    row, ask = _timed(events), asks.select("ask_id", "account_number", "asked_at")
    ask = ask.withColumn("us", scalar.epoch_micros(F.col("asked_at")))
    names = [c for c in row.columns if c not in ("account_number", "us")]
    tagged = row.select("account_number", "us", F.struct(*names).alias("row")).unionByName(
        ask.select("account_number", "us", F.struct("ask_id", "asked_at").alias("ask")),
        allowMissingColumns=True,
    )
    # An ask comes after the rows of its own instant.
    tagged = tagged.withColumns(
        {"is_ask": F.col("ask").isNotNull(), "tie": F.coalesce(f"row.{schema.SEQ}", "ask.ask_id")}
    )
    placed = account_positions(tagged, ["us", "is_ask", "tie"], ~F.col("is_ask"))
    bucket = F.floor((F.col("position") - 1) / F.lit(cap))
    left = placed.where(~F.col("is_ask")).select(
        "account_number", "us", "position", "row", bucket.alias("bucket")
    )
    right = placed.where("is_ask").select(
        "account_number",
        F.col("us").alias("asked_us"),
        F.col("position").alias("upto"),
        "ask",
        F.explode(F.array_distinct(F.array(bucket - 1, bucket))).alias("bucket"),
    )
    hits = left.join(right, ["account_number", "bucket"]).where(
        (F.col("position") <= F.col("upto"))
        & (F.col("position") > F.col("upto") - cap)
        & (F.col("us") >= F.col("asked_us") - width)
    )
    rank = (F.col("upto") - F.col("position") + 1).alias("newest_rank")
    return hits.select("account_number", "ask.*", "row.*", rank)


def last_n_rows(events: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` rows of every account, with their rank from the newest."""
    return top_n_per_key(
        _timed(events), ["account_number"], newest_first(), n, rank="newest_rank"
    ).drop("us")


def capped_history(events: DataFrame, cap: int = schema.HISTORY_CAP) -> DataFrame:
    """What an account's bounded history holds after all events."""
    return last_n_rows(events, cap).drop("newest_rank")


def _retention_edge(now: str, seconds: float):
    return F.lit(now).cast("timestamp") - F.make_dt_interval(secs=F.lit(seconds))


def retention_filter(
    events: DataFrame, now: str, seconds: float = schema.RETENTION_SECONDS
) -> DataFrame:
    """Rows not older than ``seconds`` before ``now``; a filter the scan can push down."""
    return events.where(F.col("posting_timestamp") >= _retention_edge(now, seconds))


def retention_counts(
    events: DataFrame, now: str, seconds: float = schema.RETENTION_SECONDS
) -> DataFrame:
    """How much a pruning at ``now`` removes and keeps."""
    stale = F.col("posting_timestamp") < _retention_edge(now, seconds)
    per_account = events.groupBy("account_number").agg(
        F.count_if(stale).alias("pruned"), F.count_if(~stale).alias("kept")
    )
    return per_account.agg(
        F.sum("pruned").alias("rows_pruned"),
        F.sum("kept").alias("rows_kept"),
        F.count_if(F.col("kept") == 0).alias("accounts_dropped"),
    )


def state_asof(events: DataFrame, as_of: str | None = None) -> DataFrame:
    """Last known state per account, optionally as of a time.

    Later events are filtered out before anything is computed, so the time reaches the scan;
    of the features only the streak is computed.
    """
    if as_of:
        events = events.where(F.col("posting_timestamp") <= F.lit(as_of).cast("timestamp"))
    features = feature_table(events).select(
        "account_number", schema.SEQ, "posting_timestamp", "transaction_ac_amount", "descr",
        "duplicate_streak",
    )
    order = F.struct("posting_timestamp", schema.SEQ)
    value = F.col("transaction_ac_amount")
    last = F.max_by(F.struct("transaction_ac_amount", "descr", "duplicate_streak"), order)
    return (
        features.groupBy("account_number")
        .agg(
            F.count("*").alias("txn_count"),
            F.sum(value).alias("amount_sum"),
            F.avg(value.cast("double")).alias("amount_mean"),
            F.stddev_pop(value.cast("double")).alias("amount_std"),
            F.max("posting_timestamp").alias("last_posting"),
            last.alias("last"),
        )
        .select(
            "account_number",
            "txn_count",
            "amount_sum",
            "amount_mean",
            "amount_std",
            "last_posting",
            F.col("last.transaction_ac_amount").alias("last_amount"),
            F.col("last.descr").alias("last_descr"),
            F.col("last.duplicate_streak").alias("current_streak"),
        )
    )


STATE_COLUMNS = [
    "txn_count", "amount_sum", "amount_mean", "amount_std", "last_posting", "last_amount",
    "last_descr", "current_streak",
]


def asof_join(rows: DataFrame, asks: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each ask with the columns ``names`` of its account's last row up to the asked time.

    ``rows`` has account_number, posting_timestamp and seq; ``asks`` has account_number, asked_at and any others,
    all of which are kept.  Rows and asks are dealt together by (account, time), rows first where times are
    equal.  Inside a range the last row is carried forward; a range starts with the last row of
    the ranges before it (one row per range and account).  Nothing is joined by time, and an
    account of any size spreads over ranges.  Asks without a time, or before
    their account's first row, get nulls.
    """
    row = rows.select(
        scalar.text_key(F.col("account_number")).alias("account_number"),
        scalar.epoch_micros(F.col("posting_timestamp")).alias("us"),
        F.col(schema.SEQ).alias("tie"),
        F.struct(*names).alias("row"),
    ).where(F.col("us").isNotNull())
    ask = asks.select(
        scalar.text_key(F.col("account_number")).alias("account_number"),
        scalar.epoch_micros(F.col("asked_at")).alias("us"),
        F.struct(*asks.columns).alias("ask"),
    )
    tagged = row.unionByName(ask, allowMissingColumns=True).withColumn(
        "is_ask", F.col("ask").isNotNull()
    )
    keys = ["account_number", "us", "is_ask", "tie"]
    # The number of a range is used as a key, so the ranges are written once.
    placed = cut_lineage(
        tagged.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()})
    )
    ends = placed.where(~F.col("is_ask")).groupBy("account_number", "_part")
    ends = ends.agg(F.max_by("row", "_pos").alias("_end"))
    touched = placed.groupBy("account_number", "_part").agg(F.count("*").alias("_n"))
    touched = touched.withColumnsRenamed({"account_number": "_account", "_part": "_range"})
    same = (F.col("_account") == F.col("account_number")) & (F.col("_range") == F.col("_part"))
    earlier = W.partitionBy("_account").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = touched.join(ends, same, "left").select(
        "_account", "_range", F.last("_end", ignorenulls=True).over(earlier).alias("_before")
    )
    inside = W.partitionBy("account_number", "_part").orderBy("_pos")
    inside = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    found = placed.withColumn("_inside", F.last("row", ignorenulls=True).over(inside)).where("is_ask")
    found = found.join(carried, same)
    timed = F.when(F.col("us").isNotNull(), F.coalesce("_inside", "_before"))
    return found.select("ask.*", timed.alias("_row")).select(
        *asks.columns, *[F.col(f"_row.{c}").alias(c) for c in names]
    )


def state_at(events: DataFrame, asks: DataFrame) -> DataFrame:
    """Each ask (account_number, asked_at, and any others) with its account's state at that time.

    The state after every row comes from one feature table with running totals, where very large accounts are
    split; the asks then meet it in ``asof_join``.  An ask before any row has a count of 0 and nulls.
    """
    after = feature_table(events, stats=True)
    rows = after.select(
        "account_number", schema.SEQ, "posting_timestamp", *[F.col(c) for c in STATE_COLUMNS[:4]],
        F.col("posting_timestamp").alias("last_posting"),
        F.col("transaction_ac_amount").alias("last_amount"),
        F.col("descr").alias("last_descr"),
        F.col("duplicate_streak").alias("current_streak"),
    )
    found = asof_join(rows, asks, STATE_COLUMNS)
    return found.withColumn("txn_count", F.coalesce("txn_count", F.lit(0)).cast("bigint"))


def map_lookup(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Category to code by a table; unknown is -1.

    A category that the table holds several times has its lowest code, so no row of
    ``df`` is multiplied.  The optimizer broadcasts the table where it is small.
    """
    codes = codes.groupBy(column).agg(F.min("code").alias("code"))
    return df.join(codes, column, "left").withColumn("code", F.coalesce("code", F.lit(-1)))
