"""Summaries and display queries over scored events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.functions import scalar
from acctpulse.session import cut_lineage

FLAG = "is_anomaly"
SCORE = "anomaly_score"


def _flagged():
    return F.count_if(F.col(FLAG).cast("boolean"))


def _at_least_one(count):
    return F.greatest(count, F.lit(1))


def score_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("total_transactions"),
        _flagged().alias("anomalies_detected"),
        (_flagged() / _at_least_one(F.count("*"))).alias("anomaly_rate"),
    )


def distinct_accounts(events: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return events.agg(count("account_number").alias("accounts"))


#: Binary logarithm of a sketch's size; its estimate is off by about 1.04 / sqrt(2 ** SKETCH_BITS), seldom by three times that.
SKETCH_BITS = 14
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def account_sketch(events: DataFrame) -> DataFrame:
    """One row, ``sketch``: a mergeable summary of the accounts, of the same size for any number of events.

    It is merged with itself: a sketch that never was merged also remembers the order of its input and
    estimates by that, so the same accounts in one piece and in several would not give the same number.
    """
    made = events.agg(F.hll_sketch_agg("account_number", SKETCH_BITS).alias("sketch"))
    return made.select(F.hll_union("sketch", "sketch").alias("sketch"))


def add_sketch(path: str, batch: int, events: DataFrame) -> None:
    """Keeps the sketch of one batch below ``path``; the same batch again replaces its own."""
    account_sketch(events).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def distinct_accounts_so_far(sketches: DataFrame) -> DataFrame:
    """Accounts of all batches whose sketches are given; the events are not read again."""
    merged = sketches.agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("accounts"))


def score_stats(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.avg(SCORE).alias("score_mean"),
        F.stddev_pop(SCORE).alias("score_std"),
        F.min(SCORE).alias("score_min"),
        F.max(SCORE).alias("score_max"),
    )


def train_anomaly_rate(scored: DataFrame) -> DataFrame:
    anomalies = F.count_if(F.col("anomaly_label") == -1)
    return scored.agg(
        F.count("*").alias("n"),
        anomalies.alias("anomalies"),
        (F.lit(100.0) * anomalies / _at_least_one(F.count("*"))).alias("anomaly_pct"),
    )


def label_summary(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(FLAG).cast("bigint")).alias("anomalies"),
        (F.avg(F.col(FLAG).cast("double")) * 100).alias("anomaly_pct"),
        F.count_distinct("account_number").alias("accounts"),
    )


def account_breakdown(scored: DataFrame) -> DataFrame:
    """Per account: rows, anomalies, average score, total amount, rate in percent."""
    rate = F.col("anomalies") / F.col("total") * 100
    return (
        scored.groupBy("account_number")
        .agg(
            F.count(SCORE).alias("total"),
            _flagged().alias("anomalies"),
            F.avg(SCORE).alias("avg_score"),
            F.sum("transaction_ac_amount").alias("total_amount"),
        )
        .withColumn("anomaly_rate", F.round(rate, 1))
        .withColumn("account_display", scalar.mask_account(F.col("account_number")))
        .orderBy(F.desc("anomalies"), "account_number")
    )


def dashboard_metrics(scored: DataFrame, progress: DataFrame) -> DataFrame:
    """Counts of scored rows beside the latency of the stream that scored them.

    ``progress`` has a row a micro-batch with ``input_rows`` and ``batch_ms``; a row's latency is the time
    its micro-batch took, so the mean weighs batches by their rows.
    """
    total, anomalies = F.count("*"), _flagged()
    counts = scored.agg(
        total.alias("total"),
        (total - anomalies).alias("normal"),
        anomalies.alias("anomalies"),
        F.round(anomalies / _at_least_one(total) * 100, 1).alias("anomaly_rate"),
    )
    rows = F.sum("input_rows")
    latency = progress.agg(
        F.count("*").alias("batches"),
        F.coalesce(rows, F.lit(0)).alias("rows_timed"),
        F.coalesce(F.sum(F.col("input_rows") * F.col("batch_ms")) / rows, F.lit(0.0)).alias("avg_latency_ms"),
    )
    return counts.join(latency)  # one row beside one row


def phase_counts(events: DataFrame, phase: str, phases: Sequence[str]) -> DataFrame:
    return events.agg(*[F.count_if(F.col(phase) == p).alias(f"n_{p}") for p in phases])


def score_histogram(scored: DataFrame, bins: int = 30) -> DataFrame:
    """Equal bins between the lowest and highest score, split by flag.

    Two aggregations over the scan; the second sees the bounds as constants.
    """
    low, high = scored.agg(F.min(SCORE), F.max(SCORE)).first()
    if low is None or low == high:
        cell = F.lit(1)
    else:
        cell = F.least(F.width_bucket(SCORE, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return (
        scored.where(F.col(SCORE).isNotNull())
        .groupBy(F.col(FLAG).alias(FLAG), cell.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def state_stats(events: DataFrame, cap: int = schema.HISTORY_CAP) -> DataFrame:
    """Accounts tracked and rows a capped history would hold."""
    return (
        events.groupBy("account_number")
        .count()
        .agg(
            F.count("*").alias("accounts_tracked"),
            F.sum(F.least("count", F.lit(cap))).alias("total_records"),
        )
    )


def anomaly_filter(scored: DataFrame) -> DataFrame:
    return scored.where(F.col(FLAG))


def sort_by_score(scored: DataFrame) -> DataFrame:
    return scored.orderBy(SCORE, schema.SEQ)


def latest_rows(scored: DataFrame, n: int = 50) -> DataFrame:
    """The feed: newest ``n`` by arrival; each task keeps only its own newest ``n``."""
    return scored.orderBy(F.desc(schema.SEQ)).limit(n)


def latest_anomaly(scored: DataFrame) -> DataFrame:
    """Most recent flagged row."""
    flagged = anomaly_filter(scored)
    row = F.max_by(F.struct(*flagged.columns), F.col(schema.SEQ)).alias("row")
    return flagged.agg(row).where(F.col("row").isNotNull()).select("row.*")


def sort_account_time(events: DataFrame) -> DataFrame:
    """Global order by account and time for output; ranges are sampled, not gathered."""
    return events.orderBy("account_number", "posting_timestamp", schema.SEQ)


def cluster_account_time(events: DataFrame) -> DataFrame:
    """Accounts kept together and sorted inside each task, for processing."""
    return events.repartition("account_number").sortWithinPartitions(
        "account_number", "posting_timestamp", schema.SEQ
    )


def arrival_index(events: DataFrame, order: str = schema.SEQ, name: str = "arrival") -> DataFrame:
    """1..n by arrival over all rows, without a single-task window.

    Rows are range-sorted and written once; then only one count per partition is
    needed to turn positions inside partitions into global positions.
    """
    placed = cut_lineage(
        events.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()})
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_pos").alias("first"))
    offset, starts = 0, []
    for row in sorted(counts.collect(), key=lambda r: r["_part"]):  # one row per partition
        starts.append((row["_part"], offset - row["first"] + 1))
        offset += row["n"]
    shift = events.sparkSession.createDataFrame(starts, "_part int, _shift bigint")
    return (
        placed.join(F.broadcast(shift), "_part")
        .withColumn(name, F.col("_pos") + F.col("_shift"))
        .drop("_part", "_pos", "_shift")
    )
