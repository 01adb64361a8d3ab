"""The feature table: plain accounts, very large accounts, and continued accounts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.functions import scalar
from acctpulse.operators.topn import top_n_per_key
from acctpulse.operators.windows import (
    CARRY,
    HISTORY,
    OWN,
    STATS_COLUMNS,
    FeatureConfig,
    merge_moments,
    prepare,
    window_features,
)
from acctpulse.session import cut_lineage

ACCOUNT = "account_number"
TOTAL_TYPE = "decimal(28,2)"
#: Rows, own and look-back, that a task of the windows holds on average at most; each sort of it keeps them in memory.
TASK_ROWS = 100_000
#: Rows of a chunk at most: small beside a task's, as several chunks may meet in one.
CHUNK_LIMIT = TASK_ROWS // 2
LOOKBACK_COLUMNS = [schema.SEQ, ACCOUNT, "us", "amount", "descr", "dc_sign"]


@dataclass(frozen=True)
class AccountState:
    """What has to be remembered of an account to go on computing its features.

    history: the newest rows, at most ``history_cap`` per account;
    totals:  one row per account (count, sums, moments, extremes, last key, current run);
    amounts: how often each amount has occurred in the account.
    """

    history: DataFrame
    totals: DataFrame
    amounts: DataFrame


def feature_table(
    df: DataFrame,
    cfg: FeatureConfig | None = None,
    keep: Sequence[str] = (),
    state: AccountState | None = None,
    stats: bool = False,
) -> DataFrame:
    """One row per event with every feature, in account order by (time, seq).

    Accounts up to ``cfg.chunk_rows`` rows (at most ``CHUNK_LIMIT``) are one window group each.  Larger
    ones are cut into ordered chunks; a chunk gets the account's preceding rows
    as look-back and the totals of all earlier chunks as carry rows, so that no
    task ever holds a whole large account and the values stay the same.
    ``stats`` adds the account's running totals after each row.  Rows without a time
    come out too, with null features.
    """
    cfg = cfg or FeatureConfig()
    return _placed_features(df, cfg, keep, state, stats).unionByName(
        untimed_rows(df, cfg, keep), allowMissingColumns=True
    )


def _placed_features(
    df: DataFrame,
    cfg: FeatureConfig,
    keep: Sequence[str],
    state: AccountState | None,
    stats: bool,
) -> DataFrame:
    rows = prepare(df, cfg, keep)
    limit = min(cfg.chunk_rows, CHUNK_LIMIT)
    total, large = large_accounts(rows, limit)
    n_large = sum(n for _, n in large)
    parts = window_partitions(rows, total - n_large)
    if not large:
        return _whole_accounts(rows, cfg, keep, state, stats, parts)
    names = rows.sparkSession.createDataFrame([(a,) for a, _ in large], f"{ACCOUNT} string")
    names = F.broadcast(names)  # at most total rows / limit names
    rest = _whole_accounts(rows.join(names, ACCOUNT, "left_anti"), cfg, keep, state, stats, parts)
    chunks = max(2, math.ceil(n_large / limit))
    hot = rows.join(names, ACCOUNT, "left_semi")
    split = _split_accounts(hot, chunks, cfg, keep, state, stats, n_large)
    return rest.unionByName(split)


def window_partitions(rows: DataFrame, n: int) -> int | None:
    """Partitions for the windows over ``n`` rows, where the session's own number, or coalescing, would give a task too many."""
    spark, wanted = rows.sparkSession, math.ceil(n / TASK_ROWS)
    usual = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return wanted if wanted > usual else None


def untimed_rows(df: DataFrame, cfg: FeatureConfig, keep: Sequence[str] = ()) -> DataFrame:
    """Rows that no window can place, with the feature table's leading columns only."""
    return df.where(F.col("posting_timestamp").isNull()).select(
        F.col(schema.SEQ),
        scalar.text_key(F.col(ACCOUNT)).alias(ACCOUNT),
        F.lit(None).cast("timestamp").alias("posting_timestamp"),
        F.col("transaction_ac_amount").cast(schema.AMOUNT_TYPE).alias("transaction_ac_amount"),
        scalar.text_key(F.col("descr")).alias("descr"),
        *[F.col(c) for c in keep],
    )


def large_accounts(rows: DataFrame, limit: int) -> tuple[int, list[tuple[str, int]]]:
    """Number of all rows, and the accounts above the limit; there are at most total rows / limit of them."""
    counts = rows.groupBy(ACCOUNT).count()
    large = F.collect_list(F.when(F.col("count") > limit, F.struct(ACCOUNT, "count")))
    told = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), large.alias("large")).first()
    return told["n"], [(r[ACCOUNT], r["count"]) for r in told["large"]]


def _whole_accounts(
    rows: DataFrame,
    cfg: FeatureConfig,
    keep: Sequence[str],
    state: AccountState | None,
    stats: bool,
    partitions: int | None = None,
) -> DataFrame:
    if state is None:
        return window_features(rows, cfg, [ACCOUNT], keep=keep, stats=stats, partitions=partitions)
    active = rows.select(ACCOUNT).distinct()
    history = state.history.join(active, ACCOUNT, "left_semi")
    totals = state.totals.join(active, ACCOUNT, "left_semi")
    amounts = state.amounts.join(active, ACCOUNT, "left_semi")
    held = history.groupBy(ACCOUNT).agg(F.count("*").alias("held"))
    carry = totals.join(held, ACCOUNT, "left").select(
        ACCOUNT,
        F.col("n").alias("c_n"),
        F.col("mean").alias("c_mean"),
        F.col("m2").alias("c_m2"),
        F.col("total").alias("c_total"),
        F.col("squares").alias("c_squares"),
        F.col("low").alias("c_low"),
        F.col("high").alias("c_high"),
        (F.col("n") - F.coalesce("held", F.lit(0))).alias("c_base"),
        F.col("run_start").alias("c_run_start"),
    )
    return window_features(
        _with_lookback(rows, history, carry, amounts), cfg, [ACCOUNT], True, keep, stats, partitions
    )


def _with_lookback(
    own: DataFrame, history: DataFrame, carry: DataFrame, amounts: DataFrame
) -> DataFrame:
    """Own rows plus their look-back; see ``windows`` for the three kinds."""
    parts = [
        own.withColumns({"kind": F.lit(OWN), "weight": F.lit(1).cast("bigint")}),
        history.withColumns({"kind": F.lit(HISTORY), "weight": F.lit(0).cast("bigint")}),
        carry.withColumn("kind", F.lit(CARRY)),
        amounts.withColumnRenamed("n", "weight").withColumn("kind", F.lit(CARRY)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _split_accounts(
    rows: DataFrame,
    chunks: int,
    cfg: FeatureConfig,
    keep: Sequence[str],
    state: AccountState | None,
    stats: bool,
    n: int,
) -> DataFrame:
    """Features of accounts, of ``n`` rows together, that are too large for one task."""
    ordered = rows.repartitionByRange(chunks, ACCOUNT, "us", schema.SEQ).sortWithinPartitions(
        ACCOUNT, "us", schema.SEQ
    )
    # Chunk and position come from the physical layout, so the layout is written
    # once; every later stage reads that copy and never samples ranges again.
    placed = cut_lineage(
        ordered.withColumns(
            {"chunk": F.spark_partition_id(), "pos": F.monotonically_increasing_id()}
        )
    )
    state = _state_of(state, placed)
    summary = _chunk_summary(placed, state)
    carry = _chunk_carry(summary)
    amounts = _amount_carry(placed, state)
    depth = max(cfg.history_cap - 1, 1)  # the previous row is needed even under a cap of 1
    history = _chunk_history(placed, summary, depth, state)
    base = F.greatest(F.col("c_n") - depth, F.lit(0))
    return window_features(
        _with_lookback(placed.drop("pos"), history, carry.withColumn("c_base", base), amounts),
        cfg,
        [ACCOUNT, "chunk"],
        carried=True,
        keep=keep,
        stats=stats,
        partitions=window_partitions(rows, n + chunks * depth),
    )


def _state_of(state: AccountState | None, placed: DataFrame) -> AccountState | None:
    if state is None:
        return None
    names = placed.select(ACCOUNT).distinct()
    return AccountState(
        *[t.join(names, ACCOUNT, "left_semi") for t in (state.history, state.totals, state.amounts)]
    )


def _chunk_summary(placed: DataFrame, state: AccountState | None) -> DataFrame:
    """One row per (account, chunk); remembered state stands in as chunk -1."""
    by_pos = W.partitionBy(ACCOUNT, "chunk").orderBy("pos")
    key = F.struct("amount", "descr")
    value = F.col("amount").cast("double")
    prev = F.lag(key).over(by_pos)
    summary = (
        placed.select(ACCOUNT, "chunk", "pos", "amount", "descr")
        .withColumn("changed", F.when(prev.isNotNull() & ~prev.eqNullSafe(key), F.col("pos")))
        .groupBy(ACCOUNT, "chunk")
        .agg(
            F.count("*").alias("n"),
            F.min("pos").alias("first_pos"),
            F.max("pos").alias("last_pos"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count("*")).alias("m2"),
            F.sum("amount").alias("total"),
            F.sum(value * value).alias("squares"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.max("changed").alias("last_change"),
            F.min_by(key, F.col("pos")).alias("first_key"),
            F.max_by(key, F.col("pos")).alias("last_key"),
        )
    )
    if state is not None:
        summary = summary.unionByName(
            state.totals.select(
                ACCOUNT,
                F.lit(-1).alias("chunk"),
                "n",
                F.lit(0).cast("bigint").alias("first_pos"),
                (F.col("n") - 1).alias("last_pos"),
                "mean",
                "m2",
                "total",
                "squares",
                "low",
                "high",
                (F.col("run_start") - 1).alias("last_change"),
                F.lit(None).cast("struct<amount:decimal(18,2),descr:string>").alias("first_key"),
                F.struct(
                    F.col("last_amount").alias("amount"), F.col("last_descr").alias("descr")
                ).alias("last_key"),
            )
        )
    # An account has few chunks (rows / chunk_rows), so these windows are small.
    ordered = W.partitionBy(ACCOUNT).orderBy("chunk")
    before = ordered.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(ACCOUNT)
    summary = summary.withColumns(
        {
            "start": F.coalesce(F.sum("n").over(before), F.lit(0)),
            "joined": F.lag("last_key").over(ordered).eqNullSafe(F.col("first_key")),
            "center": F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole),
        }
    )
    inner = F.col("start") + F.col("last_change") - F.col("first_pos") + 1
    edge = F.when(~F.col("joined"), F.col("start") + 1)
    return summary.withColumn("change_at", F.coalesce(inner, edge))


def _chunk_carry(summary: DataFrame) -> DataFrame:
    """Totals of everything before a chunk.

    The moments are merged around the account's mean, which keeps the sums of
    squares small whatever the size of the amounts.
    """
    before = W.partitionBy(ACCOUNT).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    off = F.col("mean") - F.col("center")
    shifted = F.sum(F.col("n") * off).over(before)
    squares = F.sum(F.col("m2") + F.col("n") * off * off).over(before)
    count = F.col("start")
    return summary.select(
        ACCOUNT,
        "chunk",
        count.alias("c_n"),
        F.when(count > 0, F.col("center") + shifted / count).alias("c_mean"),
        F.when(count > 0, F.greatest(squares - shifted * shifted / count, F.lit(0.0))).alias(
            "c_m2"
        ),
        F.sum("total").over(before).cast(TOTAL_TYPE).alias("c_total"),
        F.sum("squares").over(before).alias("c_squares"),
        F.min("low").over(before).alias("c_low"),
        F.max("high").over(before).alias("c_high"),
        F.max("change_at").over(before).alias("c_run_start"),
    ).where(F.col("chunk") >= 0)


def _amount_carry(placed: DataFrame, state: AccountState | None) -> DataFrame:
    """How often each amount occurred before the chunk; only amounts the chunk holds."""
    counts = placed.groupBy(ACCOUNT, "chunk", "amount").agg(F.count("*").alias("n"))
    if state is not None:
        counts = counts.unionByName(state.amounts.withColumn("chunk", F.lit(-1)))
    before = (
        W.partitionBy(ACCOUNT, "amount").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        counts.withColumn("n", F.sum("n").over(before))
        .where((F.col("chunk") >= 0) & F.col("n").isNotNull())
        .select(ACCOUNT, "chunk", "amount", "n")
    )


def _chunk_history(
    placed: DataFrame, summary: DataFrame, depth: int, state: AccountState | None
) -> DataFrame:
    """The ``depth`` rows before each chunk, copied to that chunk.

    Only the tail of a chunk can be look-back of a later one.  Tails and chunk
    starts meet on (account, position / depth): a start concerns at most two
    neighbouring buckets, and a bucket holds at most ``depth`` rows.
    """
    bounds = summary.select(ACCOUNT, "chunk", "start", "first_pos", "last_pos")
    tails = (
        placed.select(*LOOKBACK_COLUMNS, "chunk", "pos")
        .join(bounds, [ACCOUNT, "chunk"])
        .where(F.col("last_pos") - F.col("pos") < depth)
        .select(*LOOKBACK_COLUMNS, (F.col("start") + F.col("pos") - F.col("first_pos")).alias("at"))
    )
    if state is not None:
        newest = W.partitionBy(ACCOUNT).orderBy(F.desc("us"), F.desc(schema.SEQ))
        held = (
            state.history.select(*LOOKBACK_COLUMNS)
            .withColumn("back", F.row_number().over(newest))
            .join(state.totals.select(ACCOUNT, "n"), ACCOUNT)
            .select(*LOOKBACK_COLUMNS, (F.col("n") - F.col("back")).alias("at"))
        )
        tails = tails.unionByName(held)
    starts = bounds.where((F.col("chunk") >= 0) & (F.col("start") > 0)).select(
        ACCOUNT,
        "chunk",
        "start",
        F.explode(
            F.sequence(
                F.floor(F.greatest(F.col("start") - depth, F.lit(0)) / F.lit(depth)),
                F.floor((F.col("start") - 1) / F.lit(depth)),
            )
        ).alias("bucket"),
    )
    return (
        tails.withColumn("bucket", F.floor(F.col("at") / F.lit(depth)))
        .join(starts, [ACCOUNT, "bucket"])
        .where((F.col("at") < F.col("start")) & (F.col("at") >= F.col("start") - depth))
        .select(*LOOKBACK_COLUMNS, "chunk")
    )


def account_state(
    df: DataFrame,
    cfg: FeatureConfig | None = None,
    state: AccountState | None = None,
    features: DataFrame | None = None,
) -> AccountState:
    """State after the events of ``df``, continuing from ``state`` if given.

    ``features`` is their feature table from ``state`` on, if it is at hand already.
    """
    cfg = cfg or FeatureConfig()
    rows = prepare(df, cfg)
    value = F.col("amount").cast("double")
    order = F.struct("us", schema.SEQ)
    totals = rows.groupBy(ACCOUNT).agg(
        F.count("*").alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count("*")).alias("m2"),
        F.sum("amount").cast(TOTAL_TYPE).alias("total"),
        F.sum(value * value).alias("squares"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.max_by("amount", order).alias("last_amount"),
        F.max_by("descr", order).alias("last_descr"),
    )
    features = feature_table(df, cfg, state=state) if features is None else features
    streaks = (
        features.groupBy(ACCOUNT)
        .agg(
            F.max_by("duplicate_streak", F.struct("posting_timestamp", schema.SEQ)).alias("streak")
        )
    )
    totals = totals.join(streaks, ACCOUNT)
    history = rows.select(*LOOKBACK_COLUMNS)
    amounts = rows.groupBy(ACCOUNT, "amount").agg(F.count("*").alias("n"))
    run_start = (F.col("n") - F.col("streak") + 1).alias("run_start")
    if state is None:
        totals = totals.select("*", run_start).drop("streak")
    else:
        totals = _merge_totals(state.totals, totals)
        history = history.unionByName(state.history)
        amounts = (
            amounts.unionByName(state.amounts).groupBy(ACCOUNT, "amount").agg(F.sum("n").alias("n"))
        )
    newest = [F.desc("us"), F.desc(schema.SEQ)]
    history = top_n_per_key(history, [ACCOUNT], newest, cfg.history_cap)
    return AccountState(history, totals, amounts)


def _merge_totals(old: DataFrame, new: DataFrame) -> DataFrame:
    """Totals of accounts seen before, in the new events, or in both."""
    joined = old.alias("o").join(new.alias("n"), ACCOUNT, "full_outer")

    def part(side: str) -> tuple[Column, Column, Column]:
        count = F.coalesce(F.col(f"{side}.n"), F.lit(0))
        return count, F.col(f"{side}.mean"), F.col(f"{side}.m2")

    def both(name: str) -> Column:
        return F.coalesce(f"o.{name}", F.lit(0)) + F.coalesce(f"n.{name}", F.lit(0))

    n, mean, m2 = merge_moments(part("o"), part("n"))
    touched = F.col("n.n").isNotNull()
    return joined.select(
        ACCOUNT,
        n.alias("n"),
        mean.alias("mean"),
        m2.alias("m2"),
        both("total").cast(TOTAL_TYPE).alias("total"),
        both("squares").alias("squares"),
        F.least("o.low", "n.low").alias("low"),
        F.greatest("o.high", "n.high").alias("high"),
        F.coalesce("n.last_amount", "o.last_amount").alias("last_amount"),
        F.coalesce("n.last_descr", "o.last_descr").alias("last_descr"),
        F.when(touched, n - F.col("streak") + 1)
        .otherwise(F.col("o.run_start"))
        .alias("run_start"),
    )


def checkpoint_state(state: AccountState) -> AccountState:
    """Write the state once, so the next batch does not recompute earlier ones."""
    return AccountState(
        *[cut_lineage(t) for t in (state.history, state.totals, state.amounts)]
    )


def save_state(state: AccountState, path: str) -> None:
    for name, table in vars(state).items():
        table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_state(spark: SparkSession, path: str) -> AccountState:
    return AccountState(
        *[
            spark.read.parquet(f"{path.rstrip('/')}/{name}")
            for name in ("history", "totals", "amounts")
        ]
    )


def running_account_stats(
    df: DataFrame, cfg: FeatureConfig | None = None, state: AccountState | None = None
) -> DataFrame:
    """Count, sum, sum of squares, mean and deviation of an account after each row."""
    return feature_table(df, cfg, state=state, stats=True).select(
        schema.SEQ, ACCOUNT, *STATS_COLUMNS
    )
