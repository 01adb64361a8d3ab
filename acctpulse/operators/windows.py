"""Per-account behaviour features as window expressions.

Every bounded measure has the form "rows seen so far minus rows that have left
the window".  Rows leave for two reasons: they are older than the look-back, or
more than ``history_cap`` newer rows of the account exist.  Both kinds of
leaver are prefixes of the account's order, so the number that has left is the
greater of the two counts.  Each count is a frame that starts at UNBOUNDED
PRECEDING, which Spark advances incrementally: cost is linear in the rows, also
where thousands of rows share one timestamp, and tied rows need no special
case because a leaver is strictly older than the current row.

The input may hold three kinds of rows (see ``ROW_KINDS``): rows to compute,
history rows that only serve as look-back, and carry rows that bring totals of
everything before the history.  Carry rows have no timestamp and so sort first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.functions import scalar

OWN, HISTORY, CARRY = 2, 1, 0
ROW_KINDS = {"own": OWN, "history": HISTORY, "carry": CARRY}

MICROS = 1_000_000

# Totals on a carry row: rows before this point, their moments and extremes, the
# position before the first history row, and where the current run began.
CARRY_COLUMNS = [
    "c_n", "c_mean", "c_m2", "c_total", "c_squares", "c_low", "c_high", "c_base", "c_run_start",
]
KEY_HASH = "_key_hash"
STATS_COLUMNS = ["txn_count", "amount_sum", "amount_sq_sum", "amount_mean", "amount_std"]


@dataclass(frozen=True)
class FeatureConfig:
    """What to compute and how much of an account one task may hold."""

    velocity_windows: Mapping[str, float] = field(
        default_factory=lambda: dict(schema.VELOCITY_WINDOWS)
    )
    history_cap: int = schema.HISTORY_CAP
    lookback_seconds: float = schema.LOOKBACK_SECONDS
    descr_codes: Mapping[str, int] | None = None
    debit_credit_codes: Mapping[str, int] | None = None
    input_source_codes: Mapping[str, int] | None = None
    # Accounts with more rows than this (or ``features.CHUNK_LIMIT``) are split into ordered chunks.
    chunk_rows: int = 2_000_000

    @property
    def feature_columns(self) -> list[str]:
        fixed = [c for c in schema.FEATURE_COLUMNS if c not in schema.VELOCITY_WINDOWS]
        return [*self.velocity_windows, *fixed]


def prepare(df: DataFrame, cfg: FeatureConfig, keep: Sequence[str] = ()) -> DataFrame:
    """Narrow the events to what the windows need; rows without a time are left out
    (``validate_split`` reports them)."""
    return df.select(
        F.col(schema.SEQ),
        scalar.text_key(F.col("account_number")).alias("account_number"),
        scalar.epoch_micros(F.col("posting_timestamp")).alias("us"),
        F.col("transaction_ac_amount").cast(schema.AMOUNT_TYPE).alias("amount"),
        scalar.text_key(F.col("descr")).alias("descr"),
        scalar.dc_sign(F.col("debit_credit_code")).alias("dc_sign"),
        scalar.input_source_encoded(F.col("input_source"), cfg.input_source_codes).alias(
            "input_source_encoded"
        ),
        *[F.col(c) for c in keep],
    ).where(F.col("us").isNotNull())


def _position(keys: Sequence[str]) -> WindowSpec:
    return W.partitionBy(*keys).orderBy("us", schema.SEQ)


def _so_far(keys: Sequence[str]) -> WindowSpec:
    return _position(keys).rowsBetween(W.unboundedPreceding, W.currentRow)


def _older(keys: Sequence[str], seconds: float) -> WindowSpec:
    """Rows strictly older than the window whose edge lies ``seconds`` back."""
    edge = int(round(seconds * MICROS)) + 1
    return W.partitionBy(*keys).orderBy("us").rangeBetween(W.unboundedPreceding, -edge)


def _pushed_out(keys: Sequence[str], cap: int) -> WindowSpec:
    """Rows with at least ``cap`` newer rows of the same account."""
    return W.partitionBy(*keys).orderBy("rn").rangeBetween(W.unboundedPreceding, -cap)


def _seconds(micros: Column) -> Column:
    return micros / F.lit(float(MICROS))


def _zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def _account_level(
    rows: DataFrame,
    cfg: FeatureConfig,
    keys: Sequence[str],
    carried: bool,
    keep: Sequence[str],
    stats: bool,
) -> DataFrame:
    """Everything ordered by (us, seq) within the account: one sort."""
    cap = cfg.history_cap
    so_far, position = _so_far(keys), _position(keys)
    is_row = F.col("us").isNotNull()
    own = (F.col("kind") == OWN) if carried else F.lit(True)
    value = F.col("amount").cast("double")
    own_value = F.when(own, value)
    gap_depth = max(min(5, cap - 1), 1)

    df = rows.withColumns(
        {
            "rn": F.count("us").over(so_far),
            "prev_us": F.lag("us").over(position),
            "prev_amount": F.lag("amount").over(position),
            "prev_descr": F.lag("descr").over(position),
            "prev_sign": F.lag("dc_sign").over(position),
            "back_us": F.lag("us", gap_depth).over(position),
            "first_us": F.min("us").over(so_far),
            "total": F.sum(F.when(is_row, F.col("amount"))).over(so_far),
            "own_n": F.count(own_value).over(so_far),
            "own_mean": F.avg(own_value).over(so_far),
            "own_var": F.var_pop(own_value).over(so_far),
        }
    )
    if stats:
        df = df.withColumns(
            {
                "own_total": F.sum(F.when(own, F.col("amount"))).over(so_far),
                "own_squares": F.sum(own_value * own_value).over(so_far),
            }
        )
    if carried:
        carry = {c: F.max(c).over(so_far) for c in CARRY_COLUMNS}
        df = df.withColumns(
            {
                **carry,
                "low": F.min(own_value).over(so_far),
                "high": F.max(own_value).over(so_far),
            }
        )

    older = {name: F.count("us").over(_older(keys, s)) for name, s in cfg.velocity_windows.items()}
    lookback = _older(keys, cfg.lookback_seconds)
    df = df.withColumns(
        {
            **{f"older_{name}": c for name, c in older.items()},
            "older_rows": F.count("us").over(lookback),
            "older_total": F.sum(F.when(is_row, F.col("amount"))).over(lookback),
        }
    )

    base = F.coalesce(F.col("c_base"), F.lit(0)) if carried else F.lit(0)
    df = df.withColumns(
        {
            "gap": F.col("us") - F.col("prev_us"),
            "flip": F.when(
                F.col("prev_us").isNotNull() & (F.col("dc_sign") != F.col("prev_sign")), 1
            ).otherwise(0),
            "changed_at": F.when(
                own
                & (
                    F.col("prev_us").isNull()
                    | ~(
                        F.col("amount").eqNullSafe(F.col("prev_amount"))
                        & F.col("descr").eqNullSafe(F.col("prev_descr"))
                    )
                ),
                base + F.col("rn"),
            ),
        }
    )
    recent_gaps = position.rowsBetween(-(max(min(10, cap - 1), 1) - 1), 0)
    recent_flips = position.rowsBetween(-(max(min(9, cap - 1), 1) - 1), 0)
    df = df.withColumns(
        {
            "min_gap": F.min("gap").over(recent_gaps),
            "flips": F.sum("flip").over(recent_flips),
            "run_start": F.max("changed_at").over(so_far),
            "total_at_cap": F.lag("total", cap).over(position),
        }
    )

    has_history = F.lit(cap > 1)
    n_gaps = F.least(F.col("rn") - 1, F.lit(gap_depth))
    span = F.col("us") - F.coalesce(F.col("back_us"), F.col("first_us"))
    run_start = F.greatest("run_start", "c_run_start") if carried else F.col("run_start")
    over_cap = (F.col("rn") - F.col("older_rows")) > cap
    left_total = F.when(over_cap, F.col("total_at_cap")).otherwise(F.col("older_total"))
    left_total = F.coalesce(left_total, F.lit(0).cast("decimal(28,2)"))

    mean, std = _running_moments(carried)
    velocity = [
        F.least(F.col("rn") - F.col(f"older_{name}"), F.lit(cap)).cast("int").alias(name)
        for name in cfg.velocity_windows
    ]
    return df.select(
        *keys,
        "us",
        schema.SEQ,
        "amount",
        "descr",
        "dc_sign",
        "input_source_encoded",
        "rn",
        *(["kind", "weight"] if carried else []),
        *keep,
        *velocity,
        F.when(has_history, _zero_if_null(_seconds(F.col("gap"))))
        .otherwise(F.lit(0.0))
        .alias("time_since_last_txn"),
        F.when(has_history & (n_gaps > 0), span / (n_gaps * F.lit(float(MICROS))))
        .otherwise(F.lit(0.0))
        .alias("avg_time_gap_last_5txn"),
        F.when(has_history, _zero_if_null(_seconds(F.col("min_gap"))))
        .otherwise(F.lit(0.0))
        .alias("min_time_gap_last_10txn"),
        (base + F.col("rn") - run_start + 1).cast("int").alias("duplicate_streak"),
        F.when(has_history, F.col("flips"))
        .otherwise(F.lit(0))
        .cast("int")
        .alias("dc_alternation_count_10txn"),
        F.round(
            F.when(std > 0, (value - mean) / std).otherwise(F.lit(0.0)), 6
        ).alias("amount_zscore_account"),
        (F.col("total") - left_total).cast("double").alias("cumulative_amount_10min"),
        *(_running_stats(std, carried) if stats else []),
    )


def _running_stats(std: Column, carried: bool) -> list[Column]:
    """Totals after each row, in the order of ``STATS_COLUMNS``."""
    n, total, squares = F.col("own_n"), F.col("own_total"), F.col("own_squares")
    if carried:
        n = n + F.coalesce("c_n", F.lit(0))
        total = F.coalesce(total + F.col("c_total"), total, F.col("c_total"))
        squares = F.coalesce(squares + F.col("c_squares"), squares, F.col("c_squares"))
    mean = total.cast("double") / F.nullif(n, F.lit(0))
    values = [n, total, squares, mean, std]
    return [v.alias(name) for v, name in zip(values, STATS_COLUMNS)]


def _running_moments(carried: bool) -> tuple[Column, Column]:
    """Mean and population deviation of all amounts so far."""
    mean, std = F.col("own_mean"), F.sqrt("own_var")
    if carried:
        n, mean, m2 = merge_moments(
            (F.coalesce(F.col("c_n"), F.lit(0)), F.col("c_mean"), F.col("c_m2")),
            (F.col("own_n"), F.col("own_mean"), F.col("own_var") * F.col("own_n")),
        )
        flat = F.least("low", "c_low") == F.greatest("high", "c_high")
        std = F.when(flat, F.lit(0.0)).otherwise(F.sqrt(m2 / F.nullif(n, F.lit(0))))
    return mean, std


def merge_moments(
    a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]
) -> tuple[Column, Column, Column]:
    """Count, mean and sum of squared deviations of two disjoint parts."""
    (na, ma, qa), (nb, mb, qb) = a, b
    zero = F.lit(0.0)
    ma, mb = F.coalesce(ma, zero), F.coalesce(mb, zero)
    n = na + nb
    delta = mb - ma
    share = F.coalesce(nb / F.nullif(n, F.lit(0)), zero)
    mean = F.when(na > 0, ma + delta * share).otherwise(mb)
    m2 = F.coalesce(qa, zero) + F.coalesce(qb, zero) + delta * delta * na * share
    return n, mean, m2


def _same_amount_level(
    df: DataFrame, cfg: FeatureConfig, keys: Sequence[str], carried: bool
) -> DataFrame:
    """Measures among rows of the account with an equal amount."""
    cap = cfg.history_cap
    part = [*keys, "amount"]
    so_far, position = _so_far(part), _position(part)
    older, pushed = _older(part, cfg.lookback_seconds), _pushed_out(part, cap)
    debit = F.when(F.col("dc_sign") == 1, F.col("us"))
    credit = F.when(F.col("dc_sign") == -1, F.col("us"))
    measures = {"same": F.col("us"), "debits": debit, "credits": credit}

    seen = {f"seen_{k}": F.count(c).over(so_far) for k, c in measures.items()}
    seen["same_us"] = F.lag("us").over(position)
    seen["same_rn"] = F.lag("rn").over(position)
    if carried:
        seen["frequency"] = F.sum("weight").over(so_far)
    df = df.withColumns(seen)
    df = df.withColumns({f"old_{k}": F.count(c).over(older) for k, c in measures.items()})
    df = df.withColumns({f"out_{k}": F.count(c).over(pushed) for k, c in measures.items()})

    def within(k: str) -> Column:
        return F.col(f"seen_{k}") - F.greatest(f"old_{k}", f"out_{k}")

    reversals = (
        F.when(F.col("dc_sign") == 1, within("credits"))
        .when(F.col("dc_sign") == -1, within("debits"))
        .otherwise(F.lit(0))
    )
    frequency = F.col("frequency") if carried else F.col("seen_same")
    return df.withColumns(
        {
            "same_acct_amt_count_10min": within("same").cast("int"),
            "reversal_count_10min": reversals.cast("int"),
            "same_amount_frequency": frequency.cast("bigint"),
            "time_since_last_txn_same_amount": _gap_within_cap("same_us", "same_rn", cap),
        }
    ).drop(
        *[f"{p}_{k}" for p in ("seen", "old", "out") for k in measures],
        "same_us",
        "same_rn",
        "frequency",
        "weight",
    )


def _gap_within_cap(us: str, rn: str, cap: int) -> Column:
    recent = (F.col("rn") - F.col(rn)) < cap
    return F.when(recent, _seconds(F.col("us") - F.col(us))).otherwise(F.lit(0.0))


def _same_amount_descr_level(df: DataFrame, cfg: FeatureConfig, keys: Sequence[str]) -> DataFrame:
    part = [*keys, "amount", "descr"]
    df = df.withColumn("seen_pair", F.count("us").over(_so_far(part)))
    df = df.withColumn("old_pair", F.count("us").over(_older(part, cfg.lookback_seconds)))
    df = df.withColumn("out_pair", F.count("us").over(_pushed_out(part, cfg.history_cap)))
    within = F.col("seen_pair") - F.greatest("old_pair", "out_pair")
    return df.withColumns(
        {
            "same_acct_amt_descr_count_10min": within.cast("int"),
            "is_exact_duplicate_10min": F.when(within > 1, 1).otherwise(0),
        }
    ).drop("seen_pair", "old_pair", "out_pair")


def _same_descr_level(df: DataFrame, cfg: FeatureConfig, keys: Sequence[str]) -> DataFrame:
    position = _position([*keys, "descr"])
    df = df.withColumns(
        {"descr_us": F.lag("us").over(position), "descr_rn": F.lag("rn").over(position)}
    )
    gap = _gap_within_cap("descr_us", "descr_rn", cfg.history_cap)
    return df.withColumn("time_since_last_txn_same_descr", gap).drop("descr_us", "descr_rn")


def window_features(
    rows: DataFrame,
    cfg: FeatureConfig,
    keys: Sequence[str] = ("account_number",),
    carried: bool = False,
    keep: Sequence[str] = (),
    stats: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """All features of prepared rows; one shuffle by ``keys``, into ``partitions`` if given.

    The finer groups (amount, description) lie inside a key group, so they
    re-sort within the task and need no further exchange.
    """
    rows = rows.repartition(partitions, *keys) if partitions else rows
    # Sorts compare eight bytes of their first column before whole rows; account texts often begin alike, hashes do not.
    rows = rows.withColumn(KEY_HASH, F.xxhash64(*keys))
    keys = [KEY_HASH, *keys]
    df = _account_level(rows, cfg, keys, carried, keep, stats)
    df = _same_amount_level(df, cfg, keys, carried)
    df = _same_amount_descr_level(df, cfg, keys)
    df = _same_descr_level(df, cfg, keys)
    if carried:
        df = df.where(F.col("kind") == OWN)
    ts = F.timestamp_micros("us")
    df = df.withColumns(
        {
            "posting_timestamp": ts,
            "descr_encoded": scalar.descr_encoded(F.col("descr"), cfg.descr_codes),
            "debit_credit_code_encoded": scalar.debit_credit_encoded(
                F.col("dc_sign"), cfg.debit_credit_codes
            ),
            "hour_of_day": scalar.hour_of_day(ts),
            "is_business_hours": scalar.is_business_hours(ts),
        }
    )
    return df.select(
        schema.SEQ,
        "account_number",
        "posting_timestamp",
        F.col("amount").alias("transaction_ac_amount"),
        "descr",
        *keep,
        *cfg.feature_columns,
        *(STATS_COLUMNS if stats else []),
    )
