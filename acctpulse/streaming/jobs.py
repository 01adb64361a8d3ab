"""Streaming queries: features, scores, alerts, late rows, state."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from acctpulse import schema
from acctpulse.functions import scalar
from acctpulse.models import select
from acctpulse.models.explain import as_map, score_and_explain
from acctpulse.operators.features import ACCOUNT, AccountState, feature_table
from acctpulse.operators.validation import with_reject_reason
from acctpulse.operators.windows import FeatureConfig
from acctpulse.session import use_rocksdb
from acctpulse.streaming.state import BUCKETS, INITIAL_COLUMNS, AccountFeatures, output_schema


def stream_features(
    events: DataFrame,
    cfg: FeatureConfig | None = None,
    retention: str = "parity",
    retention_seconds: float = schema.RETENTION_SECONDS,
    watermark: str = "10 minutes",
    initial: AccountState | None = None,
) -> DataFrame:
    """The feature table of a stream, plus ``is_late``; every row comes out.

    Rows without a time or an amount have no features and leave the state alone.

    retention "parity" keeps what batch keeps (capped history, running totals);
    "bounded" forgets by event time: an account without rows for ``retention_seconds``
    before the watermark loses its state. The watermark moves timers only: the operator never
    sees its column, so rows behind it are not dropped. Those older than their account's newest
    row are late, and those of an account without state, which may have been forgotten.
    """
    if retention not in ("parity", "bounded"):
        raise ValueError("retention is 'parity' or 'bounded'")
    cfg = cfg or FeatureConfig()
    use_rocksdb(events.sparkSession)
    bounded = retention == "bounded"
    rows = events.withWatermark("posting_timestamp", watermark) if bounded else events
    us, cents = scalar.epoch_micros(F.col("posting_timestamp")), _cents(F.col("transaction_ac_amount"))
    # One read of the source: rows that no window can place go through the operator, marked.
    rows = rows.select(
        scalar.text_key(F.col(ACCOUNT)).alias(ACCOUNT),
        F.coalesce(F.col(schema.SEQ).cast("bigint"), F.lit(2**63 - 1)).alias(schema.SEQ),
        F.col(schema.SEQ).cast("bigint").isNotNull().alias("has_seq"),
        F.coalesce(us, F.lit(0)).cast("bigint").alias("us"),
        F.coalesce(cents, F.lit(0)).cast("bigint").alias("cents"),
        us.isNotNull().alias("has_us"),
        cents.isNotNull().alias("has_cents"),
        scalar.text_key(F.col("descr")).alias("descr"),
        scalar.dc_sign(F.col("debit_credit_code")).alias("dc_sign"),
        scalar.input_source_encoded(F.col("input_source"), cfg.input_source_codes).alias(
            "input_source_encoded"
        ),
    )
    out = rows.withColumn("bucket", _bucket()).groupBy("bucket").transformWithStateInPandas(
        AccountFeatures(cfg, bounded, retention_seconds),
        outputStructType=output_schema(cfg),
        outputMode="append",
        timeMode="eventTime" if bounded else "none",
        initialState=initial_rows(initial).withColumn("bucket", _bucket()).groupBy("bucket") if initial else None,
    )
    ts = F.when(F.col("has_us"), F.timestamp_micros("us"))
    on_time = ~F.col("is_late") & F.col("has_us") & F.col("has_cents")

    def if_known(col):
        return F.when(on_time, col)

    amount = F.when(F.col("has_cents"), (F.col("cents") / 100).cast(schema.AMOUNT_TYPE))
    computed = {
        schema.SEQ: F.when(F.col("has_seq"), F.col(schema.SEQ)),
        "posting_timestamp": ts,
        "transaction_ac_amount": amount,
        "cumulative_amount_10min": F.col("cumulative_cents") / F.lit(100.0),
        "dc_sign": if_known(F.col("dc_sign")),
        "input_source_encoded": if_known(F.col("input_source_encoded")),
        "descr_encoded": if_known(scalar.descr_encoded(F.col("descr"), cfg.descr_codes)),
        "debit_credit_code_encoded": if_known(
            scalar.debit_credit_encoded(F.col("dc_sign"), cfg.debit_credit_codes)
        ),
        "hour_of_day": if_known(scalar.hour_of_day(ts)),
        "is_business_hours": if_known(scalar.is_business_hours(ts)),
    }
    return out.withColumns(computed).select(
        schema.SEQ,
        ACCOUNT,
        "posting_timestamp",
        "transaction_ac_amount",
        "descr",
        "is_late",
        *cfg.feature_columns,
    )


def _bucket():
    return F.pmod(F.xxhash64(ACCOUNT), F.lit(BUCKETS)).cast("int")


def _cents(amount):
    return (amount.cast(schema.AMOUNT_TYPE) * 100).cast("bigint")


def initial_rows(state: AccountState) -> DataFrame:
    """Remembered state as rows for the first micro-batch (warm start)."""

    def shaped(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(
            ACCOUNT,
            *[
                (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
                for c, t in INITIAL_COLUMNS.items()
            ],
        )

    newest = state.history.groupBy(ACCOUNT).agg(F.max(F.struct("us", schema.SEQ)).alias("t"))
    totals = state.totals.join(newest, ACCOUNT).select(
        ACCOUNT,
        F.lit("totals").alias("kind"),
        "n",
        "mean",
        "m2",
        _cents(F.col("low")).alias("low"),
        _cents(F.col("high")).alias("high"),
        (F.col("n") - F.col("run_start") + 1).alias("streak"),
        F.col("t.us").alias("us"),
        F.col("t.seq").alias("seq"),
        _cents(F.col("last_amount")).alias("cents"),
        F.col("last_descr").alias("descr"),
    )
    history = state.history.select(
        ACCOUNT,
        F.lit("history").alias("kind"),
        "us",
        "seq",
        _cents(F.col("amount")).alias("cents"),
        "descr",
        F.col("dc_sign").alias("sign"),
    )
    amounts = state.amounts.select(
        ACCOUNT, F.lit("amount").alias("kind"), _cents(F.col("amount")).alias("cents"), "n"
    )
    return shaped(totals).unionByName(shaped(history)).unionByName(shaped(amounts))


def stream_score(
    events: DataFrame,
    model: Any,
    cfg: FeatureConfig | None = None,
    top_n: int = 5,
    **options: Any,
) -> DataFrame:
    """All events with score, label, flag and their strongest features.

    The model is broadcast once; the distance model needs joins and is for batch.  Rows that break a
    rule have a ``reject_reason``; these and late rows are not scored, so score and flag are null
    (``rescore_late`` gives late rows theirs).
    """
    if model.kind == "LocalOutlierFactor":
        raise ValueError("score a LocalOutlierFactor in batch or in foreachBatch")
    checked = with_reject_reason(events)
    valid = checked.where(F.col("reject_reason").isNull())
    rejects = checked.where(F.col("reject_reason").isNotNull())
    features = stream_features(valid.drop("reject_reason"), cfg, **options)
    top = "top_features"
    if select.explains(model):
        scored = score_and_explain(features, model, top_n, flagged_only=False)
        scored = scored.withColumn(top, as_map(F.col(top)))
    else:
        scored = select.score(features, model)
        scored = scored.withColumn(top, F.lit(None).cast("map<string,double>"))
    on_time = ~F.col("is_late")
    known = scored.select(
        schema.SEQ,
        ACCOUNT,
        "posting_timestamp",
        F.col("transaction_ac_amount").cast("double").alias("transaction_ac_amount"),
        F.when(on_time, F.col("anomaly_score")).alias("anomaly_score"),
        F.when(on_time, F.col("anomaly_label")).alias("anomaly_label"),
        F.when(on_time, F.col("is_anomaly")).alias("is_anomaly"),
        F.when(on_time, F.col(top)).alias(top),
        "is_late",
        F.lit(None).cast("string").alias("reject_reason"),
    )
    amount = F.col("transaction_ac_amount").cast("double").alias("transaction_ac_amount")
    broken = rejects.select(
        F.col(schema.SEQ).cast("bigint").alias(schema.SEQ),
        scalar.text_key(F.col(ACCOUNT)).alias(ACCOUNT),
        F.col("posting_timestamp").cast("timestamp").alias("posting_timestamp"),
        amount,
        F.lit(False).alias("is_late"), "reject_reason",
    )
    return known.unionByName(broken, allowMissingColumns=True)


def rescore_late(
    events: DataFrame, late: DataFrame, model: Any, cfg: FeatureConfig | None = None
) -> DataFrame:
    """Scores of the rows in ``late`` (by seq), computed in batch.

    ``events`` holds all events by now, the late ones in their places; only accounts with a late
    row are computed.
    """
    cfg = cfg or FeatureConfig()
    accounts = late.select(ACCOUNT).distinct()
    own = events.withColumn(ACCOUNT, scalar.text_key(F.col(ACCOUNT)))
    features = feature_table(own.join(accounts, ACCOUNT, "left_semi"), cfg)
    wanted = features.join(late.select(schema.SEQ).distinct(), schema.SEQ, "left_semi")
    return select.score(wanted, model)


def split_late(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: rows in time order and late rows in separate partitions.

    One write, so the stateful stage runs once.  Each micro-batch owns one folder,
    so a repeated batch replaces its own output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path.rstrip('/')}/batch={batch_id}"
        batch.write.mode("overwrite").partitionBy("is_late").parquet(target)

    return write


def start_split(features: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        features.writeStream.foreachBatch(split_late(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows in time order, late rows); each reads its own partitions only."""
    rows = spark.read.parquet(path).drop("batch")
    late = F.col("is_late").cast("boolean")  # read back from folder names
    accepted, aside = rows.where(F.col("is_late") == "false"), rows.where(F.col("is_late") == "true")
    return accepted.withColumn("is_late", late), aside.withColumn("is_late", late)


def state_reset(spark: SparkSession, checkpoint: str) -> None:
    """Forgets all accounts: the next start from ``checkpoint`` begins with no state and no offsets."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(checkpoint)
    path.getFileSystem(conf).delete(path, True)


def state_inspect(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Accounts tracked and rows held, read from the stream's checkpoint."""
    held = (
        spark.read.format("statestore")
        .option("path", checkpoint)
        .option("stateVarName", "head")
        .load()
    )
    return held.agg(
        F.count("*").alias("accounts_tracked"),
        F.coalesce(F.sum("user_map_value.held"), F.lit(0)).alias("total_records"),
    )
