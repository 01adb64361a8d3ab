"""Features of a stream whose accounts may be of any size.

Where one account holds a large part of a micro-batch, a keyed operator would give all its rows to one task.
Here a micro-batch is computed like a batch: accounts above ``FeatureConfig.chunk_rows`` are cut into ordered chunks
over many tasks, and chunks get the totals and the last rows of what came before them, from the same
batch or from earlier ones.  What is remembered lies in tables instead of a keyed store.

Each micro-batch adds one version: totals of the accounts it touched, its newest rows and its numbers of
amounts.  A reader takes the latest totals, the newest rows and the sum of numbers over the versions since the last
full one; every ``FULL_EVERY`` batches the version is a full one.  A version depends on earlier
ones only and replaces its own folder, so a repeated micro-batch gives the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from acctpulse import schema
from acctpulse.functions import scalar
from acctpulse.operators.features import ACCOUNT, AccountState, account_state, feature_table
from acctpulse.operators.topn import top_n_per_key
from acctpulse.operators.windows import FeatureConfig
from acctpulse.session import cut_lineage

FULL_EVERY = 16
TABLES = ("history", "totals", "amounts")


def _folder(path: str, table: str, version: int) -> str:
    return f"{path.rstrip('/')}/state/{table}/version={version}"


def is_full(version: int, full_every: int = FULL_EVERY) -> bool:
    return version % full_every == full_every - 1


def read_versions(
    spark: SparkSession, path: str, below: int, cfg: FeatureConfig, full_every: int = FULL_EVERY,
    accounts: DataFrame | None = None,
) -> AccountState | None:
    """State after all micro-batches before ``below``; of ``accounts`` only, if given."""
    if below <= 0:
        return None
    first = (below // full_every) * full_every - 1
    versions = range(max(first, 0), below)

    def read(table: str) -> DataFrame:
        parts = [
            spark.read.parquet(_folder(path, table, v)).withColumn("version", F.lit(v)) for v in versions
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out if accounts is None else out.join(accounts, ACCOUNT, "left_semi")

    history = top_n_per_key(
        read("history").drop("version"), [ACCOUNT], [F.desc("us"), F.desc(schema.SEQ)], cfg.history_cap
    )
    latest = W.partitionBy(ACCOUNT).orderBy(F.desc("version"))  # one row a version: few
    totals = read("totals").withColumn("_rank", F.row_number().over(latest)).where("_rank = 1")
    amounts = read("amounts").groupBy(ACCOUNT, "amount").agg(F.sum("n").alias("n"))
    return AccountState(history, totals.drop("_rank", "version"), amounts)


def write_version(
    path: str, version: int, rows: DataFrame, features: DataFrame, state: AccountState | None,
    cfg: FeatureConfig, full_every: int = FULL_EVERY,
) -> None:
    """What the micro-batch ``version`` adds; ``state`` is that of its accounts before it."""
    added = account_state(rows, cfg, features=features)
    after = account_state(rows, cfg, state, features=features)
    tables = {"history": added.history, "totals": after.totals, "amounts": added.amounts}
    spark = rows.sparkSession
    if is_full(version, full_every):
        before = read_versions(spark, path, version, cfg, full_every)
        if before is not None:
            other = before.totals.join(after.totals, ACCOUNT, "left_anti")
            amounts = before.amounts.unionByName(added.amounts).groupBy(ACCOUNT, "amount")
            tables = {
                "history": before.history.unionByName(added.history),
                "totals": other.unionByName(after.totals),
                "amounts": amounts.agg(F.sum("n").alias("n")),
            }
    for name in TABLES:
        tables[name].write.mode("overwrite").parquet(_folder(path, name, version))


def feature_batch(path: str, cfg: FeatureConfig | None = None, full_every: int = FULL_EVERY):
    """``foreachBatch`` body: writes the features of a micro-batch to ``path``/features and its version of the state.

    Every row comes out; one older than its account's newest row of an earlier micro-batch is late and has no
    features, and one without a time or an amount has none either.
    """
    cfg = cfg or FeatureConfig()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = cut_lineage(
            batch.select(schema.SEQ, *schema.REQUIRED_COLUMNS).withColumn(ACCOUNT, scalar.text_key(F.col(ACCOUNT)))
        )
        usable = F.col("posting_timestamp").isNotNull() & F.col("transaction_ac_amount").isNotNull()
        timed = rows.where(usable)
        accounts = timed.select(ACCOUNT).distinct()
        state = read_versions(spark, path, batch_id, cfg, full_every, accounts)
        late = timed.where("false")
        fresh = timed
        if state is not None:
            state = AccountState(*[cut_lineage(t) for t in (state.history, state.totals, state.amounts)])
            newest = state.history.groupBy(ACCOUNT).agg(F.max("us").alias("_newest"))
            placed = timed.join(newest, ACCOUNT, "left")
            behind = F.coalesce(scalar.epoch_micros(F.col("posting_timestamp")) < F.col("_newest"), F.lit(False))
            late, fresh = placed.where(behind).drop("_newest"), placed.where(~behind).drop("_newest")
        told = feature_table(fresh, cfg, state=state).withColumn("is_late", F.lit(False))
        bare = _bare(late, True).unionByName(_bare(rows.where(~usable), False))
        target = f"{path.rstrip('/')}/features/batch={batch_id}"
        told.unionByName(bare, allowMissingColumns=True).write.mode("overwrite").parquet(target)
        features = spark.read.parquet(target).where(~F.col("is_late") & F.col("duplicate_streak").isNotNull())
        write_version(path, batch_id, fresh, features, state, cfg, full_every)

    return write


def _bare(rows: DataFrame, late: bool) -> DataFrame:
    return rows.select(
        F.col(schema.SEQ), F.col(ACCOUNT), F.col("posting_timestamp").cast("timestamp").alias("posting_timestamp"),
        F.col("transaction_ac_amount").cast(schema.AMOUNT_TYPE).alias("transaction_ac_amount"),
        scalar.text_key(F.col("descr")).alias("descr"), F.lit(late).alias("is_late"),
    )


def start_features(
    events: DataFrame, path: str, checkpoint: str, cfg: FeatureConfig | None = None, full_every: int = FULL_EVERY
) -> StreamingQuery:
    """Runs the stream to its end; ``read_features`` reads what it wrote."""
    return (
        events.writeStream.foreachBatch(feature_batch(path, cfg, full_every))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/features").drop("batch")
