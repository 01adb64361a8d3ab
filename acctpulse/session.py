"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore"
STREAM_DEFAULTS = {
    f"{STATE_STORE}.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    f"{STATE_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
}
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window work costs much time per byte, so small shuffles still use every core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.unix.domain.socket.enabled": "true",
    **STREAM_DEFAULTS,
}


def build_session(app_name: str = "acctpulse", **extra: str) -> SparkSession:
    """A session with the defaults this library expects; master comes from the launcher."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    Where the session names none, a temporary one serves a local session; on a cluster
    that is an error, as executors would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not _runs_in_one_place(spark.sparkContext.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        folder = tempfile.mkdtemp(prefix="acctpulse-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _runs_in_one_place(master: str) -> bool:
    return master.startswith("local") and not master.startswith("local-cluster")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/acctpulse/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so later stages never recompute a non-repeatable shuffle."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state with several variables needs the RocksDB store; a session may lack it."""
    for key, value in STREAM_DEFAULTS.items():
        spark.conf.set(key, value)
