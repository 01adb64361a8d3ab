"""A scoring stream that follows new models and tells how long its batches took.

Models are published as versions of a folder: a version is complete once its entry among the published ones is, which is
written last.  Before each micro-batch the newest version is looked up, loaded if it is another than the one at
hand, and noted for that batch; a repeated batch uses the noted one, so its output stays the same.
Any model can be used, the distance model too, as a micro-batch is an ordinary table.

Progress of the stream is kept as a table, one row a micro-batch, for reports that show counts beside latency.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from acctpulse import schema
from acctpulse.models import select
from acctpulse.models.explain import as_map, score_and_explain
from acctpulse.operators.features import ACCOUNT
from acctpulse.operators.validation import with_reject_reason
from acctpulse.operators.windows import FeatureConfig
from acctpulse.streaming.jobs import stream_features

PROGRESS = (
    "query_id string, batch_id bigint, started string, input_rows bigint, batch_ms bigint, "
    "rows_per_second double"
)


def _children(spark: SparkSession, folder: str) -> list[str]:
    """Names below a folder, none if it is not there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(conf)
    return [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Complete versions, ascending."""
    base = f"{folder.rstrip('/')}/published"
    names = [n for n in _children(spark, base) if n.startswith("version=")]
    return sorted(int(n[8:]) for n in names if "_SUCCESS" in _children(spark, f"{base}/{n}"))


def publish(spark: SparkSession, model: Any, folder: str) -> int:
    """Saves ``model`` as the next version; readers see it once it is whole.  One publisher at a time."""
    folder = folder.rstrip("/")
    version = max(versions(spark, folder), default=0) + 1
    select.save(spark, model, f"{folder}/models/version={version}")
    note = spark.createDataFrame([(version, model.kind)], "number long, kind string")
    note.coalesce(1).write.mode("overwrite").parquet(f"{folder}/published/version={version}")
    return version


class ModelFolder:
    """The newest published model; loaded once a version."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.version, self.model = 0, None

    def load(self, spark: SparkSession, version: int | None = None, force_reload: bool = False) -> Any:
        """The model of ``version``, the newest by default; FileNotFoundError if there is none."""
        if version is None:
            version = max(versions(spark, self.folder), default=0)
        if not version:
            raise FileNotFoundError(f"no model is published in {self.folder}")
        if force_reload or version != self.version:
            self.model = select.load(spark, f"{self.folder}/models/version={version}")
            self.version = version
        return self.model

    def clear(self) -> None:
        self.version, self.model = 0, None


def scoring_batch(models: str, path: str, top_n: int = 5) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for feature rows: writes them scored, with ``model_version``, to ``path``/scored."""
    folder, path = ModelFolder(models), path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note = f"{path}/versions/batch={batch_id}"
        if "_SUCCESS" in _children(spark, note):
            wanted = spark.read.parquet(note).first()["number"]
        else:
            wanted = max(versions(spark, folder.folder), default=0)
            spark.createDataFrame([(wanted,)], "number long").coalesce(1).write.mode("overwrite").parquet(note)
        model = folder.load(spark, wanted)
        rows = batch.where("reject_reason is null")
        if select.explains(model):
            scored = score_and_explain(rows, model, top_n).withColumn("top_features", as_map(F.col("top_features")))
        else:
            scored = select.score(rows, model).withColumn("top_features", F.lit(None).cast("map<string,double>"))
        on_time = ~F.col("is_late")
        told = scored.select(
            schema.SEQ, ACCOUNT, "posting_timestamp", "transaction_ac_amount", "is_late",
            *[F.when(on_time, F.col(c)).alias(c) for c in ("anomaly_score", "anomaly_label", "is_anomaly", "top_features")],
            F.when(on_time, F.lit(wanted)).cast("bigint").alias("model_version"),
        )
        rejects = batch.where("reject_reason is not null").select(
            schema.SEQ, ACCOUNT, "posting_timestamp", "transaction_ac_amount", "reject_reason"
        )
        out = told.unionByName(rejects, allowMissingColumns=True)
        out.write.mode("overwrite").parquet(f"{path}/scored/batch={batch_id}")

    return write


def start_scoring(
    events: DataFrame, models: str, path: str, checkpoint: str, cfg: FeatureConfig | None = None,
    available_now: bool = True, **options: Any,
) -> StreamingQuery:
    """Scores a stream with the newest model of each micro-batch; rows that break a rule come out with the reason."""
    checked = with_reject_reason(events)
    features = stream_features(checked.where("reject_reason is null").drop("reject_reason"), cfg, **options)
    rejects = checked.where("reject_reason is not null").select(
        F.col(schema.SEQ).cast("bigint").alias(schema.SEQ), ACCOUNT, "posting_timestamp",
        F.col("transaction_ac_amount").cast(schema.AMOUNT_TYPE).alias("transaction_ac_amount"), "reject_reason",
    )
    writer = features.unionByName(rejects, allowMissingColumns=True).writeStream
    writer = writer.foreachBatch(scoring_batch(models, path)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/scored")


class ProgressLog(StreamingQueryListener):
    """Progress of streams as rows, written by ``flush``; micro-batches without input are left out."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.ended = threading.Event()

    def onQueryStarted(self, event: Any) -> None:
        self.ended.clear()

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        if p.numInputRows:
            took = int(p.durationMs.get("triggerExecution", 0))
            self.rows.append((
                str(p.id), int(p.batchId), str(p.timestamp), int(p.numInputRows), took,
                float(p.processedRowsPerSecond or 0.0),
            ))

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        self.ended.set()

    def flush(self, spark: SparkSession, path: str, timeout: float = 30.0) -> None:
        """Appends what was seen to the table at ``path``, once the stream's last event has arrived."""
        self.ended.wait(timeout)
        rows, self.rows = self.rows, []
        spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(path)


def with_progress(spark: SparkSession, start: Callable[[], StreamingQuery], path: str) -> None:
    """Runs a stream to its end and adds its progress to the table at ``path``."""
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        query = start()
        query.awaitTermination()
        log.flush(spark, path)
    finally:
        spark.streams.removeListener(log)
