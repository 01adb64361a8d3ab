"""End-to-end jobs: train a model, score a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.models import select
from acctpulse.models.explain import CONTRIBUTION_TYPE, score_and_explain, topn_names
from acctpulse.models.forest import with_labels
from acctpulse.operators import reports
from acctpulse.operators.features import AccountState, feature_table
from acctpulse.operators.validation import (
    fill_missing,
    require_columns,
    split_checked,
    with_reject_reason,
)
from acctpulse.operators.windows import FeatureConfig
from acctpulse.session import scratch_path


@dataclass(frozen=True)
class TrainResult:
    """``rows`` were fitted and ``rejected`` broke a rule; together they are all events."""

    model: Any
    rows: int
    rejected: int
    accounts: int
    anomalies: int
    score_stats: Mapping[str, float]


class ScoreResult(NamedTuple):
    scored: DataFrame
    rejects: DataFrame
    summary: DataFrame


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write once, to ``path`` or below the shared folder, and read back.

    Used where several jobs read the same expensive table.
    """
    path = path or scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def checked_once(events: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows with the ``needed`` columns, rejected rows with all and their reason).

    Parsing and rules cost more than reading, and a job reads its events several times, so they are checked in one
    pass and written once; columns that are not needed are kept for rejected rows only.
    """
    checked = with_reject_reason(events)
    broken = F.col("reject_reason").isNotNull()
    kept = {c.strip("`").lower() for c in [*needed, "reject_reason"]}
    rest = [c for c in events.columns if c.lower() not in kept]
    checked = checked.withColumns({c: F.when(broken, F.col(f"`{c}`")) for c in rest})
    valid, rejects = split_checked(written(checked, "checked"))
    return valid.select(*needed), rejects


def train_job(
    events: DataFrame,
    model_type: str = "IsolationForest",
    params: Mapping[str, Any] | None = None,
    cfg: FeatureConfig | None = None,
    model_path: str | None = None,
) -> TrainResult:
    """Check, features, fit, training statistics, persist.  Events that break a rule are counted."""
    cfg = cfg or FeatureConfig()
    select.check(model_type)
    require_columns(events, [schema.SEQ, *schema.REQUIRED_COLUMNS])
    needed = [schema.SEQ, *schema.REQUIRED_COLUMNS]
    valid, rejects = checked_once(events.select(*needed), needed)
    features = feature_table(valid, cfg).select(
        schema.SEQ, "account_number", *cfg.feature_columns
    )
    features = written(fill_missing(features, cfg.feature_columns, True), "features")
    model = select.fit(features, cfg.feature_columns, model_type, params)
    fitted = getattr(model, "fitted", None)
    if fitted is None:
        scored = select.score(features, model)
    else:  # the fit has scored all rows already
        scored = with_labels(fitted.withColumn(reports.SCORE, F.col("raw") - F.lit(model.offset)))
    accounts = features.agg(F.count_distinct("account_number")).first()[0]
    row = scored.agg(
        F.count("*").alias("rows"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.avg(reports.SCORE).alias("mean"),
        F.stddev_pop(reports.SCORE).alias("std"),
        F.min(reports.SCORE).alias("min"),
        F.max(reports.SCORE).alias("max"),
    ).first()
    if model_path:
        select.save(events.sparkSession, model, model_path)
    stats = {k: row[k] for k in ("mean", "std", "min", "max")}
    return TrainResult(model, row["rows"], rejects.count(), accounts, row["anomalies"], stats)


def score_job(
    events: DataFrame,
    model: Any,
    cfg: FeatureConfig | None = None,
    keep: Sequence[str] = (),
    top_n: int = 5,
    state: AccountState | None = None,
    output: str | None = None,
) -> ScoreResult:
    """Scored rows, rejected rows with their ``reject_reason``, one-row summary.

    Scored rows carry seq, time and amount besides the features, the score, the
    flag, and for flagged rows the names of the ``top_n`` strongest features.
    They are written once, to ``output`` (rejects beside it) or the shared folder; the summary
    reads only the flag of what was written, and says how many events were read and rejected.
    """
    cfg = cfg or FeatureConfig()
    valid, rejects = checked_once(events, list(dict.fromkeys([schema.SEQ, *schema.REQUIRED_COLUMNS, *keep])))
    rejects = written(rejects, "rejects", f"{output.rstrip('/')}-rejects" if output else None)
    table = fill_missing(feature_table(valid, cfg, keep, state), cfg.feature_columns)
    if select.explains(model):
        scored = score_and_explain(table, model, top_n)
    else:
        scored = select.score(table, model).withColumn(
            "top_features", F.lit(None).cast(CONTRIBUTION_TYPE)
        )
    scored = scored.withColumn("top_5_features", topn_names(F.col("top_features"))).select(
        "account_number",
        schema.SEQ,
        "posting_timestamp",
        "transaction_ac_amount",
        *keep,
        *cfg.feature_columns,
        "anomaly_score",
        "anomaly_label",
        "is_anomaly",
        "top_features",
        "top_5_features",
    )
    scored = written(scored, "scored", output)
    rejected = rejects.count()
    summary = reports.score_summary(scored).withColumns(
        {
            "rejected": F.lit(rejected).cast("bigint"),
            "total_read": F.col("total_transactions") + F.lit(rejected),
        }
    )
    return ScoreResult(scored, rejects, summary)


def load_model(spark: SparkSession, path: str) -> Any:
    return select.load(spark, path)
