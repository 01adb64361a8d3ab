"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from acctpulse import schema
from acctpulse.models import explain, forest
from acctpulse.operators.features import feature_table
from acctpulse.plans import jobs, views
from acctpulse.plans.queries import registry
from acctpulse.session import build_session

HEADLINE = [
    "flagship",
    "feature_table",
    "feature_table_capped",
    "running_account_stats",
    "window_lookup",
    "account_breakdown",
    "score_histogram",
    "last_n_rows",
    "iforest_fit",
    "iforest_score",
    "shap_topk",
    "batch_score_job",
    "stream_features",
    "feature_table_split",
    "warm_start",
    "lof_fit",
    "lof_score",
    "ocsvm_fit",
]


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def model_stages(spark, sf_dir: str) -> dict[str, float]:
    """Fit, score and explain alone, on a feature table that is already written."""
    features = jobs.written(feature_table(views.dense(spark, sf_dir)), "bench-features")
    seconds, start = {}, time.perf_counter()
    model = forest.fit_forest(features, schema.FEATURE_COLUMNS)
    seconds["stage_fit"] = time.perf_counter() - start
    start = time.perf_counter()
    noop(forest.score_forest(features, model))
    seconds["stage_score"] = time.perf_counter() - start
    start = time.perf_counter()
    noop(explain.score_and_explain(features, model))
    seconds["stage_score_and_explain"] = time.perf_counter() - start
    return {k: round(v, 3) for k, v in seconds.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "acctpulse-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    start = time.perf_counter()
    noop(queries["flagship"](spark, sf_dir))  # compiles code and starts workers
    warm_up = round(time.perf_counter() - start, 3)
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        noop(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    stages = model_stages(spark, sf_dir)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rates = {
        f"{name}_rows_per_sec": round(events / seconds[name])
        for name in ("feature_table", "iforest_score", "batch_score_job", "stream_features")
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events": events,
                "warm_up": warm_up,
                **rates,
                **stages,
            }
        )
    )


if __name__ == "__main__":
    main()
