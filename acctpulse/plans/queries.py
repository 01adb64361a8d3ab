"""Named queries over the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctpulse import schema
from acctpulse.functions import scalar
from acctpulse.functions.labels import FEATURE_DESCRIPTIONS
from acctpulse.models import explain, forest, lof, ocsvm, select
from acctpulse.operators import lookups, reports, validation
from acctpulse.operators.features import (
    AccountState,
    account_state,
    checkpoint_state,
    feature_table,
    running_account_stats,
)
from acctpulse.operators.quantile import exact_quantile
from acctpulse.operators.windows import FeatureConfig
from acctpulse.plans import fixed, jobs, views
from acctpulse.session import scratch_path
from acctpulse.sources import readers, writers
from acctpulse.streaming import jobs as streams
from acctpulse.streaming import service, tables

Query = Callable[[SparkSession, str], DataFrame]

CUSTOM_WINDOWS = {"txn_count_5s": 5, "txn_count_2min": 120, "txn_count_1h": 3600}
BATCH_FILES = 8
HALF_TIME = "1970-02-02 21:31:12"  # near the middle of the dense view
ORDERS_HALF = "1970-01-03 03:45:00"  # near the middle of the nation view
PSEUDO_CONTRIBUTIONS = {
    "value": "value",
    "amount": "cast(transaction_ac_amount as double)",
    "centred": "40 - value",
    "hour": "cast(hour(posting_timestamp) as double)",
    "second": "cast(second(posting_timestamp) as double)",
    "minute": "0 - cast(minute(posting_timestamp) as double)",
    "score": "anomaly_score * 100",
}
FAST_FOREST = {"n_estimators": 100, "contamination": 0.01, "random_state": 42}


# --- sources and sinks -------------------------------------------------------------------


def _raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse events as text rows; whole seconds lose their fraction, so precisions mix."""
    ts = F.col("posting_timestamp")
    whole = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    exact = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = F.when(F.col("debit_credit_code") == "D", whole).otherwise(exact)
    return views.sparse(spark, sf_dir).select(
        schema.SEQ,
        "account_number",
        text.alias("posting_timestamp"),
        "transaction_ac_amount",
        "descr",
        "debit_credit_code",
        "input_source",
        *[F.lit(None).cast("string").alias(c) for c in schema.OPTIONAL_COLUMNS],
    )


def read_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    _raw_text(spark, sf_dir).write.option("header", True).csv(path)
    rows = validation.parse_timestamps(readers.read_csv(spark, path))
    return rows.select(schema.SEQ, *schema.REQUIRED_COLUMNS)


def _seven_columns(spark, sf_dir):
    """The narrow layout: no sequence, another order, a column that is not ours."""
    return _raw_text(spark, sf_dir).select(
        "account_number", "posting_timestamp", "transaction_ac_amount", "descr",
        "debit_credit_code", "input_source", F.lit(0).alias("is_anomaly"),
    )


def read_csv_narrow(spark, sf_dir):
    """Seven columns, numbered by their order in the file."""
    path = scratch_path(spark, "csv-narrow")
    ordered = _raw_text(spark, sf_dir).select(schema.SEQ, *_seven_columns(spark, sf_dir).columns[:-1])
    # Part files follow one another in order, as the numbering by file needs.
    ordered = ordered.repartitionByRange(BATCH_FILES, schema.SEQ).sortWithinPartitions(schema.SEQ)
    ordered.drop(schema.SEQ).withColumn("is_anomaly", F.lit(0)).write.option("header", True).csv(path)
    rows = readers.with_sequence(readers.read_csv(spark, path).drop(schema.SEQ))
    return validation.parse_timestamps(rows).select(schema.SEQ, *schema.REQUIRED_COLUMNS)


def read_csv_wide(spark, sf_dir):
    """Twenty-two columns in an order of their own, numbered by one of them; some amounts are no numbers."""
    path = scratch_path(spark, "csv-wide")
    raw = _raw_text(spark, sf_dir)
    broken = F.when(F.col("descr") == "error", F.lit("n/a")).otherwise(
        F.col("transaction_ac_amount").cast("string"))
    others = [f"other_{i}" for i in range(22 - len(raw.columns))]
    wide = raw.withColumn("transaction_ac_amount", broken).withColumnRenamed(schema.SEQ, "generated_txn_seq")
    wide = wide.select(*others_as_text(others), *reversed(wide.columns))
    wide.write.option("header", True).csv(path)
    fields = [f for f in schema.RAW_SCHEMA.fields if f.name != schema.SEQ]
    columns = T.StructType([*fields, T.StructField("generated_txn_seq", T.StringType())])
    rows = readers.with_sequence(readers.read_csv(spark, path, columns), "generated_txn_seq")
    return validation.parse_timestamps(rows).select(
        schema.SEQ, *schema.REQUIRED_COLUMNS, F.array_join(readers.BAD_FIELDS, ",").alias("bad_fields")
    )


def others_as_text(names):
    return [F.lit("x").alias(n) for n in names]


def read_parquet(spark, sf_dir):
    return views.sparse(spark, sf_dir).select(schema.SEQ, *schema.REQUIRED_COLUMNS)


def require_columns(spark, sf_dir):
    """Rows of a table that has all columns, and which of two were missed in one that has not."""
    rows = views.dense(spark, sf_dir)
    wanted = [schema.SEQ, *schema.REQUIRED_COLUMNS]
    validation.require_columns(rows, wanted)
    try:
        validation.require_columns(rows.drop("descr", "input_source"), wanted)
        missed = []
    except ValueError as error:
        missed = [c for c in wanted if c in str(error)]
    return rows.select(schema.SEQ, F.lit(",".join(sorted(missed))).alias("missed"))


def select_cast_key(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    twice = events.select(
        F.col("user_id").alias("account_number"), "event_id", "value",
        F.col("user_id").cast("string").alias("account_number"),
    )
    return validation.select_cast_key(twice, ["account_number", "event_id", "value"])


def write_scored_csv(spark, sf_dir):
    path = scratch_path(spark, "scored-csv")
    rows = views.scored(spark, sf_dir).select(
        "account_number", schema.SEQ, "anomaly_score", "is_anomaly"
    )
    writers.write_scored_csv(rows, path)
    back = "account_number string, seq long, anomaly_score double, is_anomaly boolean"
    return spark.read.option("header", True).option("escape", '"').schema(back).csv(path)


def text_guard(spark, sf_dir):
    rows = views.dense(spark, sf_dir)
    return rows.select(schema.SEQ, scalar.text_guard(F.col("account_number")).alias("guarded"))


def write_training_snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    rows = validation.add_constant_label(views.dense(spark, sf_dir))
    writers.write_snapshot(rows.select(schema.SEQ, *schema.REQUIRED_COLUMNS, "is_anomaly"), path)
    return spark.read.parquet(path)


def _fitted_forest(spark, sf_dir, **params):
    features = jobs.written(feature_table(views.dense(spark, sf_dir)), "features")
    return features, forest.fit_forest(
        features, schema.FEATURE_COLUMNS, **{**FAST_FOREST, **params}
    )


def _forest_of(features):
    """Fitted to a written table; its rows are picked by their place, as their own numbers may repeat or be missing."""
    placed = features.withColumn(schema.SEQ, F.monotonically_increasing_id())
    return forest.fit_forest(placed, schema.FEATURE_COLUMNS, **FAST_FOREST)


def _fixed_forest(spark, sf_dir):
    """The feature table and the fixed forest, cut off where a hundredth of the rows lie below."""
    features = jobs.written(feature_table(views.dense(spark, sf_dir)), "features")
    model = fixed.forest()
    scores = jobs.written(features.select(forest.raw_score(features, model).alias("raw")), "fixed-scores")
    model.offset = exact_quantile(scores, "raw", 0.01)
    return features, model


def _verdicts(scored, *more):
    return scored.select(
        schema.SEQ, F.round("anomaly_score", 6).alias("anomaly_score"), "anomaly_label", "is_anomaly", *more
    )


def _flagged(scored):
    """The scored rows' features, with whether each row's flag, label and sign agree."""
    low = F.col("anomaly_score") < 0
    agree = (F.col("is_anomaly") == low) & ((F.col("anomaly_label") == -1) == low)
    return scored.select(schema.SEQ, "account_number", *schema.FEATURE_COLUMNS, agree.alias("flag_is_sign"))


def _node_rows(spark, model):
    return spark.createDataFrame(model.nodes, forest.NODE_SCHEMA)


def _tree_checks(nodes):
    """Per tree: rows at its root and in its leaves, and whether depth and children are right."""
    child = nodes.where("node > 0").select(
        "tree", F.floor((F.col("node") - 1) / 2).cast("int").alias("node"),
        F.col("rows").alias("part"), F.col("depth").alias("below"),
    )
    split = nodes.where("feature >= 0").select("tree", "node", "rows", "depth")
    halves = split.join(child, ["tree", "node"], "left").groupBy("tree", "node", "rows", "depth")
    halves = halves.agg(F.sum("part").alias("parts"), F.count("part").alias("n"),
                        F.max("below").alias("below"))
    right = (F.col("parts") == F.col("rows")) & (F.col("n") == 2)
    right &= F.col("below") == F.col("depth") + 1
    fits = halves.groupBy("tree").agg(F.min(F.coalesce(right, F.lit(False))).alias("children_add_up"))
    leaf = F.when(F.col("feature") < 0, F.col("rows"))
    whole = nodes.groupBy("tree").agg(
        F.sum(F.when(F.col("node") == 0, F.col("rows"))).alias("root_rows"),
        F.sum(leaf).alias("leaf_rows"), (F.max("depth") <= 8).alias("depth_fits"),
    )
    return whole.join(fits, "tree")


def save_model(spark, sf_dir):
    """What was written, read back."""
    _, model = _fitted_forest(spark, sf_dir)
    path = scratch_path(spark, "model")
    forest.save_forest(spark, model, path)
    return _tree_checks(spark.read.parquet(f"{path}/trees"))


def load_model(spark, sf_dir):
    """Scores by a model that was saved and loaded."""
    features, model = _fixed_forest(spark, sf_dir)
    path = scratch_path(spark, "model")
    forest.save_forest(spark, model, path)
    return _verdicts(forest.score_forest(features, jobs.load_model(spark, path)))


def model_reload(spark, sf_dir):
    """A running stream goes over to a model that is published between two of its micro-batches."""
    features, first = _fitted_forest(spark, sf_dir)
    second = forest.fit_forest(features, schema.FEATURE_COLUMNS, **{**FAST_FOREST, "random_state": 7, "contamination": 0.05})
    rows = views.dense(spark, sf_dir)
    early = F.col("posting_timestamp") < F.lit(HALF_TIME).cast("timestamp")
    models, source, out, state = (scratch_path(spark, f"reload-{n}") for n in ("models", "in", "out", "state"))
    service.publish(spark, first, models)
    rows.where(early).select(*schema_columns()).write.parquet(source)
    running = service.start_scoring(_stream_of(spark, source, 10_000), models, out, state, available_now=False)
    try:
        running.processAllAvailable()
        service.publish(spark, second, models)
        rows.where(~early).select(*schema_columns()).write.mode("append").parquet(source)
        running.processAllAvailable()
    finally:
        running.stop()
    scored = service.read_scored(spark, out).select(schema.SEQ, "model_version", "anomaly_score", "is_anomaly")
    both = forest.score_forest(features, first).withColumn("v", F.lit(1)).unionByName(
        forest.score_forest(features, second).withColumn("v", F.lit(2)))
    both = both.select(F.col(schema.SEQ).alias("s"), "v", F.col("anomaly_score").alias("want"), F.col("is_anomaly").alias("flag"))
    joined = scored.join(both, (F.col("s") == F.col(schema.SEQ)) & (F.col("v") == F.col("model_version")), "left")
    return joined.select(
        schema.SEQ, "model_version", F.round(F.abs(F.col("anomaly_score") - F.col("want")), 6).alias("difference"),
        F.col("is_anomaly").eqNullSafe(F.col("flag")).alias("same_flag"),
    )


def _event_stream(spark, sf_dir):
    """The events table as a file stream."""
    columns = views.table(spark, sf_dir, "events").schema
    return readers.stream_files(spark, sf_dir, columns, pathGlobFilter="events.parquet")


def _drained(spark, stream, label):
    """Run a stream to its end and read back what it wrote."""
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    writers.write_stream(stream, path, checkpoint).awaitTermination()
    return spark.read.parquet(path), checkpoint


def stream_source(spark, sf_dir):
    rows = views.dense_of(_event_stream(spark, sf_dir))
    return _drained(spark, rows.select(schema.SEQ, *schema.REQUIRED_COLUMNS), "stream")[0]


def alert_sink(spark, sf_dir):
    rows = views.scored_of(views.dense_of(_event_stream(spark, sf_dir)))
    path, checkpoint = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-checkpoint")
    columns = [schema.SEQ, "account_number", "anomaly_score", "is_anomaly"]
    writers.write_alerts(rows.select(*columns), path, checkpoint).awaitTermination()
    shape = "seq long, account_number string, anomaly_score double, is_anomaly boolean"
    parsed = F.from_json("value", shape).alias("alert")
    return spark.read.text(path).select(parsed).select("alert.*")


# --- projections and checks ---------------------------------------------------------------


def _defective(spark, sf_dir):
    """Dense rows in which some events break a rule, by what they hold."""
    amount = F.when(F.col("value") < 2, F.lit(-1)).otherwise(F.col("transaction_ac_amount"))
    code = F.when(F.col("value") > 100, F.lit("X")).otherwise(F.col("debit_credit_code"))
    descr = F.when(F.col("value").between(50, 52), None).otherwise(F.col("descr"))
    return views.dense(spark, sf_dir).withColumns(
        {"transaction_ac_amount": amount, "debit_credit_code": code, "descr": descr}
    )


def validate_split(spark, sf_dir):
    valid, rejects = validation.validate_split(_defective(spark, sf_dir))
    both = valid.withColumn("reject_reason", F.lit("valid")).unionByName(rejects)
    return both.select(schema.SEQ, "reject_reason")


def bad_timestamp_sample(spark, sf_dir):
    broken = F.concat(F.lit("not a time "), F.col("seq"))
    text = F.when(F.col("descr") == "error", broken).otherwise(F.col("posting_timestamp"))
    rows = _raw_text(spark, sf_dir).withColumn("posting_timestamp", text)
    return validation.bad_timestamp_sample(rows)


def passthrough_cols(spark, sf_dir):
    rows = views.dense(spark, sf_dir).withColumnRenamed("event_type", "posting_mode")
    out = feature_table(rows, keep=["posting_mode", "input_source"])
    return out.select(schema.SEQ, "posting_mode", "input_source", "txn_count_30s")


def ordered_vector(spark, sf_dir):
    rows = feature_table(views.dense(spark, sf_dir))
    vector = validation.ordered_vector(schema.FEATURE_COLUMNS)
    return rows.select(schema.SEQ, F.posexplode(vector).alias("pos", "feature_value"))


def fill_missing(spark, sf_dir):
    value = F.col("value")
    odd = (
        F.when(value < 5, F.lit(float("nan")))
        .when(value < 10, None)
        .when(value < 15, F.lit(float("inf")))
        .otherwise(value)
    )
    rows = views.dense(spark, sf_dir).select(schema.SEQ, odd.alias("x"), odd.alias("y"))
    filled = validation.fill_missing(rows, ["x"])
    # The scoring rule leaves infinities; they are shown as -1.
    shown = F.when(F.col("x") == float("inf"), -1.0).otherwise(F.col("x"))
    filled = validation.fill_missing(filled, ["y"], infinities=True)
    return filled.withColumn("x", shown)


def label_to_flag(spark, sf_dir):
    rows = views.scored(spark, sf_dir)
    return rows.select(schema.SEQ, scalar.label_to_flag(F.col("anomaly_label")).alias("flag"))


def anomaly_filter(spark, sf_dir):
    rows = reports.anomaly_filter(views.scored(spark, sf_dir))
    return rows.select(schema.SEQ, "account_number", "anomaly_score")


def add_constant_label(spark, sf_dir):
    rows = validation.add_constant_label(views.dense(spark, sf_dir))
    return rows.select(schema.SEQ, "is_anomaly")


# --- look-ups ------------------------------------------------------------------------------


def window_lookup(spark, sf_dir):
    rows = views.dense(spark, sf_dir)
    asks = rows.select(
        F.col(schema.SEQ).alias("ask_id"), "account_number", F.col("posting_timestamp").alias("asked_at")
    )
    hits = lookups.window_lookup(rows.select(*schema_columns()), asks, 60)
    return hits.select("ask_id", schema.SEQ, "newest_rank")


def schema_columns():
    return [schema.SEQ, *schema.REQUIRED_COLUMNS]


def state_asof_lookup(spark, sf_dir):
    state = lookups.state_asof(views.dense(spark, sf_dir), HALF_TIME)
    return state.withColumns({c: F.round(c, 6) for c in ("amount_mean", "amount_std")})


def state_at_times(spark, sf_dir):
    """Two asks an event: a while after it and long before it."""
    rows = views.dense(spark, sf_dir)
    ts = F.col("posting_timestamp")
    ask = F.inline(F.array(
        F.struct(F.lit("after").alias("which"), (ts + F.expr("INTERVAL 90 SECOND")).alias("asked_at")),
        F.struct(F.lit("before").alias("which"), (ts - F.expr("INTERVAL 2000 SECOND")).alias("asked_at")),
    ))
    asks = rows.select(F.col(schema.SEQ).alias("ask_id"), "account_number", ask)
    state = lookups.state_at(rows.select(*schema_columns()), asks)
    return state.withColumns({c: F.round(c, 6) for c in ("amount_mean", "amount_std")})


def map_lookup(spark, sf_dir):
    codes = spark.createDataFrame(list(schema.DESCR_CODES.items()), "descr string, code int")
    rows = views.dense(spark, sf_dir).select(schema.SEQ, "descr")
    return lookups.map_lookup(rows, codes, "descr")


# --- aggregations --------------------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Averages depend on the order of summation in the last digits."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


def score_stats(spark, sf_dir):
    return _rounded(reports.score_stats(views.scored(spark, sf_dir)), "score_mean", "score_std")


def label_summary(spark, sf_dir):
    return _rounded(reports.label_summary(views.scored(spark, sf_dir)), "anomaly_pct")


def phase_counts(spark, sf_dir):
    rows = views.scored(spark, sf_dir)
    return reports.phase_counts(rows, "event_type", ["click", "view", "purchase"])


def account_breakdown(spark, sf_dir):
    return _rounded(reports.account_breakdown(views.scored(spark, sf_dir)), "avg_score")


def contamination_threshold(spark, sf_dir):
    cut = exact_quantile(views.scored(spark, sf_dir), "anomaly_score", 0.01)
    rows = views.scored(spark, sf_dir)
    return rows.agg(
        F.round(F.lit(cut), 9).alias("threshold"),
        F.count_if(F.col("anomaly_score") < cut).alias("n_below"),
    )


def dashboard_metrics(spark, sf_dir):
    """Counts and latency of a stream of two micro-batches; a latency has no value that SQL could know."""
    rows = views.dense(spark, sf_dir).select(*schema_columns(), "value")
    early = F.col("posting_timestamp") < F.lit(HALF_TIME).cast("timestamp")
    source, out, state, progress = (scratch_path(spark, f"dashboard-{n}") for n in ("in", "out", "state", "progress"))
    for part in (rows.where(early), rows.where(~early)):
        part.write.mode("append").parquet(source)
        scored = views.scored_of(readers.stream_files(spark, source, rows.schema))
        service.with_progress(spark, lambda scored=scored: writers.write_stream(scored, out, state), progress)
    told = reports.dashboard_metrics(spark.read.parquet(out), spark.read.parquet(progress))
    return told.withColumn("latency_known", F.col("avg_latency_ms") > 0).drop("avg_latency_ms")


def distinct_accounts_growing(spark, sf_dir):
    """Seven batches of orders by customer, each sketched once; merged, in one pass, and counted."""
    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("account_number"), (F.col("o_orderkey") % 7).alias("batch")
    )
    path = scratch_path(spark, "sketches")
    for batch in range(7):
        reports.add_sketch(path, batch, orders.where(F.col("batch") == batch))
    merged = reports.distinct_accounts_so_far(spark.read.parquet(path))
    whole = reports.distinct_accounts_so_far(reports.account_sketch(orders))
    exact = reports.distinct_accounts(orders)
    both = merged.join(whole.withColumnRenamed("accounts", "whole")).join(exact.withColumnRenamed("accounts", "exact"))
    near = F.abs(F.col("accounts") - F.col("exact")) <= F.col("exact") * reports.SKETCH_ERROR
    return both.select(
        F.col("exact").alias("accounts"), (F.col("accounts") == F.col("whole")).alias("same_in_one_pass"),
        near.alias("within_error"),
    )


def _on_scored(report) -> Query:
    return lambda spark, sf_dir: report(views.scored(spark, sf_dir))


def _on_dense(report) -> Query:
    return lambda spark, sf_dir: report(views.dense(spark, sf_dir))


# --- window features -----------------------------------------------------------------------


def _single_feature(name: str) -> Query:
    def run(spark, sf_dir):
        return feature_table(views.dense(spark, sf_dir)).select(schema.SEQ, name)

    return run


def _calendar_feature(name: str) -> Query:
    """On the times as they are; the dense view knows only a few hours."""
    return lambda spark, sf_dir: feature_table(views.sparse(spark, sf_dir)).select(
        schema.SEQ, name
    )


def full_feature_table(spark, sf_dir):
    return feature_table(views.dense(spark, sf_dir)).select(
        schema.SEQ, "account_number", "posting_timestamp", *schema.FEATURE_COLUMNS
    )


def feature_table_capped(spark, sf_dir):
    rows = views.nation_orders(spark, sf_dir)
    out = feature_table(rows, FeatureConfig(history_cap=5))
    return out.select(schema.SEQ, *schema.FEATURE_COLUMNS)


def feature_table_split(spark, sf_dir):
    """Every nation counts as a very large account and is cut into chunks."""
    rows = views.nation_orders(spark, sf_dir)
    chunk_rows = max(100, rows.count() // 40)
    out = feature_table(rows, FeatureConfig(history_cap=5, chunk_rows=chunk_rows))
    return out.select(schema.SEQ, *schema.FEATURE_COLUMNS)


def feature_table_continued(spark, sf_dir):
    """Later orders continue from the state that the earlier ones left."""
    cfg = FeatureConfig(history_cap=5)
    rows = views.nation_orders(spark, sf_dir)
    early = F.col("posting_timestamp") < F.lit(ORDERS_HALF).cast("timestamp")
    state = checkpoint_state(account_state(rows.where(early), cfg))
    out = feature_table(rows.where(~early), cfg, state=state)
    return out.select(schema.SEQ, *schema.FEATURE_COLUMNS)


def velocity_custom(spark, sf_dir):
    rows = feature_table(
        views.dense(spark, sf_dir), FeatureConfig(velocity_windows=CUSTOM_WINDOWS)
    )
    return rows.select(schema.SEQ, *CUSTOM_WINDOWS)


def last_n_rows(spark, sf_dir):
    out = lookups.last_n_rows(views.dense(spark, sf_dir), 7)
    return out.select("account_number", schema.SEQ, "newest_rank")


def capped_history(spark, sf_dir):
    out = lookups.capped_history(views.dense(spark, sf_dir), 40)
    return out.select("account_number", schema.SEQ)


def retention_filter(spark, sf_dir):
    out = lookups.retention_filter(views.dense(spark, sf_dir), HALF_TIME)
    return out.select(schema.SEQ, "account_number")


def retention_counts(spark, sf_dir):
    return lookups.retention_counts(views.dense(spark, sf_dir), HALF_TIME)


def account_running_stats(spark, sf_dir):
    rows = running_account_stats(views.dense(spark, sf_dir))
    return rows.withColumns(
        {"amount_mean": F.round("amount_mean", 6), "amount_std": F.round("amount_std", 6)}
    )


def arrival_index(spark, sf_dir):
    rows = views.dense(spark, sf_dir).select(schema.SEQ, "account_number")
    return reports.arrival_index(rows)


def flagship(spark, sf_dir):
    """Per account: busiest half minute, largest ten-minute total, last streak."""
    rows = feature_table(views.dense(spark, sf_dir))
    return rows.groupBy("account_number").agg(
        F.count("*").alias("events"),
        F.max("txn_count_30s").alias("busiest_30s"),
        F.max("cumulative_amount_10min").alias("largest_10min"),
        F.max("duplicate_streak").alias("longest_streak"),
    )


# --- order, limits, unions -----------------------------------------------------------------


def sort_account_time(spark, sf_dir):
    rows = reports.sort_account_time(views.dense(spark, sf_dir))
    return rows.select("account_number", "posting_timestamp", schema.SEQ)


def sort_by_score(spark, sf_dir):
    return reports.sort_by_score(views.scored(spark, sf_dir)).select(schema.SEQ, "anomaly_score")


def latest_50(spark, sf_dir):
    rows = reports.latest_rows(views.scored(spark, sf_dir))
    return rows.select(schema.SEQ, "account_number", "anomaly_score", "is_anomaly")


def latest_anomaly(spark, sf_dir):
    row = reports.latest_anomaly(views.scored(spark, sf_dir))
    return row.select(schema.SEQ, "account_number", "anomaly_score")


def _top(spark, sf_dir, n=5):
    """Top entries of an array of named values per scored event."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.expr(sql).alias("value"))
            for name, sql in PSEUDO_CONTRIBUTIONS.items()
        ]
    )
    rows = views.scored(spark, sf_dir)
    return rows.select(schema.SEQ, explain.topn_contributions(pairs, n).alias("top"))


def topn_contributions(spark, sf_dir):
    rows = _top(spark, sf_dir).select(schema.SEQ, F.posexplode("top").alias("pos", "entry"))
    return rows.select(
        schema.SEQ, "pos", F.col("entry.name").alias("name"), F.col("entry.value").alias("contribution")
    )


def topn_names(spark, sf_dir):
    names = explain.topn_names(F.col("top"))
    return _top(spark, sf_dir).select(schema.SEQ, F.array_join(names, ",").alias("names"))


def top3_chips(spark, sf_dir):
    chips = explain.first_contributions(F.col("top"))
    rows = _top(spark, sf_dir).select(schema.SEQ, F.posexplode(chips).alias("pos", "entry"))
    text = F.format_string("%s: %+.3f", F.col("entry.name"), F.col("entry.value"))
    return rows.select(schema.SEQ, "pos", text.alias("chip"))


def union_by_name(spark, sf_dir):
    left = views.dense(spark, sf_dir).select(schema.SEQ, "account_number", "descr")
    right = views.nation_orders(spark, sf_dir).select(
        schema.SEQ, "account_number", "transaction_ac_amount"
    )
    return validation.union_by_name(left, right)


# --- scalar functions ----------------------------------------------------------------------


def parse_mixed_ts(spark, sf_dir):
    rows = _raw_text(spark, sf_dir)
    parsed = scalar.parse_mixed_ts(F.col("posting_timestamp"))
    return rows.select(schema.SEQ, parsed.alias("posting_timestamp"))


def epoch_seconds(spark, sf_dir):
    rows = views.sparse(spark, sf_dir)
    return rows.select(schema.SEQ, scalar.epoch_seconds(F.col("posting_timestamp")).alias("epoch"))


def dc_sign(spark, sf_dir):
    rows = views.nation_orders(spark, sf_dir)
    return rows.select(schema.SEQ, scalar.dc_sign(F.col("debit_credit_code")).alias("dc_sign"))


def encodings(spark, sf_dir):
    sign = scalar.dc_sign(F.col("debit_credit_code"))
    return _defective(spark, sf_dir).select(
        schema.SEQ,
        scalar.descr_encoded(F.col("descr")).alias("descr_encoded"),
        scalar.debit_credit_encoded(sign).alias("debit_credit_code_encoded"),
        scalar.input_source_encoded(F.col("input_source")).alias("input_source_encoded"),
    )


def round_outputs(spark, sf_dir):
    rows = views.scored(spark, sf_dir)
    return rows.select(
        schema.SEQ,
        F.round("anomaly_score", 6).alias("score_6"),
        F.round("transaction_ac_amount", 2).alias("amount_2"),
        F.round(F.col("anomaly_score") * F.lit(1.7), 4).alias("contribution_4"),
    )


def display_texts(spark, sf_dir):
    return views.scored(spark, sf_dir).select(
        schema.SEQ,
        scalar.mask_account(F.col("account_number")).alias("masked"),
        scalar.mask_account(F.col("account_number"), 3).alias("masked_3"),
        scalar.clock_text(F.col("posting_timestamp")).alias("clock"),
        scalar.format_amount(F.col("transaction_ac_amount")).alias("amount_text"),
        scalar.format_score(F.col("anomaly_score")).alias("score_text"),
        scalar.channel_label(F.col("input_source")).alias("channel"),
    )


def _display_text(name: str) -> Query:
    return lambda spark, sf_dir: display_texts(spark, sf_dir).select(schema.SEQ, name)


def feature_description(spark, sf_dir):
    """Each event type's name and one feature name, described."""
    names = list(FEATURE_DESCRIPTIONS)
    pick = F.element_at(
        F.array(*[F.lit(n) for n in names]), (F.col("seq") % len(names) + 1).cast("int")
    )
    name = F.when(F.col("descr") == "error", F.lit("server_error_event")).otherwise(pick)
    rows = views.dense(spark, sf_dir).select(schema.SEQ, name.alias("name"))
    return rows.withColumn("description", scalar.feature_description(F.col("name")))


def result_json(spark, sf_dir):
    text = scalar.result_json(schema.SEQ, "account_number", "descr", "anomaly_label", "is_anomaly")
    return views.scored(spark, sf_dir).select(schema.SEQ, text.alias("json"))


# --- models --------------------------------------------------------------------------------


def iforest_fit(spark, sf_dir):
    _, model = _fitted_forest(spark, sf_dir)
    return _tree_checks(_node_rows(spark, model))


def iforest_score(spark, sf_dir):
    """Every row by a fitted forest, whether its verdict agrees with itself, and by the fixed one, whose scores SQL knows."""
    features, model = _fixed_forest(spark, sf_dir)
    fitted = _forest_of(features)
    flagged = _flagged(forest.score_forest(features, fitted))
    return _verdicts(forest.score_forest(flagged, model), "account_number", "flag_is_sign")


def shap_topk(spark, sf_dir):
    """The five strongest contributions of each row that the fixed forest flags, and of no other; what all leave unexplained.

    Beside them, over all rows: whether a fitted forest explains its flagged rows and only these, and the largest part of a
    path length, less the mean one, that all contributions of such a row leave open.
    """
    features, model = _fixed_forest(spark, sf_dir)
    everything = len(schema.FEATURE_COLUMNS)
    rows = explain.with_contributions(features, model, True, "every")
    total = F.aggregate("every", F.lit(0.0), lambda s, entry: s + entry["value"])
    whole = F.size("every") == everything
    entry = F.posexplode(explain.topn_contributions(F.col("every"), 5)).alias("place", "entry")
    top = rows.where("every is not null").select(
        schema.SEQ, F.round(F.abs(_unexplained(model, total)), 6).alias("unexplained"), whole.alias("all_features"), entry
    ).select(
        schema.SEQ, (F.col("place") + 1).alias("place"), F.col("entry.name").alias("name"),
        F.col("entry.value").alias("value"), "unexplained", "all_features",
    )
    fitted = _forest_of(features)
    explained = explain.score_and_explain(features, fitted, everything)
    total = F.aggregate("top_features", F.lit(0.0), lambda s, entry: s + entry["value"])
    whole = F.size("top_features") == everything
    right = F.when(F.col("is_anomaly"), whole).otherwise(F.col("top_features").isNull())
    told = explained.agg(
        F.count("*").alias("n_rows"), F.min(right).alias("flagged_are_explained"),
        # Contributions are shown with four decimals.
        F.round(F.max(F.when(F.col("is_anomaly"), F.abs(_unexplained(fitted, total)))), 2).alias("largest_gap"),
    )
    return top.crossJoin(F.broadcast(told))


def _unexplained(model, total):
    """What ``total``, all contributions of a row, leaves of its path length less the mean one."""
    raw = F.col("anomaly_score") + F.lit(model.offset)
    path = -F.log2(-raw) * F.lit(float(forest.average_path(model.max_samples)))
    return total + F.lit(explain.base_value(explain.leaf_boxes(model))) - path


def _vectors(spark, sf_dir):
    rows = views.table(spark, sf_dir, "embeddings")
    names = [f"e{i}" for i in range(64)]
    columns = [F.element_at("embedding", i + 1).cast("double").alias(n) for i, n in enumerate(names)]
    return rows.select(F.col("vec_id").alias(schema.SEQ), *columns), names


def lof_fit(spark, sf_dir):
    rows, names = _vectors(spark, sf_dir)
    model = lof.fit_lof(rows, names)
    return model.refs.select(
        F.col("rid").alias(schema.SEQ),
        F.round("kdist", 6).alias("k_distance"),
        F.round("lrd", 6).alias("density"),
    )


def lof_score(spark, sf_dir):
    rows, names = _vectors(spark, sf_dir)
    scored = lof.score_lof(rows, lof.fit_lof(rows, names))
    return scored.select(schema.SEQ, F.round("anomaly_score", 6).alias("anomaly_score"), "anomaly_label")


def _fitted_svm(spark, sf_dir):
    features = jobs.written(feature_table(views.dense(spark, sf_dir)), "features")
    return features, ocsvm.fit_ocsvm(features, schema.FEATURE_COLUMNS)


def ocsvm_fit(spark, sf_dir):
    """Rows inside and outside; how far from the shortest weights the fit may be, as a part of their length."""
    features, model = _fitted_svm(spark, sf_dir)
    length = sum(w * w for w in model.weights)
    return ocsvm.score_ocsvm(features, model).agg(
        F.lit(len(model.weights)).alias("components"), F.count("*").alias("n_rows"),
        F.count_if("is_anomaly").alias("n_outside"), F.lit(0 <= model.gap < 0.25 * length).alias("near_the_best"),
    )


def ocsvm_score(spark, sf_dir):
    """Every row by a fitted machine, whether its verdict agrees with itself, and by the fixed one, whose scores SQL knows."""
    features, fitted = _fitted_svm(spark, sf_dir)
    model = fixed.svm()
    margins = jobs.written(ocsvm.score_ocsvm(features, model).select("anomaly_score"), "margins")
    model.offset = exact_quantile(margins, "anomaly_score", 0.01)
    flagged = _flagged(ocsvm.score_ocsvm(features, fitted))
    return _verdicts(ocsvm.score_ocsvm(flagged, model), "account_number", "flag_is_sign")


def model_select(spark, sf_dir):
    """Two kinds of models, fitted, saved, loaded and applied by name."""
    features = jobs.written(feature_table(views.dense(spark, sf_dir)), "features")
    kinds = {"IsolationForest": {"n_estimators": 20, "contamination": 0.01}, "OneClassSVM": {"steps": 2, "n_components": 32}}
    parts = []
    for kind, params in kinds.items():
        path = scratch_path(spark, f"selected-{kind}")
        select.save(spark, select.fit(features, schema.FEATURE_COLUMNS, kind, params), path)
        model = select.load(spark, path)
        scored = select.score(features, model)
        parts.append(scored.select(
            F.lit(model.kind).alias("kind"), F.lit(select.explains(model)).alias("explains"),
            F.col("is_anomaly").cast("int").alias("flag"),
        ))
    both = parts[0].unionByName(parts[1])
    return both.groupBy("kind", "explains").agg(F.count("*").alias("n_rows"), F.sum("flag").alias("n_flagged"))


def train_job(spark, sf_dir):
    """The counts, and how far the reported statistics are from those of the scores themselves."""
    events = _untimely(spark, sf_dir)
    result = jobs.train_job(events, params=FAST_FOREST)
    valid, _ = validation.validate_split(events)
    features = validation.fill_missing(feature_table(valid), schema.FEATURE_COLUMNS, True)
    scores = forest.score_forest(features, result.model)
    value = F.col("anomaly_score")
    told = scores.agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"), F.count_if("is_anomaly").alias("n"),
    ).first()
    gap = max(abs(told[c] - result.score_stats[c]) for c in ("min", "max", "mean", "std"))
    row = (result.rows, result.rejected, result.accounts, result.anomalies, told["n"], round(gap, 9))
    names = "n_rows long, rejected long, accounts long, anomalies long, scored_anomalies long, stats_gap double"
    return spark.createDataFrame([row], names)


def batch_score_job(spark, sf_dir):
    """The features the job wrote, with whether each row's score, flag and names go together."""
    events = views.dense(spark, sf_dir)
    model = jobs.train_job(events, params=FAST_FOREST).model
    scored = jobs.score_job(events, model).scored
    named = F.size("top_5_features") == 5
    together = F.when(F.col("anomaly_score") < 0, F.col("is_anomaly") & named).otherwise(
        ~F.col("is_anomaly") & F.col("top_5_features").isNull()
    )
    return scored.select(schema.SEQ, *schema.FEATURE_COLUMNS, together.alias("goes_together"))


def _untimely(spark, sf_dir):
    """Defective rows, of which some have no time and some no amount."""
    rows = _defective(spark, sf_dir)
    gone = F.col("value").between(20, 22)
    return rows.withColumns(
        {
            "posting_timestamp": F.when(gone, None).otherwise(F.col("posting_timestamp")),
            "transaction_ac_amount": F.when(F.col("value").between(30, 31), None).otherwise(
                F.col("transaction_ac_amount")
            ),
        }
    )


def batch_score_job_rejects(spark, sf_dir):
    """Scored and rejected rows are together all rows that were read."""
    events = _untimely(spark, sf_dir)
    model = jobs.train_job(events, params=FAST_FOREST).model
    result = jobs.score_job(events, model)
    scored = result.scored.select(schema.SEQ, F.lit("scored").alias("outcome"))
    return scored.unionByName(result.rejects.select(schema.SEQ, F.col("reject_reason").alias("outcome")))


# --- streams -------------------------------------------------------------------------------


def stream_features(spark, sf_dir):
    rows = streams.stream_features(views.dense_of(_event_stream(spark, sf_dir)))
    return _drained(spark, rows, "features")[0].select(
        schema.SEQ, "account_number", "posting_timestamp", *schema.FEATURE_COLUMNS
    )


def stream_score(spark, sf_dir):
    _, model = _fixed_forest(spark, sf_dir)
    rows = streams.stream_score(views.dense_of(_event_stream(spark, sf_dir)), model)
    return _verdicts(_drained(spark, rows.drop("top_features"), "scores")[0])


def stream_score_rejects(spark, sf_dir):
    """Every row of a defective stream comes out, scored or with a reason."""
    _, model = _fitted_forest(spark, sf_dir)
    path = scratch_path(spark, "defective")
    _untimely(spark, sf_dir).select(*schema_columns()).write.parquet(path)
    rows = streams.stream_score(_stream_of(spark, path, 10_000), model).drop("top_features")
    out, _ = _drained(spark, rows, "rejects")
    scored = F.col("anomaly_score").isNotNull() & F.col("is_anomaly").isNotNull()
    return out.select(
        schema.SEQ, F.coalesce("reject_reason", F.when(scored, F.lit("scored"))).alias("outcome")
    )


def late_rescored(spark, sf_dir):
    """Late rows get, in batch, the score they would have had in time."""
    _, model = _fixed_forest(spark, sf_dir)
    rows = views.dense(spark, sf_dir)
    late = F.col("descr") == "PayNow"
    path = _in_batches(spark, rows.where(~late), rows.where(late))
    stream = streams.stream_score(_stream_of(spark, path), model).drop("top_features")
    behind = _drained(spark, stream, "late")[0].where("is_late")
    return _verdicts(streams.rescore_late(rows, behind.where("anomaly_score is null"), model))


def _in_batches(spark, *parts):
    """A file stream that delivers tables one after the other, each in as many files as a batch takes."""
    path = scratch_path(spark, "batches")
    for part in parts:
        part.select(*schema_columns()).repartition(BATCH_FILES).write.mode("append").parquet(path)
    return path


def _stream_of(spark, path, max_files=BATCH_FILES):
    names = schema_columns()
    columns = [f for f in schema.EVENT_SCHEMA.fields if f.name in names]
    return readers.stream_files(spark, path, T.StructType(columns), max_files=max_files)


def stream_batch_score(spark, sf_dir):
    """A bounded list of events through the stream, in order, until drained."""
    _, model = _fixed_forest(spark, sf_dir)
    rows = views.dense(spark, sf_dir)
    early = F.col("posting_timestamp") < F.lit(HALF_TIME).cast("timestamp")
    path = _in_batches(spark, rows.where(early), rows.where(~early))
    scored = streams.stream_score(_stream_of(spark, path), model).drop("top_features")
    return _verdicts(_drained(spark, scored, "scores")[0])


def warm_start(spark, sf_dir):
    """The stream begins with the state of all earlier events."""
    rows = views.dense(spark, sf_dir)
    early = F.col("posting_timestamp") < F.lit(HALF_TIME).cast("timestamp")
    state: AccountState = checkpoint_state(account_state(rows.where(early)))
    path = scratch_path(spark, "later")
    rows.where(~early).select(*schema_columns()).write.parquet(path)
    out = streams.stream_features(_stream_of(spark, path, 10_000), initial=state)
    return _drained(spark, out, "warm")[0].select(schema.SEQ, *schema.FEATURE_COLUMNS)


HOT_CHUNK = 500


def _one_hot_account(spark, sf_dir):
    """Dense rows of which one account holds a third."""
    hot = F.col(schema.SEQ) % 3 == 0
    return views.dense(spark, sf_dir).withColumn(
        "account_number", F.when(hot, F.lit("hot")).otherwise(F.col("account_number"))
    )


def stream_hot_account(spark, sf_dir):
    """Two micro-batches in which one account holds a third of the rows, split over many tasks."""
    rows = _one_hot_account(spark, sf_dir)
    early = F.col("posting_timestamp") < F.lit(HALF_TIME).cast("timestamp")
    parts = [rows.where(early), rows.where(~early)]
    source, out, state = (scratch_path(spark, n) for n in ("hot-source", "hot-features", "hot-checkpoint"))
    cfg = FeatureConfig(chunk_rows=HOT_CHUNK)
    for part in parts:
        part.select(*schema_columns()).write.mode("append").parquet(source)
        tables.start_features(_stream_of(spark, source, 10_000), out, state, cfg).awaitTermination()
    return tables.read_features(spark, out).select(schema.SEQ, *schema.FEATURE_COLUMNS)


def late_data(spark, sf_dir):
    """Purchases arrive after everything else; those behind their account are late."""
    rows = views.dense(spark, sf_dir)
    late = F.col("descr") == "PayNow"
    path = _in_batches(spark, rows.where(~late), rows.where(late))
    out = streams.stream_features(_stream_of(spark, path))
    return _drained(spark, out, "late")[0].select(schema.SEQ, "is_late")


def late_bounded(spark, sf_dir):
    """The same with bounded retention: rows far behind the watermark come out too.

    The first two batches move the watermark; Spark holds rows against that of the batch before.
    """
    rows = views.dense(spark, sf_dir)
    late = F.col("descr") == "PayNow"
    early = F.col("posting_timestamp") < F.lit(HALF_TIME).cast("timestamp")
    path = _in_batches(spark, rows.where(~late & early), rows.where(~late & ~early), rows.where(late))
    out = streams.stream_features(_stream_of(spark, path), retention="bounded")
    return _drained(spark, out, "late-bounded")[0].select(schema.SEQ, "is_late")


def state_retention(spark, sf_dir):
    """What is still remembered after a stream with bounded retention."""
    rows = views.dense(spark, sf_dir)
    early = F.col("posting_timestamp") < F.lit(HALF_TIME).cast("timestamp")
    path = _in_batches(spark, rows.where(early), rows.where(~early))
    out = streams.stream_features(_stream_of(spark, path), retention="bounded")
    return streams.state_inspect(spark, _drained(spark, out, "bounded")[1])


def state_reset(spark, sf_dir):
    """After a reset the same stream begins anew, without a memory of its first run."""
    rows = streams.stream_features(views.dense_of(_event_stream(spark, sf_dir)))
    _, checkpoint = _drained(spark, rows, "first-run")
    streams.state_reset(spark, checkpoint)
    path = scratch_path(spark, "second-run")
    writers.write_stream(rows, path, checkpoint).awaitTermination()
    return spark.read.parquet(path).select(
        schema.SEQ, "is_late", "same_amount_frequency", "duplicate_streak", "time_since_last_txn"
    )


def state_inspect(spark, sf_dir):
    rows = streams.stream_features(views.dense_of(_event_stream(spark, sf_dir)))
    return streams.state_inspect(spark, _drained(spark, rows, "inspect")[1])


def registry() -> dict[str, Query]:
    named: dict[str, Query] = {
        "flagship": flagship,
        "read_csv": read_csv,
        "read_csv_narrow": read_csv_narrow,
        "read_csv_wide": read_csv_wide,
        "read_parquet": read_parquet,
        "require_columns": require_columns,
        "select_cast_key": select_cast_key,
        "write_scored_csv": write_scored_csv,
        "text_guard": text_guard,
        "write_training_snapshot": write_training_snapshot,
        "save_model": save_model,
        "load_model": load_model,
        "model_reload": model_reload,
        "stream_source": stream_source,
        "alert_sink": alert_sink,
        "validate_split": validate_split,
        "bad_timestamp_sample": bad_timestamp_sample,
        "passthrough_cols": passthrough_cols,
        "ordered_vector": ordered_vector,
        "fill_missing": fill_missing,
        "label_to_flag": label_to_flag,
        "anomaly_filter": anomaly_filter,
        "add_constant_label": add_constant_label,
        "window_lookup": window_lookup,
        "state_asof_lookup": state_asof_lookup,
        "state_at_times": state_at_times,
        "map_lookup": map_lookup,
        "score_summary": _on_scored(reports.score_summary),
        "distinct_accounts": _on_dense(reports.distinct_accounts),
        "distinct_accounts_growing": distinct_accounts_growing,
        "score_stats": score_stats,
        "train_anomaly_rate": _on_scored(reports.train_anomaly_rate),
        "label_summary": label_summary,
        "account_breakdown": account_breakdown,
        "dashboard_metrics": dashboard_metrics,
        "phase_counts": phase_counts,
        "score_histogram": _on_scored(reports.score_histogram),
        "contamination_threshold": contamination_threshold,
        "state_stats": _on_dense(lambda rows: reports.state_stats(rows, 60)),
        **{
            name: _single_feature(name)
            for name in schema.FEATURE_COLUMNS
            if name not in ("hour_of_day", "is_business_hours", "dc_sign")
        },
        "hour_of_day": _calendar_feature("hour_of_day"),
        "is_business_hours": _calendar_feature("is_business_hours"),
        "velocity_custom": velocity_custom,
        "last_n_rows": last_n_rows,
        "capped_history": capped_history,
        "retention_filter": retention_filter,
        "retention_counts": retention_counts,
        "running_account_stats": account_running_stats,
        "arrival_index": arrival_index,
        "feature_table": full_feature_table,
        "feature_table_capped": feature_table_capped,
        "feature_table_split": feature_table_split,
        "feature_table_continued": feature_table_continued,
        "sort_account_time": sort_account_time,
        "sort_by_score": sort_by_score,
        "latest_50": latest_50,
        "latest_anomaly": latest_anomaly,
        "topn_contributions": topn_contributions,
        "topn_names": topn_names,
        "top3_chips": top3_chips,
        "union_by_name": union_by_name,
        "parse_mixed_ts": parse_mixed_ts,
        "epoch_seconds": epoch_seconds,
        "dc_sign": dc_sign,
        "encodings": encodings,
        "round_outputs": round_outputs,
        "mask_account": _display_text("masked"),
        "clock_text": _display_text("clock"),
        "format_amount": _display_text("amount_text"),
        "format_score": _display_text("score_text"),
        "channel_label": _display_text("channel"),
        "feature_description": feature_description,
        "result_json": result_json,
        "iforest_fit": iforest_fit,
        "iforest_score": iforest_score,
        "lof_fit": lof_fit,
        "lof_score": lof_score,
        "ocsvm_fit": ocsvm_fit,
        "ocsvm_score": ocsvm_score,
        "shap_topk": shap_topk,
        "model_select": model_select,
        "train_job": train_job,
        "batch_score_job": batch_score_job,
        "batch_score_job_rejects": batch_score_job_rejects,
        "stream_features": stream_features,
        "stream_score": stream_score,
        "stream_score_rejects": stream_score_rejects,
        "late_rescored": late_rescored,
        "stream_batch_score": stream_batch_score,
        "warm_start": warm_start,
        "stream_hot_account": stream_hot_account,
        "late_data": late_data,
        "late_bounded": late_bounded,
        "state_retention": state_retention,
        "state_inspect": state_inspect,
        "state_reset": state_reset,
    }

    def plain(query: Query) -> Query:
        return lambda spark, sf_dir: views.tidy(query(spark, sf_dir))

    return {name: plain(query) for name, query in named.items()}
