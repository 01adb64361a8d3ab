import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_features import make_events, to_df

from acctpulse import schema
from acctpulse.functions import scalar
from acctpulse.models import select
from acctpulse.operators import lookups, reports, validation
from acctpulse.operators.features import account_state, feature_table, load_state, save_state
from acctpulse.operators.topn import top_n_per_key
from acctpulse.plans import jobs
from acctpulse.sources import readers, writers


def test_jdbc_options():
    base = {"url": "jdbc:mysql://db/deposit", "user": "u", "password": "p"}
    plain = readers.jdbc_options(**base, query="SELECT 1")
    assert plain["query"] == "SELECT 1" and "dbtable" not in plain
    split = readers.jdbc_options(
        **base, query="SELECT * FROM t", partition_column="id", lower_bound=0, upper_bound=9, partitions=4
    )
    assert split["dbtable"] == "(SELECT * FROM t) AS source_rows"
    assert split["numPartitions"] == "4" and "query" not in split
    with pytest.raises(ValueError):
        readers.jdbc_options(**base)
    with pytest.raises(ValueError):
        readers.jdbc_options(**base, table="t", partition_column="id")


def test_kafka_options():
    options = readers.kafka_options("host:9092", "transactions")
    assert options["subscribe"] == "transactions" and "maxOffsetsPerTrigger" in options


def test_unknown_suffix_is_refused(spark):
    with pytest.raises(ValueError, match="Unsupported file format"):
        readers.read_events(spark, "rows.xlsx")


def test_csv_round_trip_keeps_long_keys(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    df = to_df(spark, make_events(41, n=30)).withColumn(
        "account_number", F.lit("1000000000000000042")
    )
    stamp = {"timestampFormat": writers.TIMESTAMP_TEXT}
    df.write.options(header=True, **stamp).csv(path)
    columns = [f for f in schema.RAW_SCHEMA.fields if f.name in df.columns]
    rows = readers.read_events(spark, path, columns=schema.T.StructType(columns))
    assert rows.where(F.size(readers.BAD_FIELDS) > 0).count() == 0
    parsed = validation.parse_timestamps(rows.drop(readers.BAD_FIELDS))
    assert {r["account_number"] for r in parsed.collect()} == {"1000000000000000042"}
    assert parsed.exceptAll(df.select(parsed.columns)).count() == 0


def test_mixed_timestamps(spark):
    texts = {
        "2024-01-02 03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04:05.678901": dt.datetime(2024, 1, 2, 3, 4, 5, 678901),
        "2024-01-02 03:04:05.5": dt.datetime(2024, 1, 2, 3, 4, 5, 500000),
        "2024-01-02T03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05.25": dt.datetime(2024, 1, 2, 3, 4, 5, 250000),
        "2024-01-02": dt.datetime(2024, 1, 2),
        "soon": None,
    }
    df = spark.createDataFrame(list(enumerate(texts)), "seq int, posting_timestamp string")
    got = {
        r["posting_timestamp"]: r["p"]
        for r in df.withColumn("p", scalar.parse_mixed_ts(F.col("posting_timestamp"))).collect()
    }
    assert got == texts
    with pytest.raises(ValueError, match="soon"):
        validation.parse_timestamps(df)
    assert validation.parse_timestamps(df, strict=False).where("posting_timestamp is null").count() == 1


def test_required_columns(spark):
    df = to_df(spark, make_events(42, n=3))
    assert validation.require_columns(df) is df
    with pytest.raises(ValueError, match="input_source"):
        validation.require_columns(df.drop("input_source"))


def test_validation_loses_no_row(spark):
    df = to_df(spark, make_events(43, n=100))
    valid, rejected = validation.validate_split(df)
    assert valid.count() + rejected.count() == 100
    assert {r["reject_reason"] for r in rejected.collect()} == {"bad debit_credit_code"}


def test_scored_csv_is_guarded(spark, tmp_path):
    path = str(tmp_path / "scored")
    df = spark.createDataFrame([("12", [1.0]), ("34", None)], "account_number string, top array<double>")
    writers.write_scored_csv(df, path)
    lines = sorted(r["value"] for r in spark.read.text(path).collect())
    assert '"=""12""",[1.0]' in lines and "account_number,top" in lines
    assert writers.default_output("a/b.csv") == "a/scored_b.csv"


def test_top_n_per_key(spark):
    df = spark.range(1000).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("k")
    )
    rows = top_n_per_key(df, ["k"], [F.desc("seq")], 5, rank="r", salts=7).collect()
    assert {(r["k"], r["seq"]) for r in rows if r["r"] == 1} == {("hot", 999), ("cold", 998)}
    assert len(rows) == 10


def test_window_lookup_counts_newest_rows_only(spark):
    events = make_events(44, n=200)
    df = to_df(spark, events)
    asks = df.select(
        F.col("seq").alias("ask_id"), "account_number", F.col("posting_timestamp").alias("asked_at")
    )
    hits = lookups.window_lookup(df, asks, 600, cap=3).groupBy("ask_id").count()
    full = lookups.window_lookup(df, asks, 600).groupBy("ask_id").count()
    want = {r["ask_id"]: min(r["count"], 3) for r in full.collect()}
    assert {r["ask_id"]: r["count"] for r in hits.collect()} == want


def test_arrival_index_over_many_partitions(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "seq").repartition(9)
    rows = reports.arrival_index(df).orderBy("seq").collect()
    assert [r["arrival"] for r in rows] == list(range(1, len(rows) + 1))


def test_histogram_keeps_every_row(spark):
    rows = [(float(i % 7), i % 7 == 0) for i in range(70)]
    df = spark.createDataFrame(rows, "anomaly_score double, is_anomaly boolean")
    bins = reports.score_histogram(df, 30).collect()
    assert sum(r["n"] for r in bins) == 70 and max(r["bin"] for r in bins) == 30
    flat = reports.score_histogram(df.withColumn("anomaly_score", F.lit(1.0)), 30)
    assert {r["bin"] for r in flat.collect()} == {1}


def test_empty_summaries(spark):
    empty = spark.createDataFrame([], "seq long, anomaly_score double, is_anomaly boolean")
    assert tuple(reports.score_summary(empty).first()) == (0, 0, 0.0)
    assert reports.latest_anomaly(empty).count() == 0


def test_state_survives_saving(spark, tmp_path):
    df = to_df(spark, make_events(45, n=80))
    state = account_state(df)
    save_state(state, str(tmp_path / "state"))
    loaded = load_state(spark, str(tmp_path / "state"))
    for name, table in vars(state).items():
        other = getattr(loaded, name).select(table.columns)
        assert other.count() == table.count()
        assert table.exceptAll(other).count() == 0


def test_train_and_score_jobs(spark, tmp_path):
    events = to_df(spark, make_events(46, n=400))
    df, rejects = validation.validate_split(events)
    n = df.count()
    path = str(tmp_path / "model")
    trained = jobs.train_job(
        events, params={"n_estimators": 20, "contamination": 0.05}, model_path=path
    )
    assert trained.rows == n == 400 - rejects.count() and trained.accounts == 3
    assert trained.rejected == 400 - n > 0
    assert trained.anomalies == pytest.approx(n / 20, abs=1)
    scored, _, summary = jobs.score_job(events, jobs.load_model(spark, path), keep=["input_source"])
    rows = scored.collect()
    total = summary.first()
    assert len(rows) == total["total_transactions"] == n and total["total_read"] == 400
    assert total["anomalies_detected"] == sum(r["is_anomaly"] for r in rows) == trained.anomalies
    for r in rows:
        assert (len(r["top_5_features"]) == 5) if r["is_anomaly"] else r["top_5_features"] is None
    expected = {r["seq"]: r["txn_count_30s"] for r in feature_table(df).collect()}
    assert {r["seq"]: r["txn_count_30s"] for r in rows} == expected
    with pytest.raises(ValueError):
        jobs.train_job(df, model_type="Nope")
    with pytest.raises(ValueError):
        select.fit(df, ["seq"], "Nope")
