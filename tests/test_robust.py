"""What must not happen: lost rows, silent fallbacks, rules that change with the size."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from test_features import make_events, to_df
from test_streaming import drain, feed, source

from acctpulse import schema, session
from acctpulse.functions.scalar import finite_or_zero
from acctpulse.models import forest
from acctpulse.operators import lookups
from acctpulse.operators.features import feature_table
from acctpulse.operators.validation import validate_split
from acctpulse.plans import jobs
from acctpulse.sources import readers
from acctpulse.sources.writers import write_stream
from acctpulse.streaming import jobs as streams


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake)


def untimed(spark, n=80):
    rows = to_df(spark, make_events(41, n=n))
    gone = F.col(schema.SEQ) % 5 == 0
    return rows.withColumn("posting_timestamp", F.when(~gone, F.col("posting_timestamp")))


def test_rows_without_a_time_stay_in_the_feature_table(spark):
    rows = untimed(spark)
    out = feature_table(rows)
    assert out.count() == rows.count()
    lost = out.where("posting_timestamp is null")
    assert lost.count() == rows.where("posting_timestamp is null").count() > 0
    assert lost.where(" or ".join(f"{c} is not null" for c in schema.FEATURE_COLUMNS)).count() == 0
    rest = feature_table(rows.where("posting_timestamp is not null"))
    assert out.where("posting_timestamp is not null").exceptAll(rest).count() == 0


def test_jobs_account_for_every_row(spark, tmp_path):
    rows = untimed(spark)
    trained = jobs.train_job(rows, params={"n_estimators": 5})
    assert trained.rows + trained.rejected == rows.count() and trained.rejected > 0
    result = jobs.score_job(rows, trained.model, output=str(tmp_path / "scored"))
    summary = result.summary.first()
    assert summary["total_read"] == rows.count() == result.scored.count() + result.rejects.count()
    assert summary["rejected"] == trained.rejected
    reasons = {r[0] for r in result.rejects.select("reject_reason").distinct().collect()}
    assert "missing posting_timestamp" in reasons and None not in reasons


def test_jobs_read_their_events_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = untimed(spark)
    events, n = rows.mapInArrow(counted, rows.schema), rows.count()
    trained = jobs.train_job(events, params={"n_estimators": 5})
    assert read.value == n
    result = jobs.score_job(events, trained.model)
    assert result.scored.count() + result.rejects.count() == n
    assert read.value == 2 * n


def test_scored_and_rejected_rows_keep_their_columns(spark):
    rows = untimed(spark).withColumns({"Note": F.concat(F.lit("n"), schema.SEQ), "odd.name": F.lit(1)})
    rows = rows.withColumnRenamed(schema.SEQ, "SEQ")  # names are the same whatever their case
    trained = jobs.train_job(rows.withColumnRenamed("SEQ", schema.SEQ), params={"n_estimators": 5})
    result = jobs.score_job(rows, trained.model, keep=["Note", "`odd.name`"])
    valid, rejects = validate_split(rows)
    assert result.rejects.columns == rejects.columns
    assert result.rejects.exceptAll(rejects).count() == rejects.exceptAll(result.rejects).count() == 0
    want = valid.select(schema.SEQ, "Note", "`odd.name`")
    got = result.scored.select(schema.SEQ, "Note", "`odd.name`")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < got.count()


def test_missing_and_infinite_numbers_become_zero(spark):
    values = [None, float("nan"), float("inf"), -float("inf"), 1.5, -2.0, 0.0]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i")
    got = {b: [r[0] for r in rows.select(finite_or_zero(F.col("v"), b)).collect()] for b in (True, False)}
    assert got[True] == [0.0, 0.0, 0.0, 0.0, 1.5, -2.0, 0.0]
    assert got[False] == [0.0, 0.0, float("inf"), -float("inf"), 1.5, -2.0, 0.0]


def test_a_row_without_an_amount_does_not_stop_a_stream(spark, tmp_path):
    events = sorted(make_events(42, n=60), key=lambda e: (e["us"], e["seq"]))
    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    rows = to_df(spark, events)
    odd = F.col(schema.SEQ) % 7 == 0
    rows = rows.withColumn("transaction_ac_amount", F.when(~odd, F.col("transaction_ac_amount")))
    rows.coalesce(1).write.parquet(src)
    drain(write_stream(streams.stream_features(source(spark, src)), out, cp))
    got = spark.read.parquet(out)
    assert got.count() == len(events)
    assert got.where("transaction_ac_amount is null and txn_count_1s is not null").count() == 0
    assert got.where("transaction_ac_amount is not null and txn_count_1s is null").count() == 0


def test_state_reset_begins_anew(spark, tmp_path):
    events = sorted(make_events(43, n=40), key=lambda e: (e["us"], e["seq"]))
    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    feed(spark, src, events)
    drain(write_stream(streams.stream_features(source(spark, src)), out, cp))
    streams.state_reset(spark, cp)
    again = str(tmp_path / "again")
    drain(write_stream(streams.stream_features(source(spark, src)), again, cp))
    columns = [schema.SEQ, *schema.FEATURE_COLUMNS]
    first, second = (spark.read.parquet(p).select(*columns) for p in (out, again))
    assert first.exceptAll(second).count() == 0 and second.count() == len(events)


def points(spark, n):
    return spark.range(n).select(F.col("id").alias(schema.SEQ), F.rand(1).alias("x"), F.rand(2).alias("y"))


def test_a_forest_refuses_rows_that_it_cannot_tell_apart(spark):
    rows = points(spark, 300)
    with pytest.raises(ValueError, match="have no seq"):
        forest.fit_forest(rows.withColumn(schema.SEQ, F.lit(None).cast("bigint")), ["x", "y"])
    with pytest.raises(Exception, match="not unique"):
        forest.fit_forest(rows.withColumn(schema.SEQ, F.lit(1).cast("bigint")), ["x", "y"], 3)


def test_sampling_has_one_rule_at_every_size(spark):
    """Around the size where the pool starts to be smaller than the table, trees keep their rows."""
    picked = {}
    for n in (235, 240, 245, 490):  # 5 trees of 16 rows, three candidates each: 240
        rows = forest.sample_per_tree(points(spark, n), n, 5, 16, 42)
        per_tree = rows.groupBy("tree").count().collect()
        assert len(per_tree) == 5 and all(r["count"] == 16 for r in per_tree)
        picked[n] = {(r["tree"], r[schema.SEQ]) for r in rows.collect()}
    assert len(picked[235] & picked[240]) > 60 and len(picked[240] & picked[245]) > 60


def test_a_code_that_is_listed_twice_multiplies_no_row(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "descr string")
    codes = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "descr string, code int")
    got = {r["descr"]: r["code"] for r in lookups.map_lookup(rows, codes, "descr").collect()}
    assert got == {"a": 1, "b": 2, "c": -1, None: -1}


def test_the_asked_time_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    to_df(spark, make_events(44, n=50)).write.parquet(path)
    state = lookups.state_asof(spark.read.parquet(path), "1970-01-01 01:00:00")
    plan = state._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "LessThanOrEqual(posting_timestamp" in pushed
    assert plan.count("Window") < 6


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "one"
    path.mkdir()
    (path / "a.csv").write_text(
        "descr,extra,transaction_ac_amount,account_number,posting_timestamp\n"
        "ATM,x,12.50,0012,2024-01-01 00:00:00\n"
        "GIRO,y,twelve,0013,2024-01-01 00:00:01.5\n"
        "GIRO,y,,0013,\n"
    )
    rows = readers.with_sequence(readers.read_csv(spark, str(path)).drop(schema.SEQ))
    got = rows.orderBy(schema.SEQ).collect()
    assert [r[schema.SEQ] for r in got] == [1, 2, 3]
    assert [r["account_number"] for r in got] == ["0012", "0013", "0013"]
    assert [None if r["transaction_ac_amount"] is None else float(r["transaction_ac_amount"]) for r in got] == [
        12.5, None, None]
    assert [r[readers.BAD_FIELDS] for r in got] == [[], ["transaction_ac_amount"], []]
    assert got[0]["input_source"] is None and "extra" not in rows.columns
    (path / "b.csv").write_text("account_number,descr\n1,ATM\n")
    with pytest.raises(Exception, match="header|CSV"):
        readers.read_csv(spark, str(path)).collect()
