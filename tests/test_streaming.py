import datetime as dt

import pytest
from pyspark.sql import functions as F
from brute import features
from test_features import assert_matches, make_events, to_df

from acctpulse import schema
from acctpulse.models import forest
from acctpulse.operators import features as features_module
from acctpulse.operators.features import account_state, feature_table
from acctpulse.operators.windows import FeatureConfig
from acctpulse.sources.readers import stream_files
from acctpulse.sources.writers import write_alerts, write_stream
from acctpulse.streaming import jobs, tables
from acctpulse.streaming import state as state_module

EVENTS = schema.EVENT_SCHEMA


def feed(spark, folder, events):
    to_df(spark, events).coalesce(1).write.mode("append").parquet(folder)


def drain(query):
    query.awaitTermination(300)
    assert query.exception() is None


def source(spark, folder):
    return stream_files(spark, folder, max_files=1)


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    events = sorted(make_events(31, n=240), key=lambda e: (e["us"], e["seq"]))
    cfg = FeatureConfig(history_cap=15)
    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    for part in (events[:100], events[100:150], events[150:]):
        feed(spark, src, part)
        stream = jobs.stream_features(source(spark, src), cfg)
        drain(write_stream(stream, out, cp))
    streamed = spark.read.parquet(out)
    assert_matches(streamed.collect(), features(events, cap=15))
    batch = feature_table(to_df(spark, events), cfg)
    columns = ["seq", *cfg.feature_columns]
    rows = {r["seq"]: r for r in batch.select(columns).collect()}
    for r in streamed.select(columns).collect():
        assert r.asDict() == pytest.approx(rows[r["seq"]].asDict(), abs=2e-6)
    stats = jobs.state_inspect(spark, cp).first()
    per_account = {}
    for e in events:
        per_account[e["account"]] = min(per_account.get(e["account"], 0) + 1, 15)
    assert tuple(stats) == (len(per_account), sum(per_account.values()))


def test_late_rows_go_aside(spark, tmp_path):
    events = sorted(make_events(32, n=60, accounts=1, hot=1.0), key=lambda e: (e["us"], e["seq"]))
    late = events.pop(10)
    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    for part in (events[:40], [late, *events[40:]]):
        feed(spark, src, part)
        drain(jobs.start_split(jobs.stream_features(source(spark, src)), out, cp))
    accepted, aside = jobs.read_split(spark, out)
    assert_matches(accepted.collect(), features(events))
    rows = aside.collect()
    assert [r["seq"] for r in rows] == [late["seq"]]
    assert rows[0]["txn_count_1s"] is None and rows[0]["dc_sign"] is None


def test_warm_start(spark, tmp_path):
    events = sorted(make_events(33, n=200), key=lambda e: (e["us"], e["seq"]))
    cfg = FeatureConfig(history_cap=12)
    old, new = events[:120], events[120:]
    state = account_state(to_df(spark, old), cfg)
    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    feed(spark, src, new)
    drain(write_stream(jobs.stream_features(source(spark, src), cfg, initial=state), out, cp))
    expected = features(events, cap=12)
    got = spark.read.parquet(out).collect()
    assert_matches(got, {e["seq"]: expected[e["seq"]] for e in new})


def test_bounded_retention_forgets_idle_accounts(spark, tmp_path):
    start = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000

    def event(seq, account, second):
        return {
            "seq": seq, "account": account, "us": start + second * 1_000_000, "amount": 500,
            "descr": "ATM", "dc": "D", "src": "T",
        }

    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    parts = [
        [event(1, "idle", 0), event(2, "busy", 0), event(3, "busy", 500)],
        [event(4, "busy", 900), event(5, "busy", 2000)],
        [event(6, "busy", 2100)],
        [event(7, "idle", 2200), event(8, "busy", 2200)],
    ]
    for part in parts:
        feed(spark, src, part)
        stream = jobs.stream_features(
            source(spark, src), retention="bounded", retention_seconds=600, watermark="0 seconds"
        )
        drain(write_stream(stream, out, cp))
    rows = {r["seq"]: r for r in spark.read.parquet(out).collect()}
    assert len(rows) == 8
    assert rows[7]["same_amount_frequency"] == 1 and rows[7]["time_since_last_txn"] == 0.0
    assert rows[8]["same_amount_frequency"] == 6


def test_bounded_retention_returns_rows_behind_the_watermark(spark, tmp_path):
    start = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000

    def event(seq, account, second):
        return {
            "seq": seq, "account": account, "us": start + second * 1_000_000, "amount": 500,
            "descr": "ATM", "dc": "D", "src": "T",
        }

    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    parts = [
        [event(1, "idle", 0), event(2, "busy", 0), event(3, "slow", 5000)],
        [event(4, "busy", 9000), event(5, "slow", 5300)],
        [event(6, "busy", 5000), event(7, "slow", 5600), event(8, "slow", 5200)],
        [event(9, "idle", 100), event(10, "idle", 9500), event(11, "new", 4000)],
    ]
    for part in parts:
        feed(spark, src, part)
        stream = jobs.stream_features(
            source(spark, src), retention="bounded", retention_seconds=7000, watermark="0 seconds"
        )
        drain(jobs.start_split(stream, out, cp))
    accepted, aside = jobs.read_split(spark, out)
    late = aside.collect()
    assert sorted(r["seq"] for r in late) == [6, 8, 9, 11]
    assert all(r["is_late"] and r["time_since_last_txn"] is None for r in late)
    rows = {r["seq"]: r for r in accepted.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 7, 10]
    # Behind the watermark, but in order for its account: nothing is missing from its window.
    assert rows[7]["time_since_last_txn"] == 300 and rows[7]["same_amount_frequency"] == 3
    assert rows[7]["same_acct_amt_count_10min"] == 3
    assert rows[10]["same_amount_frequency"] == 1  # forgotten in between


def test_stream_score_and_alerts(spark, tmp_path):
    events = sorted(make_events(34, n=150), key=lambda e: (e["us"], e["seq"]))
    cfg = FeatureConfig()
    df = to_df(spark, events).where("debit_credit_code <> 'U'")
    model = forest.fit_forest(
        feature_table(df, cfg), cfg.feature_columns, n_estimators=10, contamination=0.1
    )
    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    feed(spark, src, events)
    scored = jobs.stream_score(source(spark, src), model, cfg)
    drain(write_stream(scored, out, cp))
    got = {r["seq"]: r for r in spark.read.parquet(out).collect()}
    want = forest.score_forest(feature_table(df, cfg), model).collect()
    assert len(got) == len(events) > len(want)
    rejects = [r for r in got.values() if r["reject_reason"] is not None]
    assert len(rejects) == len(events) - len(want)
    assert all(r["anomaly_score"] is None and r["is_anomaly"] is None for r in rejects)
    for r in want:
        assert got[r["seq"]]["anomaly_score"] == pytest.approx(r["anomaly_score"], abs=1e-9)
        assert len(got[r["seq"]]["top_features"]) == 5
    alerts, cp2 = str(tmp_path / "alerts"), str(tmp_path / "cp2")
    drain(write_alerts(jobs.stream_score(source(spark, src), model, cfg), alerts, cp2))
    assert spark.read.text(alerts).count() == sum(r["is_anomaly"] for r in want)


def test_a_hot_account_is_split_in_every_batch(spark, tmp_path, monkeypatch):
    """Batches with one large account, late rows, rows without a time, and full versions between."""
    events = sorted(make_events(41, n=300, hot=0.6), key=lambda e: (e["us"], e["seq"]))
    late = events.pop(20)
    cfg = FeatureConfig(history_cap=15, chunk_rows=10)
    split = []
    cut = features_module._split_accounts
    monkeypatch.setattr(features_module, "_split_accounts", lambda rows, chunks, *a: split.append(chunks) or cut(rows, chunks, *a))
    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    for i, part in enumerate((events[:90], events[90:150], [late, *events[150:230]], events[230:])):
        feed(spark, src, part)
        if i == 1:
            untimed = to_df(spark, [events[0] | {"seq": 9001}]).withColumn("posting_timestamp", F.lit(None).cast("timestamp"))
            untimed.write.mode("append").parquet(src)
        drain(tables.start_features(stream_files(spark, src, max_files=10), out, cp, cfg, full_every=3))
    got = {r["seq"]: r for r in tables.read_features(spark, out).collect()}
    assert len(got) == len(events) + 2 and len(split) >= 4 and min(split) >= 2
    assert got[late["seq"]]["is_late"] and got[late["seq"]]["duplicate_streak"] is None
    assert not got[9001]["is_late"] and got[9001]["duplicate_streak"] is None
    assert_matches([got[e["seq"]] for e in events], features(events, cap=15))
    # A repeated micro-batch replaces its own version and output.
    body = tables.feature_batch(out, cfg, full_every=3)
    body(to_df(spark, events[230:]), 3)
    again = {r["seq"]: r for r in tables.read_features(spark, out).collect()}
    assert again.keys() == got.keys()
    assert_matches([again[e["seq"]] for e in events], features(events, cap=15))


def test_many_amounts_and_a_long_history_in_keyed_state(spark, tmp_path, monkeypatch):
    """Amounts move to parts that double, rows to sealed chunks, over several batches."""
    monkeypatch.setattr(state_module, "PART_AMOUNTS", 4)
    monkeypatch.setattr(state_module, "CHUNK_ROWS", 8)
    events = sorted(make_events(43, n=400, accounts=3, hot=0.5), key=lambda e: (e["us"], e["seq"]))
    for i, e in enumerate(events):
        e["amount"] = (i * 7 % 60) * 100
    for cap in (20, 5):
        cfg = FeatureConfig(history_cap=cap)
        src, out, cp = (str(tmp_path / f"{d}{cap}") for d in ("src", "out", "cp"))
        for part in (events[:5], events[5:150], events[150:160], events[160:]):
            feed(spark, src, part)
            drain(write_stream(jobs.stream_features(source(spark, src), cfg), out, cp))
        assert_matches(spark.read.parquet(out).collect(), features(events, cap=cap))


class _Held(dict):
    """A map or a value of the state, by account."""

    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class _Handle:
    def __init__(self):
        self.kept = {}

    def getMapState(self, name, *kinds):
        return self.kept.setdefault(name, _Held())


def test_accounts_of_a_key_are_computed_together():
    """Three accounts of one key, in two batches: one table a batch, with what each account has alone."""
    import pandas as pd

    cfg = FeatureConfig(history_cap=4)

    def batch(accounts, start):
        rows = [
            (a, 10 * i + j, True, (start + 7 * j + i) * 1_000_000, 500 * (j % 2 + i), True, True, "ATM", (-1) ** j, 0)
            for i, a in enumerate("abc") if a in accounts for j in range(6)
        ]
        return pd.DataFrame(rows, columns=state_module.INPUT_COLUMNS)

    def run(accounts):
        operator = state_module.AccountFeatures(cfg, False, 600)
        operator.init(_Handle())
        return [list(operator.handleInputRows((1,), iter([batch(accounts, s)]), None)) for s in (0, 50)]

    together = run("abc")
    assert [len(frames) for frames in together] == [1, 1]
    alone = [pd.concat([f for a in "abc" for f in run(a)[i]]) for i in range(2)]
    for (got,), want in zip(together, alone):
        pd.testing.assert_frame_equal(got, want.reset_index(drop=True), check_dtype=False)
    assert together[1][0]["same_amount_frequency"].tolist()[:2] == [4, 4]


def test_rows_without_a_number_leave_others_as_they_are(spark, tmp_path):
    events = make_events(36, n=40, accounts=2)
    for i, e in enumerate(events):
        e["seq"] = 2**53 + 1 + 2 * i
    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    rows = to_df(spark, events)
    rows.unionByName(rows.limit(1).withColumn("seq", F.lit(None).cast("long"))).coalesce(1).write.parquet(src)
    drain(write_stream(jobs.stream_features(source(spark, src)), out, cp))
    got = [r["seq"] for r in spark.read.parquet(out).select("seq").collect()]
    assert sorted(s for s in got if s is not None) == [e["seq"] for e in sorted(events, key=lambda e: e["seq"])]
    assert got.count(None) == 1


def test_unread_explanations_are_not_computed(spark):
    events = make_events(35, n=60)
    cfg = FeatureConfig()
    table = feature_table(to_df(spark, events), cfg)
    model = forest.fit_forest(table, cfg.feature_columns, n_estimators=5, contamination=0.1)
    scored = jobs.score_and_explain(table, model, 5, flagged_only=False)

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "explain(" in plan(scored) and "explain(" not in plan(scored.drop("top_features"))
    assert scored.where("size(top_features) = 5").count() == len(events)
