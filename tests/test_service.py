"""Scoring streams that follow published models, and their progress."""

import pytest
from test_features import make_events, to_df
from test_streaming import feed, source

from acctpulse import schema
from acctpulse.models import forest, lof
from acctpulse.operators import reports
from acctpulse.operators.features import feature_table
from acctpulse.streaming import service


def test_versions_are_seen_when_they_are_whole(spark, tmp_path):
    folder = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        service.ModelFolder(folder).load(spark)
    features = feature_table(to_df(spark, make_events(51, n=150)))
    models = [forest.fit_forest(features, schema.FEATURE_COLUMNS, n_estimators=3, random_state=s) for s in (1, 2)]
    assert service.publish(spark, models[0], folder) == 1
    at_hand = service.ModelFolder(folder)
    first = at_hand.load(spark)
    assert at_hand.load(spark) is first and at_hand.version == 1
    assert at_hand.load(spark, force_reload=True) is not first
    # A save that is not finished has no entry among the published.
    forest.save_forest(spark, models[1], f"{folder}/models/version=2")
    assert service.versions(spark, folder) == [1]
    (tmp_path / "models/published/version=2").mkdir()
    assert service.versions(spark, folder) == [1]
    assert service.publish(spark, models[1], folder) == 2
    assert at_hand.load(spark).nodes.equals(models[1].nodes) and at_hand.version == 2
    at_hand.clear()
    assert at_hand.version == 0


def test_a_stream_scores_with_any_model_and_repeats_a_batch_alike(spark, tmp_path):
    events = sorted(make_events(52, n=160), key=lambda e: (e["us"], e["seq"]))
    events = [e | {"dc": "C" if e["dc"] == "U" else e["dc"]} for e in events]
    late = events.pop(next(i for i, e in enumerate(events) if e["account"] == "acc0"))
    src, out, cp, folder, log = (str(tmp_path / d) for d in ("src", "out", "cp", "models", "log"))
    rows = feature_table(to_df(spark, events))
    distance = lof.fit_lof(rows, schema.FEATURE_COLUMNS, n_neighbors=5)
    trees = forest.fit_forest(rows, schema.FEATURE_COLUMNS, n_estimators=5, contamination=0.1)
    bad = events[0] | {"seq": 7000, "amount": -100}
    for model, part in ((distance, events[:90]), (trees, [late, bad, *events[90:]])):
        service.publish(spark, model, folder)
        feed(spark, src, part)
        service.with_progress(
            spark, lambda: service.start_scoring(source(spark, src), folder, out, cp), log
        )
    got = {r["seq"]: r for r in service.read_scored(spark, out).collect()}
    assert len(got) == len(events) + 2
    want = {r["seq"]: r["anomaly_score"] for r in lof.score_lof(rows, distance).collect()}
    trees_want = {r["seq"]: r["anomaly_score"] for r in forest.score_forest(rows, trees).collect()}
    for i, e in enumerate(events):
        r = got[e["seq"]]
        assert r["model_version"] == (1 if i < 90 else 2)
        assert r["anomaly_score"] == pytest.approx((want if i < 90 else trees_want)[e["seq"]], rel=1e-6, abs=1e-9)
        assert (r["top_features"] is not None) == (i >= 90 and r["is_anomaly"])
    assert got[7000]["reject_reason"] and got[7000]["anomaly_score"] is None
    assert got[late["seq"]]["is_late"] and got[late["seq"]]["model_version"] is None
    progress = spark.read.parquet(log)
    told = reports.dashboard_metrics(service.read_scored(spark, out), progress).first()
    assert told.batches == 2 and told.total == len(got) and told.avg_latency_ms > 0
    # The first micro-batch again: its noted version counts, not the newest.
    batch = rows.where(f"seq in ({','.join(str(e['seq']) for e in events[:90])})").selectExpr(
        "*", "false as is_late", "cast(null as string) as reject_reason")
    service.scoring_batch(folder, out)(batch, 0)
    again = {r["seq"]: r for r in service.read_scored(spark, out).collect()}
    assert again.keys() == got.keys() and again[events[0]["seq"]]["model_version"] == 1


def test_no_progress_gives_no_latency(spark):
    scored = spark.createDataFrame([(True,), (False,)], "is_anomaly boolean")
    none = spark.createDataFrame([], service.PROGRESS)
    told = reports.dashboard_metrics(scored, none).first()
    assert (told.total, told.anomalies, told.batches, told.rows_timed, told.avg_latency_ms) == (2, 1, 0, 0, 0.0)
