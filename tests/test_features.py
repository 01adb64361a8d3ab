import datetime as dt
import random

import pytest
from brute import EPOCH, features
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.operators.features import (
    account_state,
    checkpoint_state,
    feature_table,
    running_account_stats,
)
from acctpulse.operators.windows import FeatureConfig

DESCRS = ["ATM", "GIRO", "PayNow", "Mystery"]


def make_events(seed, n=400, accounts=3, span=3000, hot=0.6):
    """Tie-heavy rows; one account holds most of them."""
    rng = random.Random(seed)
    start = int((dt.datetime(2024, 3, 1, 7, 30) - EPOCH).total_seconds()) * 1_000_000
    out = []
    for seq in range(n):
        account = "acc0" if rng.random() < hot else f"acc{rng.randrange(accounts)}"
        micro = rng.choice([0, 0, 0, 1, 500_000])
        out.append(
            {
                "seq": seq,
                "account": account,
                "us": start + rng.randrange(span) * 1_000_000 + micro,
                "amount": rng.choice([1000, 1000, 2550, 99999, 1]),
                "descr": rng.choice(DESCRS[: rng.choice([1, 4])]),
                "dc": rng.choice("DDCCU"),
                "src": rng.choice("AMTZX"),
            }
        )
    rng.shuffle(out)
    return out


def to_df(spark, events):
    rows = [
        (e["seq"], e["account"], e["us"], e["amount"], e["descr"], e["dc"], e["src"])
        for e in events
    ]
    df = spark.createDataFrame(
        rows, "seq long, account_number string, us long, cents long, descr string, "
        "debit_credit_code string, input_source string",
    )
    return df.select(
        "seq",
        "account_number",
        F.timestamp_micros("us").alias("posting_timestamp"),
        (F.col("cents") / 100).cast("decimal(18,2)").alias("transaction_ac_amount"),
        "descr",
        "debit_credit_code",
        "input_source",
    )


def assert_matches(rows, expected):
    assert len(rows) == len(expected)
    for row in rows:
        want = expected[row["seq"]]
        for name, value in want.items():
            assert row[name] == pytest.approx(value, abs=2e-6), (row["seq"], name)


@pytest.mark.parametrize("seed,cap", [(1, 1000), (2, 20), (3, 5), (4, 1), (5, 2)])
def test_brute_force(spark, seed, cap):
    events = make_events(seed)
    rows = feature_table(to_df(spark, events), FeatureConfig(history_cap=cap)).collect()
    assert_matches(rows, features(events, cap=cap))


@pytest.mark.parametrize("seed,cap,chunk_rows", [(6, 1000, 60), (7, 20, 25), (9, 1, 80), (10, 60, 15)])
def test_split_accounts_match_brute_force(spark, seed, cap, chunk_rows):
    events = make_events(seed)
    cfg = FeatureConfig(history_cap=cap, chunk_rows=chunk_rows)
    rows = feature_table(to_df(spark, events), cfg).collect()
    assert_matches(rows, features(events, cap=cap))


def test_split_long_run_of_equal_rows(spark):
    """A run of equal rows, all at one instant, that covers several chunks."""
    events = make_events(11, n=300, accounts=1, hot=1.0)
    for e in events[:260]:
        e.update(amount=1000, descr="ATM", us=events[0]["us"], dc="D")
    cfg = FeatureConfig(history_cap=10, chunk_rows=20)
    rows = feature_table(to_df(spark, events), cfg).collect()
    assert_matches(rows, features(events, cap=10))


def test_flat_amounts_have_zero_score(spark):
    events = make_events(12, n=200, accounts=1, hot=1.0)
    for e in events:
        e["amount"] = 33333331
    cfg = FeatureConfig(chunk_rows=30)
    rows = feature_table(to_df(spark, events), cfg).collect()
    assert {r["amount_zscore_account"] for r in rows} == {0.0}


@pytest.mark.parametrize("seed,cap,chunk_rows", [(13, 1000, 10**6), (14, 12, 60)])
def test_continued_batches(spark, seed, cap, chunk_rows):
    """Features of later batches, computed from remembered state, equal one big batch."""
    events = sorted(make_events(seed), key=lambda e: (e["us"], e["seq"]))
    cfg = FeatureConfig(history_cap=cap, chunk_rows=chunk_rows)
    expected = features(events, cap=cap)
    state, start = None, 0
    for stop in (250, len(events)):
        batch = events[start:stop]
        df = to_df(spark, batch)
        rows = feature_table(df, cfg, state=state).collect()
        assert_matches(rows, {e["seq"]: expected[e["seq"]] for e in batch})
        if stop < len(events):
            state = checkpoint_state(account_state(df, cfg, state))
        start = stop


def test_independent_of_partitioning(spark):
    df = to_df(spark, make_events(16))
    one = feature_table(df.repartition(1)).orderBy("seq").collect()
    many = feature_table(df.repartition(13, "descr")).orderBy("seq").collect()
    assert one == many


def test_one_exchange(spark):
    plan = feature_table(to_df(spark, make_events(17)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_sorts_begin_with_a_number(spark):
    plan = feature_table(to_df(spark, make_events(17)))._jdf.queryExecution().executedPlan().toString()
    sorts = [line.split("Sort [")[1] for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all(s.startswith("_key_hash") for s in sorts)


def test_unused_windows_are_pruned(spark):
    df = feature_table(to_df(spark, make_events(18))).select("seq", "txn_count_30s")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1


def test_codes_and_custom_windows(spark):
    events = make_events(19, n=60)
    cfg = FeatureConfig(
        velocity_windows={"n_2s": 2, "n_5min": 300}, descr_codes={"ATM": 7}, input_source_codes={}
    )
    rows = feature_table(to_df(spark, events), cfg, keep=["input_source"]).collect()
    velocity = dict(cfg.velocity_windows)
    assert_matches(rows, features(events, velocity=velocity))
    for r in rows:
        assert r["descr_encoded"] == (7 if r["descr"] == "ATM" else -1)
        assert r["input_source_encoded"] == schema.INPUT_SOURCE_CODES.get(r["input_source"], -1)
        assert r["debit_credit_code_encoded"] == (1 if r["dc_sign"] == 1 else 0)
    assert cfg.feature_columns[:2] == ["n_2s", "n_5min"] and len(cfg.feature_columns) == 22


def test_missing_text_equals_itself(spark):
    events = make_events(20, n=40, accounts=1, hot=1.0)
    for e in events:
        e["descr"] = None
    df = to_df(spark, events)
    for e in events:
        e["descr"] = "nan"
    assert_matches(feature_table(df).collect(), features(events))


@pytest.mark.parametrize("chunk_rows", [10**6, 60])
def test_running_stats(spark, chunk_rows):
    events = sorted(make_events(21, n=160), key=lambda e: (e["us"], e["seq"]))
    cfg = FeatureConfig(chunk_rows=chunk_rows)
    got = {r["seq"]: r for r in running_account_stats(to_df(spark, events), cfg).collect()}
    seen = {}
    for e in events:
        amounts = seen.setdefault(e["account"], [])
        amounts.append(e["amount"] / 100)
        n, row = len(amounts), got[e["seq"]]
        mean = sum(amounts) / n
        assert row["txn_count"] == n
        assert float(row["amount_sum"]) == pytest.approx(sum(amounts))
        assert row["amount_sq_sum"] == pytest.approx(sum(a * a for a in amounts))
        assert row["amount_mean"] == pytest.approx(mean)
        std = (sum((a - mean) ** 2 for a in amounts) / n) ** 0.5
        assert row["amount_std"] == pytest.approx(std, abs=1e-9)


def test_rows_of_a_task_are_bounded_whatever_the_chunks(spark, monkeypatch):
    """A large ``chunk_rows`` does not let chunks or partitions grow with the table."""
    from acctpulse.operators import features as module

    monkeypatch.setattr(module, "TASK_ROWS", 20)
    monkeypatch.setattr(module, "CHUNK_LIMIT", 10)
    chunks, parts = [], []
    cut, windows = module._split_accounts, module.window_features
    monkeypatch.setattr(module, "_split_accounts", lambda rows, n, *a: chunks.append(n) or cut(rows, n, *a))
    monkeypatch.setattr(
        module, "window_features",
        lambda *a, **k: parts.append(k["partitions"] if "partitions" in k else a[6]) or windows(*a, **k),
    )
    events = make_events(51, n=300, accounts=30, hot=0.4)
    cfg = FeatureConfig(history_cap=5, chunk_rows=10**6)
    assert_matches(feature_table(to_df(spark, events), cfg).collect(), features(events, cap=5))
    assert len(chunks) == 1 and chunks[0] >= 12
    assert all(p is not None and p >= 5 for p in parts) and len(parts) == 2
