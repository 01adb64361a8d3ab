"""State of an account at any asked time."""

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest

from acctpulse.operators import lookups

EVENTS = (
    "seq long, account_number string, posting_timestamp timestamp, transaction_ac_amount decimal(18,2), "
    "descr string, debit_credit_code string, input_source string"
)
ASKS = "ask_id long, account_number string, asked_at timestamp, row string, tie int"


def at(second):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)


@pytest.fixture
def many_ranges(spark):
    """Ranges stay as many as there are shuffle partitions, so accounts cross their borders."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    usual = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, usual)


def made(seed):
    rng = random.Random(seed)
    events = []
    for seq in range(500):
        account = rng.choice(["hot", "hot", "hot", "b", "c", f"rare{rng.randint(0, 30)}"])
        second = rng.choice([rng.randint(0, 400), 100, 101])
        events.append((seq, account, at(second), Decimal(rng.choice([1, 1, 2, 5])), rng.choice(["ATM", "GIRO"]), "D", "A"))
    asks = [
        (i, rng.choice(["hot", "b", "c", "rare3", "nobody"]), at(rng.choice([rng.randint(-5, 410), 100, 101])), "x", 1)
        for i in range(300)
    ]
    asks += [(1000, "hot", None, None, None), (1001, None, at(100), None, None), (1002, "hot", at(101), "y", 2)]
    return events, [*asks, (1002, "hot", at(101), "y", 2)]


def expected(events, ask):
    _, account, when, _, _ = ask
    rows = sorted((t, s, a, d) for s, n, t, a, d, *_ in events if when and n == account and t <= when)
    if not rows:
        return (0, None, None, None, None, None, None, None)
    amounts = [float(r[2]) for r in rows]
    streak = 0
    for _, _, a, d in reversed(rows):
        if (a, d) != rows[-1][2:]:
            break
        streak += 1
    return (
        len(rows), sum(amounts), round(statistics.fmean(amounts), 6), round(statistics.pstdev(amounts), 6),
        rows[-1][0], float(rows[-1][2]), rows[-1][3], streak,
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_every_ask_has_the_state_of_its_time(spark, many_ranges, seed):
    events, asks = made(seed)
    df = spark.createDataFrame(events, EVENTS).repartition(3)
    got = lookups.state_at(df, spark.createDataFrame(asks, ASKS)).collect()
    assert len(got) == len(asks)
    told = sorted(
        (r.ask_id, r.row, r.tie, r.txn_count, *[None if r[c] is None else float(r[c]) for c in ("amount_sum",)],
         *[None if r[c] is None else round(r[c], 6) for c in ("amount_mean", "amount_std")],
         r.last_posting, None if r.last_amount is None else float(r.last_amount), r.last_descr, r.current_streak)
        for r in got
    )
    want = sorted((a[0], a[3], a[4], *expected(events, a)) for a in asks)
    assert repr(told) == repr(want)


def test_the_last_row_crosses_many_ranges(spark, many_ranges):
    """One account in all ranges, and one row long before all asks."""
    rows = [(1, "a", at(0), Decimal(7), "ATM", "D", "A")] + [(i, "z", at(i), Decimal(1), "ATM", "D", "A") for i in range(2, 400)]
    asks = [(i, "a", at(10 + i), None, None) for i in range(400)]
    df = lookups.asof_join(
        spark.createDataFrame(rows, EVENTS), spark.createDataFrame(asks, ASKS), ["transaction_ac_amount"]
    )
    assert {float(r.transaction_ac_amount) for r in df.collect()} == {7.0} and df.count() == 400


def test_empty_sides(spark):
    none = spark.createDataFrame([], EVENTS)
    asks = spark.createDataFrame([(1, "a", at(5), None, None)], ASKS)
    assert [r.txn_count for r in lookups.state_at(none, asks).collect()] == [0]
    assert lookups.state_at(none, asks.where("false")).collect() == []
