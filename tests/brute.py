"""Small brute-force evaluation of the features, straight from their definitions."""

from __future__ import annotations

import datetime as dt
import math
from collections import defaultdict

EPOCH = dt.datetime(1970, 1, 1)


def sign(code):
    return {"D": 1, "C": -1}.get(code, 0)


def features(events, cap=1000, lookback=600, velocity=None):
    """events: dicts seq, account, us, amount (cents), descr, dc -> {seq: features}."""
    velocity = velocity or {"txn_count_1s": 1, "txn_count_10s": 10, "txn_count_30s": 30}
    accounts = defaultdict(list)
    for e in sorted(events, key=lambda e: (e["us"], e["seq"])):
        accounts[e["account"]].append(e)
    out = {}
    for rows in accounts.values():
        for i, cur in enumerate(rows):
            known = rows[: i + 1]
            held = known[-cap:]
            earlier = held[:-1]
            recent = [r for r in held if r["us"] >= cur["us"] - lookback * 1_000_000]
            same = [r for r in recent if r["amount"] == cur["amount"]]
            gaps = [(b["us"] - a["us"]) / 1e6 for a, b in zip(held, held[1:])]

            def since(pred):
                hits = [r for r in earlier if pred(r)]
                return (cur["us"] - hits[-1]["us"]) / 1e6 if hits else 0.0

            streak = 0
            for r in reversed(known):
                if (r["amount"], r["descr"]) != (cur["amount"], cur["descr"]):
                    break
                streak += 1
            amounts = [r["amount"] / 100 for r in known]
            mean = math.fsum(amounts) / len(amounts)
            var = math.fsum((a - mean) ** 2 for a in amounts) / len(amounts)
            flat = len(set(r["amount"] for r in known)) == 1
            signs = [sign(r["dc"]) for r in held[-10:]]
            pair = sum(r["descr"] == cur["descr"] for r in same)
            s = sign(cur["dc"])
            when = EPOCH + dt.timedelta(microseconds=cur["us"])
            out[cur["seq"]] = {
                **{
                    k: sum(r["us"] >= cur["us"] - w * 1_000_000 for r in held)
                    for k, w in velocity.items()
                },
                "time_since_last_txn": since(lambda r: True),
                "time_since_last_txn_same_amount": since(lambda r: r["amount"] == cur["amount"]),
                "time_since_last_txn_same_descr": since(lambda r: r["descr"] == cur["descr"]),
                "avg_time_gap_last_5txn": sum(gaps[-5:]) / len(gaps[-5:]) if gaps else 0.0,
                "min_time_gap_last_10txn": min(gaps[-10:]) if gaps else 0.0,
                "same_acct_amt_descr_count_10min": pair,
                "same_acct_amt_count_10min": len(same),
                "is_exact_duplicate_10min": int(pair > 1),
                "duplicate_streak": streak,
                "dc_sign": s,
                "dc_alternation_count_10txn": sum(a != b for a, b in zip(signs, signs[1:])),
                "reversal_count_10min": sum(sign(r["dc"]) == -s for r in same) if s else 0,
                "amount_zscore_account": 0.0
                if flat
                else round((cur["amount"] / 100 - mean) / math.sqrt(var), 6),
                "same_amount_frequency": sum(r["amount"] == cur["amount"] for r in known),
                "cumulative_amount_10min": sum(r["amount"] for r in recent) / 100,
                "hour_of_day": when.hour,
                "is_business_hours": int(when.weekday() < 5 and 8 <= when.hour < 18),
            }
    return out
