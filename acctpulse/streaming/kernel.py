"""Features of many events of some accounts at once, as operations on whole arrays.

Accounts follow one another, their rows in order of time.  A window is a range of places: its first place comes from a binary
search and from the cap, and what is counted in it from prefix sums or from two binary searches
among the places of rows with the same key.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np


def codes_of(*columns: np.ndarray) -> np.ndarray:
    """A number for each different row of the columns."""
    code = None
    for column in columns:
        _, part = np.unique(column, return_inverse=True)
        if code is not None:
            _, part = np.unique(code * (int(part.max(initial=0)) + 1) + part, return_inverse=True)
        code = part
    return code


class Places:
    """Where each key occurs, for counts in ranges of places."""

    def __init__(self, code: np.ndarray):
        self.n = len(code) + 1
        self.code = code
        order = np.argsort(code, kind="stable")
        self.keys = code[order] * self.n + order  # ascending
        self.rank = np.empty(len(code), np.int64)
        self.rank[order] = np.arange(len(code))

    def count(self, code: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rows of ``code`` at places ``first`` to ``last``, both included."""
        upto = np.searchsorted(self.keys, code * self.n + last, side="right")
        return upto - np.searchsorted(self.keys, code * self.n + first, side="left")

    def previous(self, at: np.ndarray) -> np.ndarray:
        """Place of the row before each with the same key; -1 if none."""
        rank = self.rank[at]
        before = self.keys[np.maximum(rank - 1, 0)]
        same = (rank > 0) & (before // self.n == self.code[at])
        return np.where(same, before % self.n, -1)


def one_line(us: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Times moved by a constant of their account, so that they ascend over all accounts; spans add up."""
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    last = np.append(first[1:], len(us)) - 1
    width = us[last] - us[first] + 1
    return us + np.repeat(np.cumsum(width) - width - us[first], last - first + 1)


def lookback_features(
    us: np.ndarray,
    cents: np.ndarray,
    descr: np.ndarray,
    sign: np.ndarray,
    owner: np.ndarray,
    at: np.ndarray,
    begin: np.ndarray,
    cap: int,
    lookback_us: int,
    velocity_us: Mapping[str, int],
) -> dict[str, np.ndarray]:
    """Measures of the rows at the places ``at``; each sees itself and up to ``cap`` - 1 rows of its account before it.

    ``owner`` tells the accounts apart, ascending; ``begin`` is the place of the account's first row for each of ``at``.
    ``descr`` holds numbers, ``sign`` -1, 0 or 1.
    """
    now = us[at]
    line = one_line(us, owner)
    oldest = np.maximum(at + 1 - cap, begin)  # the first place that the history holds

    def inside(window_us: int) -> np.ndarray:
        return np.maximum(np.searchsorted(line, line[at] - window_us, side="left"), oldest)

    first = inside(lookback_us)
    amount = codes_of(owner, cents)
    by_amount, by_descr, by_pair = Places(amount), Places(codes_of(owner, descr)), Places(codes_of(amount, descr))
    by_sign = Places(amount * 3 + sign + 1)
    pairs = by_pair.count(by_pair.code[at], first, at)
    opposite = by_sign.count(amount[at] * 3 - sign[at] + 1, first, at)

    def since(places: Places) -> np.ndarray:
        before = places.previous(at)
        return np.where(before >= oldest, now - us[np.maximum(before, 0)], 0) / 1e6

    back = np.maximum(at - 5, oldest)
    gaps = np.diff(us, prepend=us[:1])
    least = np.full(len(at), np.iinfo(np.int64).max)
    for k in range(10):
        place = at - k  # the gap between this row and the one before it
        held = place - 1 >= oldest
        least = np.where(held, np.minimum(least, gaps[np.maximum(place, 0)]), least)
    flips = np.concatenate([[0], np.cumsum(np.diff(sign) != 0)])
    sums = np.concatenate([[0], np.cumsum(cents)])
    out = {k: at + 1 - inside(w) for k, w in velocity_us.items()}
    return out | {
        "same_acct_amt_descr_count_10min": pairs,
        "same_acct_amt_count_10min": by_amount.count(amount[at], first, at),
        "is_exact_duplicate_10min": (pairs > 1).astype(np.int64),
        "dc_alternation_count_10txn": flips[at] - flips[np.maximum(at - 9, oldest)],
        "reversal_count_10min": np.where(sign[at] != 0, opposite, 0),
        "time_since_last_txn": np.where(at > oldest, gaps[at], 0) / 1e6,
        "time_since_last_txn_same_amount": since(by_amount),
        "time_since_last_txn_same_descr": since(by_descr),
        "avg_time_gap_last_5txn": (now - us[back]) / (np.maximum(at - back, 1) * 1e6),
        "min_time_gap_last_10txn": np.where(at > oldest, least, 0) / 1e6,
        "cumulative_cents": sums[at + 1] - sums[first],
    }


def run_lengths(
    cents: np.ndarray, descr: np.ndarray, owner: np.ndarray, before: list[tuple | None], held: list[int]
) -> np.ndarray:
    """Length of the run of equal (amount, description) that each row ends.

    ``before`` is, per account, the key of the row before its first one, which ends a run of ``held``.
    """
    at = np.arange(len(cents))
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    same = np.zeros(len(cents), bool)
    same[1:] = (cents[1:] == cents[:-1]) & (descr[1:] == descr[:-1])
    same[first] = False
    began = np.maximum.accumulate(np.where(same, -1, at))
    keys = zip(cents[first].tolist(), descr[first].tolist(), strict=True)
    more = np.array([k if key == b else 0 for key, b, k in zip(keys, before, held, strict=True)], np.int64)
    begin = first[owner]
    return at - began + 1 + np.where(began == begin, more[owner], 0)


def running_moments(
    values: np.ndarray, n: int, mean: float, m2: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and sum of squared deviations after each value, going on from earlier ones.

    Sums run over distances from the earlier mean, in extended precision, so they stay small.
    """
    centre = np.longdouble(mean if n else values[0])
    away = values.astype(np.longdouble) - centre
    count = n + np.arange(1, len(values) + 1)
    total = np.cumsum(away)
    squares = np.longdouble(m2) + np.cumsum(away * away) - total * total / count
    return count, (centre + total / count).astype(float), np.maximum(squares, 0).astype(float)


def times_seen(cents: np.ndarray) -> np.ndarray:
    """How often each amount has occurred so far, the row itself included."""
    order = np.argsort(cents, kind="stable")
    ordered = cents[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    at = np.arange(len(cents))
    out = np.empty(len(cents), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
    return out
