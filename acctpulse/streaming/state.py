"""Keyed state of the event stream: accounts' bounded histories and totals.

A key is a bucket of accounts, so that what a call of the operator costs is shared by many accounts; all accounts of a
bucket that have rows in a micro-batch are computed together, as whole arrays.  What a usual account needs is one value, its
head: totals, the newest rows and the numbers of its amounts.  So a batch
reads and writes one value an account.  When the newest rows reach ``CHUNK_ROWS`` they become a chunk of a log, which is
never written again; dropped rows are counted in the oldest chunk until it is removed whole.  Amounts beyond
``PART_AMOUNTS`` move to parts by amount, whose number doubles as they grow, so a batch touches only the
parts of its own amounts.  Whole numbers lie in state as bytes, texts as their different values and a number a row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from acctpulse.operators.windows import FeatureConfig
from acctpulse.streaming import kernel

#: Keys of the operator, each a part of all accounts.
BUCKETS = 4096
HISTORY_STATE = "us binary, seq binary, cents binary, sign binary, word binary, words array<string>"
HEAD_FIELDS = {
    "n": "bigint", "mean": "double", "m2": "double", "low": "bigint", "high": "bigint", "streak": "bigint",
    "last_us": "bigint", "last_seq": "bigint", "last_cents": "bigint", "last_descr": "string",
    # Sealed chunks, rows dropped from the oldest, rows held in all; parts of amounts (0: in the head), their number.
    "first_chunk": "bigint", "last_chunk": "bigint", "skip": "int", "held": "bigint",
    "parts": "int", "amounts": "bigint",
}
HEAD_STATE = ", ".join([*[f"{n} {t}" for n, t in HEAD_FIELDS.items()], HISTORY_STATE, "amount_cents binary, amount_n binary"])
HEAD_KEY, CHUNK_KEY, PART_KEY = "account string", "account string, chunk bigint", "account string, part int"
PART_STATE = "cents binary, n binary"
CHUNK_ROWS = 256
#: Amounts that a part holds on average before the parts are doubled.
PART_AMOUNTS = 256
#: Rows, remembered and new, of which accounts are computed together; one larger account is computed alone.
RUN_ROWS = 200_000

# One row per remembered item; ``kind`` tells which columns count.
INITIAL_COLUMNS = {
    "kind": "string",
    "us": "bigint",
    "seq": "bigint",
    "cents": "bigint",
    "descr": "string",
    "sign": "int",
    "n": "bigint",
    "mean": "double",
    "m2": "double",
    "low": "bigint",
    "high": "bigint",
    "streak": "bigint",
}

INPUT_COLUMNS = ["account_number", "seq", "has_seq", "us", "cents", "has_us", "has_cents", "descr", "dc_sign", "input_source_encoded"]
STATEFUL_INTEGERS = [
    "same_acct_amt_descr_count_10min",
    "same_acct_amt_count_10min",
    "is_exact_duplicate_10min",
    "duplicate_streak",
    "dc_alternation_count_10txn",
    "reversal_count_10min",
]
STATEFUL_DOUBLES = [
    "time_since_last_txn",
    "time_since_last_txn_same_amount",
    "time_since_last_txn_same_descr",
    "avg_time_gap_last_5txn",
    "min_time_gap_last_10txn",
    "amount_zscore_account",
]


def output_schema(cfg: FeatureConfig) -> T.StructType:
    fields = [
        ("account_number", T.StringType()),
        ("seq", T.LongType()),
        ("has_seq", T.BooleanType()),
        ("us", T.LongType()),
        ("cents", T.LongType()),
        ("has_us", T.BooleanType()),
        ("has_cents", T.BooleanType()),
        ("descr", T.StringType()),
        ("dc_sign", T.IntegerType()),
        ("input_source_encoded", T.IntegerType()),
        ("is_late", T.BooleanType()),
        *[(c, T.IntegerType()) for c in [*cfg.velocity_windows, *STATEFUL_INTEGERS]],
        *[(c, T.DoubleType()) for c in STATEFUL_DOUBLES],
        ("same_amount_frequency", T.LongType()),
        ("cumulative_cents", T.LongType()),
    ]
    return T.StructType([T.StructField(n, t) for n, t in fields])


Rows = tuple[np.ndarray, ...]  # us, seq, cents, sign, number of the text


class Texts:
    """Numbers for the texts of some accounts."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.names: list[str] = []

    def numbers(self, names: list[str]) -> np.ndarray:
        for name in names:
            if name not in self.number:
                self.number[name] = len(self.names)
                self.names.append(name)
        return np.array([self.number[name] for name in names], np.int64)


def _ints(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _joined(parts: list[Rows]) -> Rows:
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _stored(rows: Rows, texts: Texts) -> tuple:
    word, place = np.unique(rows[4], return_inverse=True)
    numbers = [np.ascontiguousarray(c, np.int64).tobytes() for c in rows[:3]]
    return (
        *numbers, rows[3].astype(np.int8).tobytes(), place.astype(np.int32).tobytes(),
        [texts.names[w] for w in word.tolist()],
    )


def _loaded(stored: Any, texts: Texts) -> Rows:
    us, seq, cents, sign, word, words = stored
    known = texts.numbers(list(words))
    place = np.frombuffer(word, np.int32)
    return _ints(us), _ints(seq), _ints(cents), np.frombuffer(sign, np.int8).astype(np.int64), known[place]


class Head:
    """An account's head: ``HEAD_FIELDS`` as attributes, the newest rows by column, the amounts it holds itself."""

    def __init__(self, account: str, stored: Any, texts: Texts) -> None:
        self.account, self.texts = account, texts
        names = list(HEAD_FIELDS)
        values = stored[: len(names)] if stored is not None else [0, 0.0, 0.0, *[None] * 2, 0, *[None] * 4, 0, -1, 0, 0, 0, 0]
        for name, value in zip(names, values, strict=True):
            setattr(self, name, value)
        none = (b"",) * 5 + ([],)
        rest = stored[len(names) :] if stored is not None else (*none, b"", b"")
        self.tail = _loaded(rest[:6], texts)
        self.own = dict(zip(*[_ints(c).tolist() for c in rest[6:]], strict=True))

    def stored(self) -> tuple:
        fields = [getattr(self, n) for n in HEAD_FIELDS]
        return (*fields, *_stored(self.tail, self.texts), *_amounts(self.own))


def _amounts(held: dict[int, int]) -> tuple[bytes, bytes]:
    return np.array(list(held), np.int64).tobytes(), np.array(list(held.values()), np.int64).tobytes()


class AccountFeatures(StatefulProcessor):
    """Features of each event from its account's state, in event-time order.

    Rows without a time or an amount come out as they are and leave the state alone.
    The rows of an account inside a micro-batch are sorted first.  A row older than
    the newest one already processed comes out with ``is_late`` and no features.
    With ``bounded`` retention the history is trimmed to ``retention_seconds``
    behind the watermark or the batch's first row in order, if that is older, and an account
    idle for that long is forgotten.  Where nothing is remembered, rows behind the
    watermark are late: what came before them may have been forgotten.
    """

    def __init__(self, cfg: FeatureConfig, bounded: bool, retention_seconds: float) -> None:
        self.cap = cfg.history_cap
        self.lookback = int(round(cfg.lookback_seconds * 1e6))
        self.velocity = {k: int(round(s * 1e6)) for k, s in cfg.velocity_windows.items()}
        self.columns = [f.name for f in output_schema(cfg).fields]
        self.bounded = bounded
        self.retention_ms = int(retention_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heads = handle.getMapState("head", HEAD_KEY, HEAD_STATE)
        self.history = handle.getMapState("history", CHUNK_KEY, HISTORY_STATE)
        self.amounts = handle.getMapState("amounts", PART_KEY, PART_STATE)
        # Each account's newest time, as JSON: whom a timer concerns.
        self.newest = handle.getValueState("newest", "times binary") if self.bounded else None

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        """Rows of remembered state may arrive in several parts."""
        account, names = pd.factorize(initialState["account_number"].to_numpy())
        order = np.lexsort((initialState["seq"].to_numpy(), initialState["us"].to_numpy(), account))
        given = {c: initialState[c].to_numpy()[order] for c in initialState.columns}
        ends = np.cumsum(np.bincount(account, minlength=len(names)))
        touched = {}
        for name, start, end in zip(names, [0, *ends[:-1]], ends, strict=True):
            own = {c: v[start:end] for c, v in given.items()}
            head = Head(name, self.heads.getValue((name,)), Texts())
            kind = own["kind"]
            counted = kind == "amount"
            if counted.any():
                self._add_amounts(head, *[own[c][counted].astype(np.int64).tolist() for c in ("cents", "n")])
            past = kind == "history"
            if past.any():
                new = [own[c][past].astype(np.int64) for c in ("us", "seq", "cents", "sign")]
                merged = _joined([self._read_history(head), (*new, head.texts.numbers(own["descr"][past].tolist()))])
                place = np.lexsort((merged[1], merged[0]))
                self._remove_chunks(head, head.last_chunk + 1)
                head.skip = 0
                self._write_history(head, tuple(c[place] for c in merged), 0)
            for i in np.flatnonzero(kind == "totals").tolist():
                head.n, head.mean, head.m2 = int(own["n"][i]), float(own["mean"][i]), float(own["m2"][i])
                head.low, head.high, head.streak = (int(own[c][i]) for c in ("low", "high", "streak"))
                head.last_us, head.last_seq, head.last_cents = (int(own[c][i]) for c in ("us", "seq", "cents"))
                head.last_descr = own["descr"][i]
                touched[name] = head.last_us
            self.heads.updateValue((name,), head.stored())
        self._remember(touched)

    def _remember(self, touched: dict[str, int]) -> None:
        """Notes the newest times of accounts, and sees to it that a timer is set for the first that ends."""
        if not self.bounded or not touched:
            return
        stored = self.newest.get()
        times = json.loads(bytes(stored[0])) if stored is not None else {}
        self.newest.update((json.dumps(times | touched).encode(),))
        due = min(touched.values()) // 1000 + self.retention_ms
        timers = list(self.handle.listTimers())
        if not timers or due < min(timers):
            for timer in timers:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)

    def _read_history(self, head: Head) -> Rows:
        """All held rows by column, from the oldest."""
        chunks = range(head.first_chunk, head.last_chunk + 1)
        if not chunks:
            return head.tail
        sealed = [_loaded(self.history.getValue((head.account, chunk)), head.texts) for chunk in chunks]
        return _joined([tuple(c[head.skip :] for c in _joined(sealed)), head.tail])

    def _remove_chunks(self, head: Head, upto: int) -> None:
        for chunk in range(head.first_chunk, upto):
            self.history.removeKey((head.account, chunk))
        head.first_chunk = upto

    def _write_history(self, head: Head, both: Rows, dropped: int) -> None:
        """Keeps the rows of ``both``, held and new, but for the ``dropped`` oldest; seals full chunks."""
        sealed = (head.last_chunk - head.first_chunk + 1) * CHUNK_ROWS - head.skip
        if dropped >= sealed:
            self._remove_chunks(head, head.last_chunk + 1)
            head.skip, start = 0, dropped
        else:
            whole, head.skip = divmod(head.skip + dropped, CHUNK_ROWS)
            self._remove_chunks(head, head.first_chunk + whole)
            start = sealed
        head.held = len(both[0]) - dropped
        while len(both[0]) - start >= CHUNK_ROWS:
            head.last_chunk += 1
            chunk = _stored(tuple(c[start : start + CHUNK_ROWS] for c in both), head.texts)
            self.history.updateValue((head.account, head.last_chunk), chunk)
            start += CHUNK_ROWS
        head.tail = tuple(c[start:] for c in both)

    def _part(self, cents: np.ndarray, parts: int) -> np.ndarray:
        """By the amount itself in a mixed form, so that round amounts spread."""
        mixed = cents.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(32)).astype(np.int64) % parts

    def _read_amounts(self, account: str, part: int) -> dict[int, int]:
        stored = self.amounts.getValue((account, part))
        return dict(zip(*[_ints(c).tolist() for c in stored], strict=True)) if stored is not None else {}

    def _write_amounts(self, account: str, part: int, held: dict[int, int]) -> None:
        self.amounts.updateValue((account, part), _amounts(held))

    def _add_amounts(self, head: Head, cents: list[int], n: list[int]) -> list[int]:
        """Adds to the numbers of different amounts; the numbers before."""
        before: dict[int, int] = {}

        def add(held: dict[int, int], own: list[tuple[int, int]]) -> None:
            head.amounts -= len(held)
            for c, k in own:
                before[c] = held.get(c, 0)
                held[c] = before[c] + k
            head.amounts += len(held)

        if not head.parts:
            add(head.own, list(zip(cents, n, strict=True)))
        else:
            by_part: dict[int, list[tuple[int, int]]] = {}
            for c, k, part in zip(cents, n, self._part(np.array(cents), head.parts).tolist(), strict=True):
                by_part.setdefault(part, []).append((c, k))
            for part, own in by_part.items():
                held = self._read_amounts(head.account, part)
                add(held, own)
                self._write_amounts(head.account, part, held)
        if not head.parts and head.amounts > PART_AMOUNTS:
            self._write_amounts(head.account, 0, head.own)
            head.own, head.parts = {}, 1
        while head.parts and head.amounts > head.parts * PART_AMOUNTS:
            for part in range(head.parts):
                held = self._read_amounts(head.account, part)
                place = self._part(np.array(list(held), np.int64), 2 * head.parts).tolist()
                for new in (part, part + head.parts):
                    kept = {c: k for (c, k), p in zip(held.items(), place, strict=True) if p == new}
                    self._write_amounts(head.account, new, kept)
            head.parts *= 2
        return [before[c] for c in cents]

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        given = {c: np.concatenate([f[c].to_numpy() for f in frames]) for c in INPUT_COLUMNS}
        usable = given["has_us"].astype(bool) & given["has_cents"].astype(bool)
        if not usable.all():
            yield self._bare({c: v[~usable] for c, v in given.items()}, False)
            given = {c: v[usable] for c, v in given.items()}
        account, names = pd.factorize(given["account_number"])
        order = np.lexsort((given["seq"], given["us"], account))
        given = {c: v[order] for c, v in given.items()}
        ends = np.cumsum(np.bincount(account, minlength=len(names))).tolist()
        watermark = self._watermark_us(timerValues)
        touched: dict[str, int] = {}
        late = np.zeros(len(order), bool)
        run, size, span, texts = [], 0, 0, Texts()
        for name, start, end in zip(names, [0, *ends[:-1]], ends, strict=True):
            head = Head(name, self.heads.getValue((name,)), texts)
            newest = watermark if head.last_us is None else head.last_us
            us = given["us"][start:end]
            behind = 0 if newest is None else int(np.searchsorted(us, newest, side="left"))
            late[start : start + behind] = True
            if behind == end - start:
                continue
            first = int(head.tail[0][0]) if len(head.tail[0]) else int(us[behind])
            # Spans are added up in ``kernel.one_line``; that of sealed rows is not known yet.
            more, wider = head.held + end - start, int(us[-1]) - first if head.last_chunk < head.first_chunk else 1 << 59
            if run and (size + more > RUN_ROWS or span + wider >= 1 << 61):
                yield self._advance(run, given, texts, watermark, touched)
                run, size, span, texts = [], 0, 0, Texts()
                head = Head(name, self.heads.getValue((name,)), texts)
            run.append((head, start + behind, end))
            size, span = size + more, span + wider
        if run:
            yield self._advance(run, given, texts, watermark, touched)
        if late.any():
            yield self._bare({c: v[late] for c, v in given.items()}, True)
        self._remember(touched)

    def _bare(self, given: dict[str, np.ndarray], late: bool) -> pd.DataFrame:
        """Rows without features."""
        return pd.DataFrame(given | {"is_late": late}).reindex(columns=self.columns)

    def _watermark_us(self, timers: Any) -> int | None:
        """None as long as there is no watermark."""
        now = timers.getCurrentWatermarkInMs() if self.bounded else 0
        return now * 1000 if now > 0 else None

    def _advance(
        self, run: list[tuple[Head, int, int]], given: dict[str, np.ndarray], texts: Texts,
        watermark: int | None, touched: dict[str, int],
    ) -> pd.DataFrame:
        """Process new rows of some accounts in order, store the states, return the rows with their features."""
        place = np.concatenate([np.arange(start, end) for _, start, end in run])
        fresh = {c: v[place] for c, v in given.items()}
        words, distinct = pd.factorize(fresh["descr"])
        word = texts.numbers(distinct.tolist())[words]
        new = tuple(fresh[c].astype(np.int64) for c in ("us", "seq", "cents", "dc_sign")) + (word,)
        n_new = np.array([end - start for _, start, end in run])
        stops = np.cumsum(n_new)
        parts, drops, whole = [], [], []
        for (head, _, _), stop, n in zip(run, stops.tolist(), n_new.tolist(), strict=True):
            held = self._read_history(head)
            dropped = 0
            if watermark is not None:
                edge = min(watermark, int(new[0][stop - n])) - self.retention_ms * 1000
                dropped = int(np.searchsorted(held[0], edge))
            both = _joined([held, tuple(c[stop - n : stop] for c in new)])
            whole.append(both)
            drops.append(dropped)
            parts.append(tuple(c[dropped:] for c in both) if dropped else both)
        us, _, cents, sign, descr = _joined(parts)
        size = np.array([len(p[0]) for p in parts])
        last = np.cumsum(size)
        owner = np.repeat(np.arange(len(run)), size)
        at = np.flatnonzero(np.arange(len(us)) >= np.repeat(last - n_new, size))
        out = kernel.lookback_features(
            us, cents, descr, sign, owner, at, (last - size)[owner[at]], self.cap, self.lookback, self.velocity
        )
        mine, amount = owner[at], new[2]
        held_n = [head.n for head, _, _ in run]
        lasts = [(head.last_cents, texts.number.get(head.last_descr, -1)) if head.n else None for head, _, _ in run]
        streaks = kernel.run_lengths(amount, word, mine, lasts, [head.streak for head, _, _ in run])
        code = kernel.codes_of(mine, amount)
        _, first, times = np.unique(code, return_index=True, return_counts=True)
        cuts = np.searchsorted(mine[first], np.arange(len(run) + 1)).tolist()
        cents_of, times = amount[first].tolist(), times.tolist()
        zscore, before = np.zeros(len(at)), []
        for i, ((head, _, _), stop, n) in enumerate(zip(run, stops.tolist(), n_new.tolist(), strict=True)):
            own = slice(stop - n, stop)
            value = amount[own] / 100
            count, means, squares = kernel.running_moments(value, held_n[i], head.mean, head.m2)
            lows = np.minimum.accumulate(np.minimum(amount[own], head.low) if head.n else amount[own])
            highs = np.maximum.accumulate(np.maximum(amount[own], head.high) if head.n else amount[own])
            std = np.where(lows < highs, np.sqrt(squares / count), 0.0)
            np.divide(value - means, std, out=zscore[own], where=std > 0)
            amounts = slice(cuts[i], cuts[i + 1])
            before += self._add_amounts(head, cents_of[amounts], times[amounts])
            self._write_history(head, whole[i], max(drops[i], len(whole[i][0]) - self.cap))
            head.n, head.mean, head.m2 = int(count[-1]), float(means[-1]), float(squares[-1])
            head.low, head.high, head.streak = int(lows[-1]), int(highs[-1]), int(streaks[stop - 1])
            head.last_us, head.last_seq, head.last_cents = (int(c[stop - 1]) for c in new[:3])
            head.last_descr = texts.names[int(word[stop - 1])]
            touched[head.account] = head.last_us
            self.heads.updateValue((head.account,), head.stored())
        out["amount_zscore_account"] = np.round(zscore, 6) + 0.0  # no negative zero
        out["duplicate_streak"] = streaks
        out["same_amount_frequency"] = np.array(before, np.int64)[code] + kernel.times_seen(code)
        out |= fresh | {"is_late": False}
        return pd.DataFrame({c: out[c] for c in self.columns}, copy=False)

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        """Forgets the accounts of the bucket that have been idle for long enough; a timer for the next."""
        now = timerValues.getCurrentWatermarkInMs()
        stored = self.newest.get()
        times = json.loads(bytes(stored[0])) if stored is not None else {}
        over = [a for a, us in times.items() if us // 1000 + self.retention_ms <= now]
        for account in over:
            head = Head(account, self.heads.getValue((account,)), Texts())
            self._remove_chunks(head, head.last_chunk + 1)
            for part in range(head.parts):
                self.amounts.removeKey((account, part))
            self.heads.removeKey((account,))
            del times[account]
        if times:
            self.newest.update((json.dumps(times).encode(),))
            self.handle.registerTimer(min(times.values()) // 1000 + self.retention_ms)
        else:
            self.newest.clear()
        yield pd.DataFrame(columns=self.columns)

    def close(self) -> None:
        pass
