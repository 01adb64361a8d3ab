import hashlib
import itertools
import random
import zlib
from functools import cache

import duckdb
import pytest

from acctpulse.llm import convrepair, oracle, queries
from acctpulse.llm.convrepair import letter

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACE = "\t\n\v\f\r "
GRAMMAR = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
LONG = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """Cost and audit of (initial, fault) rows by trying every edit, with whole audits compared."""

    @cache
    def best(i, last, inserts):
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, ""))
        if inserts < 4:
            for to in "ua":
                if (last, to) in GRAMMAR:
                    cost, audit = best(i, to, inserts + 1)
                    found.append((cost + 2, "I" + audit))
        if i < len(rows):
            initial, fault = rows[i]
            cost, audit = best(i + 1, last, 0)
            found.append((cost + 3, "D" + audit))
            if fault in ("none", "truncated"):
                more = fault == "truncated"
                for to, edit, price in [(initial, "K", 0), ("u", "R", 2), ("a", "R", 2)]:
                    if (last, to) in GRAMMAR:
                        cost, audit = best(i + 1, to, 0)
                        found.append((cost + price + more, edit + audit))
        return min(found, default=(10**9, ""))

    for i in range(len(rows), 0, -1):  # from the end, so that no call goes deep
        for last in ("", "s", "u", "a"):
            best(i, last, 0)
    return best(0, "", 0)


def expected(data):
    """Rows of the result, from the definition; ``data`` after any damage."""
    out = {}
    for conv in {r[0] for r in data}:
        rows = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in data if c == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, told = set(), []
        for _, role, text in rows:
            left = text.rstrip(SPACE)
            if not left:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "none" if left[-1] in ".!?" else "truncated"
            seen.add((role, text))
            told.append((role[:1], fault))
        cost, audit = cheapest(tuple(told))
        at, last, lines = iter(rows), "", []
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(at)[1:]
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        pairs = [a[0] + b[0] for a, b in zip(told, told[1:], strict=False)]
        counts = [sum(f == n for _, f in told) for n in ("blank", "duplicate", "truncated")]
        out[conv] = (
            gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def collected(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_every_short_signature_has_the_cheapest_and_least_audit():
    alphabet = [(r, f) for r in "suax" for f in ("none", "truncated")] + [("u", "blank"), ("a", "duplicate")]
    short = [s for n in range(5) for s in itertools.product(alphabet, repeat=n)]
    rng = random.Random(3)
    short += [tuple(rng.choice(alphabet) for _ in range(rng.randint(5, 30))) for _ in range(300)]
    shared = convrepair.SharedSuffixes()
    spelled = {"".join(letter(*x) for x in s)[::-1]: s for s in short}
    for backwards in sorted(spelled):
        assert shared.repair(backwards) == cheapest(spelled[backwards]), backwards
    assert shared.made < sum(map(len, spelled))  # endings in common are nodes once
    assert len(shared.automaton.states) < 50


def made(n, seed=1):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "What?", "cut off", "", " \n", "a. b", "ends here. \t", "Ünï.", "tail…"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    out = []
    for conv in range(n):
        for turn in range(rng.randint(0, 9)):
            if rng.random() < 0.9:
                out.append((conv, turn if rng.random() < 0.95 else None, rng.choice(roles), rng.choice([*texts, None])))
    return out


def test_results_equal_the_definition_with_awkward_rows(spark):
    rng = random.Random(5)
    data = made(60)
    data += [(None, 1, "user", "a."), (None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", "b.")]
    data += [(900, t, rng.choice(["user", "assistant"]), rng.choice(["x.", "y", "z!"]) * rng.randint(1, 9)) for t in range(700)]
    data += [(901, t, "user", "same.") for t in range(300)] + [(902, -5, "user", "w " * 60_000)]
    data += [(1000 + i, t, r, "Common.") for i in range(80) for t, r in enumerate(["user", "assistant", "user"])]
    rng.shuffle(data)
    frame = spark.createDataFrame(data, SCHEMA).selectExpr(
        "*", "'x' as signature", "1 as gaps", "'q' as audit", "2 as n", "3 as letters", "4 as part"
    )
    got = convrepair.repair(frame.repartition(5))
    assert got.columns == ["conv_id", "gaps", *convrepair.COUNTS, "audit", "repaired_sha256"]
    told = collected(got)
    assert told == expected(data)
    assert got.count() == len(told)


def test_conversations_without_rows_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.")], SCHEMA)
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "conv_id bigint")
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    told = collected(convrepair.repair(rows, ids))
    assert told[2] == none and told[None] == none and told[1][5:7] == (2, "KI") and len(told) == 3
    assert convrepair.repair(rows.where("false")).collect() == []


def test_damage_follows_its_rule_and_sql_agrees(spark, tmp_path):
    data = made(200, 7)
    data += [(None, i, "user", "A. b?") for i in range(30)] + [(5000 + i, None, None, None) for i in range(30)]
    data = list({(c, t): (c, t, r, x) for c, t, r, x in data}.values())  # one row a turn, as ties have no order in the rule
    frame = spark.createDataFrame(data, SCHEMA)
    frame.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    changed = []
    for conv, turn, role, text in data:
        spelled = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        rest = zlib.crc32(spelled.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if rest == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if rest == 2 else text
        role = "user" if rest == 4 else role
        changed += [(conv, turn, role, text)] * (0 if rest == 0 else 2 if rest == 3 else 1)
    told = collected(queries.conversation_repair(spark, str(tmp_path)))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert told == dict.fromkeys({r[0] for r in data}, empty) | expected(changed)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert {r[0]: r[1:] for r in con.sql(oracle.OP11).fetchall()} == told


@pytest.mark.parametrize("text", ["a." + " " * 5000, "." * 5000 + "x", "\n".join(["."] * 3000)])
def test_long_endings_are_judged_whole(spark, text):
    rows = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", "b.")], SCHEMA)
    truncated = text.rstrip(SPACE)[-1] not in ".!?"
    assert collected(convrepair.repair(rows))[1][3] == int(truncated)
