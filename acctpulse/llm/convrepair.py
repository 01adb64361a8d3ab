"""Conversations brought back into the order system?, (user, assistant)+ with the cheapest edits.

Rows may be kept, given the role that is due (2), deleted (3; blank and repeated rows must be), and rows without
text inserted (2). A row that is cut off and stays costs 1. Each conversation becomes a signature, one
letter a row for its role and fault. Signatures are sorted from their ends, so those
that end alike lie side by side and share one chain of automaton nodes: each distinct ending is a node once, in
all conversations (at the border of two tasks, once in either). For each node and grammar state there is one cost to go
and one best audit suffix. Nodes that agree in these, but for a constant, are one
state of the minimised automaton: its transitions, a few hundred, are worked out once in a task, and a
node is an integer and a cost. A best suffix is held as its first edits and the state behind them; suffixes
are compared by these and by the ranks of the states' suffixes at the next node, never as text.
Insertions count to the row that follows them, so edits of a part never are the beginning of other edits
of the same part, and joined parts compare as their audits do.

Texts move once, for the hash of the repaired conversation. All else runs on rows of some 60 bytes, dealt by range, so that a
conversation of any length is spread; its letters are put together from one piece a range. Only that
hash and the audit, single values of a conversation, are made in one task, which streams over its sorted rows.

Defined cases: nulls of role and text are one space; a null conversation is one of its own; rows go by turn,
nulls first, equal turns by role, then by the text's SHA-256; equal rows of a turn repeat each other; a conversation without rows
has zeros and an empty audit; extra columns are ignored; an empty table gives an empty result; texts may
be of any length, and are never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctpulse.llm.tables import join_facts, keep

#: Costs of the edits, roles of the grammar and faults in the order of their check.
RETOLD, DELETED, INSERTED, CUT_OFF = 2, 3, 2, 1
ROLES = "sua"
FAULTS = ["none", "truncated", "blank", "duplicate"]
#: Grammar states: at the beginning, after s, after u, after a. Those in which a conversation may end.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FINAL = {START, AFTER_A}
LEGAL = {"su", "ua", "au"}
DUE = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
NEXT = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
NAMES = {"u": b"user", "a": b"assistant"}
CONV, TURN, ROLE, TEXT, DIGEST = "_acct_conv", "_acct_turn", "_acct_role", "_acct_text", "_acct_digest"
ORDER = [TURN, ROLE, DIGEST]
COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def letter(role: str, fault: str) -> str:
    """A row's letter in a signature."""
    return chr(ord("A") + FAULTS.index(fault) * 4 + (ROLES.index(role) if role in ROLES and role else 3))


def meaning(symbol: str) -> tuple[str, str]:
    """Role initial, ``x`` if not of the grammar, and fault of a letter."""
    fault, role = divmod(ord(symbol) - ord("A"), 4)
    return (ROLES + "x")[role], FAULTS[fault]


class Automaton:
    """The minimised automaton: states by cost and suffix of each grammar state, transitions found once.

    ``states[i]`` is (costs above the least, ranks of the suffixes) for the four grammar states.
    """

    def __init__(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.moves: dict[tuple[int, str], tuple] = {}
        ends = {START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}
        self.ends = [ends[q] for q in range(4)]
        costs = [INSERTED * len(e) for e in self.ends]
        self.end, self.end_cost = self._state(costs, self.ends)

    def _state(self, costs: list[int], keys: list) -> tuple[int, int]:
        order = {k: i for i, k in enumerate(sorted(set(keys)))}
        least = min(costs)
        told = (tuple(c - least for c in costs), tuple(order[k] for k in keys))
        if told not in self.number:
            self.number[told] = len(self.states)
            self.states.append(told)
        return self.number[told], least

    def move(self, state: int, symbol: str) -> tuple[int, int, list[tuple[str, int]]]:
        """The state one row earlier, the cost added, and per grammar state its edits and what follows them."""
        if (state, symbol) not in self.moves:
            costs, ranks = self.states[state]
            best = [min(self._edits(q, symbol, costs, ranks)) for q in range(4)]
            earlier, added = self._state([b[0] for b in best], [b[1:3] for b in best])
            self.moves[state, symbol] = earlier, added, [(b[1], b[3]) for b in best]
        return self.moves[state, symbol]

    @staticmethod
    def _edits(q: int, symbol: str, costs: tuple, ranks: tuple) -> Iterator[tuple[int, str, int, int]]:
        """All ways to treat a row in grammar state ``q``: cost to go, edits, rank of the rest, next state."""
        role, fault = meaning(symbol)
        stays = fault in ("none", "truncated")
        cut = CUT_OFF if fault == "truncated" else 0
        edits, cost = "", 0
        for _ in range(4):  # more insertions only repeat a grammar state
            yield cost + DELETED + costs[q], edits + "D", ranks[q], q
            if stays:
                due = NEXT[DUE[q]]
                yield cost + RETOLD + cut + costs[due], edits + "R", ranks[due], due
                if role == DUE[q] or (role == "s" and q == START):
                    to = NEXT[role]
                    yield cost + cut + costs[to], edits + "K", ranks[to], to
            edits, cost, q = edits + "I", cost + INSERTED, NEXT[DUE[q]]


class SharedSuffixes:
    """The chain of nodes of the signature at hand; the next one keeps the nodes of the ending they share."""

    def __init__(self) -> None:
        self.automaton = Automaton()
        self.letters = ""
        #: Per depth: automaton state, cost below it, and the edits chosen there.
        self.chain = [(self.automaton.end, self.automaton.end_cost, [])]
        self.made = 0

    def repair(self, backwards: str) -> tuple[int, str]:
        """Cost and audit of a signature, given from its end; sorted ones share the most nodes."""
        shared = 0
        for x, y in zip(self.letters, backwards, strict=False):
            if x != y:
                break
            shared += 1
        del self.chain[shared + 1 :]
        for symbol in backwards[shared:]:
            state, cost, _ = self.chain[-1]
            earlier, added, choice = self.automaton.move(state, symbol)
            self.chain.append((earlier, cost + added, choice))
        self.made += len(backwards) - shared
        self.letters = backwards
        state, cost, _ = self.chain[-1]
        audit, q = [], START
        for _, _, choice in reversed(self.chain[1:]):
            edits, q = choice[q]
            audit.append(edits)
        return cost + self.automaton.states[state][0][START], "".join(audit) + self.automaton.ends[q]


def faults(signature: str) -> list[int]:
    """Numbers of blank, repeated, cut-off rows and of neighbours in an illegal order."""
    told = [meaning(s) for s in signature]
    counts = [sum(f == name for _, f in told) for name in ("blank", "duplicate", "truncated")]
    pairs = zip(told, told[1:], strict=False)
    return [*counts, sum(x[0] + y[0] not in LEGAL for x, y in pairs)]


def _given(rows: DataFrame) -> DataFrame:
    """Rows under internal names, without nulls in role and text."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    return rows.select(
        F.col("conv_id").alias(CONV), F.col("turn").alias(TURN),
        F.coalesce(F.col("role"), F.lit(" ")).alias(ROLE), text.alias(TEXT),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias(DIGEST),
    )


def _fault_of_text() -> Column:
    blank = ~F.col(TEXT).rlike(r"[^\x20\x09-\x0D]")
    ended = F.col(TEXT).rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return F.when(blank, "blank").when(~ended, "truncated").otherwise("none")


def signatures(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``_acct_conv``, ``gaps`` and ``signature`` for each of ``conversations``."""
    light = keep(
        _given(rows).select(CONV, *ORDER, _fault_of_text().alias("fault")), "conversation-rows"
    )
    # Equal rows of a turn are one with a number; a text's first turn is found by partial minima. So each
    # key of the join is one row on either side, however often a text or a conversation occurs.
    alike = light.groupBy(CONV, *ORDER, "fault").agg(F.count("*").alias("n"))
    first = light.groupBy(CONV, ROLE, DIGEST).agg(F.min(F.struct(TURN)).alias("first")).select(
        F.col(CONV).alias("c"), F.col(ROLE).alias("r"), F.col(DIGEST).alias("d"), f"first.{TURN}",
    ).withColumnRenamed(TURN, "t")
    same = F.col(CONV).eqNullSafe(F.col("c")) & F.col(TURN).eqNullSafe(F.col("t"))
    same &= (F.col(ROLE) == F.col("r")) & (F.col(DIGEST) == F.col("d"))
    told = alike.join(first, same, "left")
    is_first = F.col("r").isNotNull()
    initial = F.substring(ROLE, 1, 1)
    role = F.when(initial.isin(*ROLES), initial).otherwise("x")
    letters = F.create_map(
        *[F.lit(x) for f in FAULTS for r in ROLES + "x" for x in (r + f, letter(r, f))]
    )
    blank = F.col("fault") == "blank"
    own = letters[F.concat(role, F.when(blank | is_first, F.col("fault")).otherwise("duplicate"))]
    further = letters[F.concat(role, F.when(blank, "blank").otherwise("duplicate"))]
    spelled = F.concat(own, F.repeat(further, (F.col("n") - 1).cast("int")))
    marked = told.select(CONV, *ORDER, spelled.alias("letters"))
    empty = conversations.select(F.col("conv_id").alias(CONV)).distinct().select(
        CONV, F.lit(None).cast(light.schema[TURN].dataType).alias(TURN), F.lit("").alias(ROLE),
        F.lit(b"").alias(DIGEST), F.lit("").alias("letters"),
    )
    marked = keep(marked.unionByName(empty), "marked-rows")
    name, kind = CONV, marked.schema[CONV].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seq, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column(name))
            ends = runs.run_ends.to_pylist()
            spelled = batch.column("letters").to_pylist()
            parts = batch.column("part").slice(0, len(ends))
            text = ["".join(spelled[i:j]) for i, j in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [runs.values, parts, pa.array([seq] * len(ends), pa.int64()), pa.array(text)],
                [name, "part", "seq", "piece"],
            )

    dealt = marked.repartitionByRange(CONV, *ORDER).sortWithinPartitions(CONV, *ORDER)
    cut = dealt.select(CONV, F.spark_partition_id().alias("part"), "letters").mapInArrow(
        pieces, f"{CONV} {kind}, part int, seq bigint, piece string"
    )
    in_order = F.array_sort(F.collect_list(F.struct("part", "seq", "piece")))
    spelled = cut.groupBy(CONV).agg(
        F.array_join(F.transform(in_order, lambda p: p.piece), "").alias("signature")
    )
    span = F.max(TURN) - F.min(TURN) + 1 - F.count_distinct(TURN)
    gaps = light.groupBy(F.col(CONV).alias("c")).agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"))
    joined = spelled.join(gaps, F.col(CONV).eqNullSafe(F.col("c")), "left")
    return joined.select(CONV, F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps"), "signature")


def repaired_signatures(told: DataFrame) -> DataFrame:
    """Each distinct ``signature`` with the number of its conversations, its faults, cost and audit."""
    distinct = told.groupBy("signature").agg(F.count("*").alias("n")).withColumn(
        "backwards", F.reverse("signature")
    )
    dealt = distinct.repartitionByRange(F.substring("backwards", 1, 64)).sortWithinPartitions("backwards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = SharedSuffixes()
        for batch in batches:
            found = [shared.repair(b) for b in batch.column("backwards").to_pylist()]
            counts = [faults(s) for s in batch.column("signature").to_pylist()]
            columns = [*zip(*counts, strict=True)] or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("signature"), batch.column("n"),
                 *[pa.array(c, pa.int64()) for c in columns],
                 pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                ["signature", "n", *COUNTS, "audit"],
            )

    kinds = ", ".join(f"{c} bigint" for c in COUNTS)
    return dealt.mapInArrow(run, f"signature string, n bigint, {kinds}, audit string")


class Hashing:
    """The running hash of one repaired conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.digest = hashlib.sha256()
        self.empty = True

    def _put(self, role: bytes, text: bytes) -> None:
        self.digest.update((b"" if self.empty else b"\n") + role + b":" + text)
        self.empty = False

    def _insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            due = DUE[self.state]
            self._put(NAMES[due], b"")
            self.state, self.at = NEXT[due], self.at + 1

    def row(self, role: str, text: str) -> None:
        self._insertions()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "D":
            return
        to = DUE[self.state] if edit == "R" else role[0]
        self._put(NAMES[to] if edit == "R" else role.encode(), text.encode())
        self.state = NEXT[to]

    def end(self) -> str:
        self._insertions()
        return self.digest.hexdigest()


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row for each ``conv_id`` of ``conversations`` (those of ``rows`` by default).

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text``. The result has ``gaps`` in the turns, numbers of
    ``blank``, ``duplicate`` and ``truncated`` rows and of ``illegal`` neighbours, the ``cost``, the ``audit``
    (K, R, D, I for keep, rerole, delete, insert; of equal costs the least in ASCII) and
    ``repaired_sha256`` of the repaired rows as ``role:text`` lines.
    """
    told = keep(signatures(rows, rows if conversations is None else conversations), "signatures")
    solved = keep(repaired_signatures(told), "repaired-signatures")
    facts = join_facts(told, solved, "signature", "n").drop("signature", "n")
    longs = ["gaps", *COUNTS]
    head = facts.select(
        CONV, F.lit(0).alias("_acct_kind"), F.lit(None).cast("bigint").alias(TURN), F.lit("").alias(ROLE),
        F.lit(b"").alias(DIGEST), F.col("audit").alias(TEXT), F.struct(*longs).alias("_acct_facts"),
    )
    given = _given(rows)
    body = given.select(
        CONV, F.lit(1).alias("_acct_kind"), TURN, ROLE, DIGEST, TEXT,
        F.lit(None).cast(head.schema["_acct_facts"].dataType).alias("_acct_facts"),
    )
    head = head.withColumn(TURN, F.col(TURN).cast(given.schema[TURN].dataType))
    lines = head.unionByName(body).repartition(CONV).sortWithinPartitions(CONV, "_acct_kind", *ORDER)
    name, kind = CONV, given.schema[CONV].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv = at_hand = facts = None

        def emit() -> pa.RecordBatch:
            convs, told, audits, hashed = zip(*done, strict=True)
            columns = [pa.array([t[c] for t in told], pa.int64()) for c in longs]
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(convs, key_type), *columns, pa.array(audits, pa.string()), pa.array(hashed)],
                ["conv_id", *longs, "audit", "repaired_sha256"],
            )

        for batch in batches:
            key_type = batch.column(name).type
            columns = [batch.column(c) for c in (name, "_acct_kind", ROLE, TEXT, "_acct_facts")]
            for c, k, role, text, told in zip(*[x.to_pylist() for x in columns], strict=True):
                if k:
                    at_hand.row(role, text)
                    continue
                if at_hand:
                    done.append((conv, facts, at_hand.audit, at_hand.end()))
                conv, facts, at_hand = c, told, Hashing(text)
            if done:
                yield emit()
        if at_hand:
            done.append((conv, facts, at_hand.audit, at_hand.end()))
            yield emit()

    kinds = ", ".join(f"{c} bigint" for c in longs)
    return lines.drop(TURN, DIGEST).mapInArrow(
        run, f"conv_id {kind}, {kinds}, audit string, repaired_sha256 string"
    )
