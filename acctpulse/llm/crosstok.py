"""Two tokenizers aligned on the same text, with corpus-wide counts of token pairs.

Equal texts are one: rows are shuffled by their full text, each distinct text is encoded and aligned once,
its pairs count as often as the text occurs, and its measures are joined back to the rows.

Both encodings cover the bytes of a space and the text. Where tokens of both end at the same byte, the
tokens since the last such byte form a group, and the two that end there are a link. A pair's
count is the number of links of the corpus that hold it. Pair counts are bounded by the two vocabularies, not
by the corpus; a table of up to ``BROADCAST_PAIRS`` is broadcast, a larger one is joined by shuffle,
dealt over ``SALTS`` copies as common pairs are in nearly every text.

A long text is cut into segments before a single space between two other characters. There both
tokenizers begin a token: the first by its splitting pattern, the second as none of its pieces has a
space behind another character (checked on loading, else nothing is cut). So neither tokens nor groups change, and memory
is that of a segment and of the text's distinct pairs. A stretch without such a space is one segment.

Defined cases: null and empty texts, and those whose bytes one encoding does not give back, have no tokens: zero measures,
an empty string in place of the hash. Rows with a null id, repeated rows and extra columns
are kept as they are; an empty table gives an empty result; of equal best pairs all are best.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from acctpulse.llm import arrays
from acctpulse.llm.tables import join_facts, keep

SEGMENT = 1 << 17
BROADCAST_PAIRS = 1_000_000
SALTS = 32
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Fixed value: the splitting pattern of byte-level vocabularies of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TEXT = "_acct_text"
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the letters from U+0100 on.
    """
    plain = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Byte-level pair merges from a vocabulary file in JSON; ``pieces`` are the bytes of each id."""

    def __init__(self, vocabulary: bytes):
        import tiktoken

        told = json.loads(vocabulary)
        special = {t["content"] for t in told["added_tokens"]}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in told["model"]["vocab"].items() if token not in special
        }
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        first = len(ranks) - len(merges)
        ids = told["model"]["vocab"]
        if told["normalizer"] or any(ids[a + b] != first + i for i, (a, b) in enumerate(merges)):
            raise ValueError("ids must follow the order of the merges, and texts must not be normalised")
        self.pieces = [b""] * (1 + max(ranks.values()))
        for token, i in ranks.items():
            self.pieces[i] = token
        coder = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.encode = coder.encode_ordinary


class Pieces:
    """A sentence-piece model; ``encode`` takes a segment's text without its leading space."""

    def __init__(self, model: bytes):
        import sentencepiece

        coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [coder.id_to_piece(i) for i in range(coder.get_piece_size())]
        as_byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.pieces = [
            bytes([int(m[1], 16)]) if (m := as_byte.fullmatch(p)) else p.replace("▁", " ").encode()
            for p in names
        ]
        self.can_cut = not any("▁" in p[1:] and p.strip("▁") for p in names)
        self.encode = coder.encode


class Aligner:
    """Both tokenizers and the tables that a task needs for them."""

    def __init__(self, vocabulary: bytes, model: bytes):
        self.a, self.b = ByteLevel(vocabulary), Pieces(model)
        self.len_a = np.array([len(p) for p in self.a.pieces])
        self.len_b = np.array([len(p) for p in self.b.pieces])
        # The form of an id in a group: followed by a comma, or by what ends its side.
        self.digits_a = np.array([f"{i}{e}" for e in ",|" for i in range(len(self.len_a))], object)
        self.digits_b = np.array([f"{i}{e}" for e in ",;" for i in range(len(self.len_b))], object)

    def segments(self, text: str, size: int = SEGMENT) -> Iterator[str]:
        """The text in pieces that each tokenizer takes alone; each but the first lacks the space before it."""
        start = 0
        while self.b.can_cut and len(text) - start > size:
            found = CUT.search(text, start + size)
            if not found:
                break
            yield text[start : found.start()]
            start = found.end()
        yield text[start:]

    def align(self, text: str, size: int = SEGMENT) -> tuple:
        """Counts, the distinct pairs with their numbers, and the hash of the groups."""
        none = np.zeros(0, np.int64)
        without = (0, 0, 0, 0, none, none, "")
        n_a = n_b = n_links = 0
        pairs: list[np.ndarray] = []
        pending = 0
        digest = hashlib.sha256()
        for segment in self.segments(text, size):
            spaced = " " + segment
            told = spaced.encode()
            ids_a, ids_b = self.a.encode(spaced), self.b.encode(segment)
            if b"".join(map(self.b.pieces.__getitem__, ids_b)) != told:
                return without
            if b"".join(map(self.a.pieces.__getitem__, ids_a)) != told:
                return without
            a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
            end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
            _, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
            if n_a:
                digest.update(b";")
            digest.update(self._groups(a, b, at_a, at_b).encode())
            pairs.append(a[at_a] * len(self.len_b) + b[at_b])
            n_a, n_b, n_links = n_a + len(a), n_b + len(b), n_links + len(at_a)
            pending += len(at_a)
            if pending > 1 << 20:
                pairs, pending = [_tally(pairs)], 0
        pair, count = _tally(pairs)
        return n_a, n_b, n_links, n_links, pair, count, digest.hexdigest()

    def _groups(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: a group's side begins behind all earlier groups' tokens of both."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[at_a] = 1
        last_b[at_b] = 1
        before_b = np.concatenate([[0], at_b + 1])[np.cumsum(last_a) - last_a]
        before_a = (at_a + 1)[np.cumsum(last_b) - last_b]
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + before_b] = self.digits_a[a + last_a * len(self.len_a)]
        out[np.arange(len(b)) + before_a] = self.digits_b[b + last_b * len(self.len_b)]
        return "".join(out.tolist())[:-1]


def _tally(parts: list[np.ndarray]) -> np.ndarray:
    """Pairs and their numbers in two rows; parts are lists of pairs or such tallies."""
    plain = [p for p in parts if p.ndim == 1]
    told = [p for p in parts if p.ndim == 2]
    pair = np.concatenate([*plain, *[t[0] for t in told]]) if parts else np.zeros(0, np.int64)
    weight = np.concatenate([np.ones(sum(map(len, plain)), np.int64), *[t[1] for t in told]])
    distinct, place = np.unique(pair, return_inverse=True)
    return np.stack([distinct, np.bincount(place, weight, len(distinct)).astype(np.int64)])


LOADED: dict[str, Aligner] = {}


def aligner(vocabulary: bytes, model: bytes) -> Aligner:
    """One per worker process."""
    name = hashlib.sha256(vocabulary + model).hexdigest()
    if name not in LOADED:
        LOADED.clear()
        LOADED[name] = Aligner(vocabulary, model)
    return LOADED[name]


SCHEMA = (
    "digest binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "pairs array<bigint>, counts array<bigint>, groups_sha256 string"
)


def aligned_texts(texts: DataFrame, vocabulary: bytes, model: bytes) -> DataFrame:
    """``SCHEMA`` for distinct ``_acct_text`` with ``digest`` and ``copies``; one row a text."""
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(*shared.value)
        for batch in batches:
            for part in arrays.blocks(batch, TEXT):
                found = [tool.align(t) for t in part.column(TEXT).to_pylist()]
                columns = list(zip(*found, strict=True))
                numbers = [pa.array(c, pa.int64()) for c in columns[:4]]
                lists = [_lists(c) for c in columns[4:6]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), part.column("copies"), *numbers, *lists,
                     pa.array(columns[6], pa.string())],
                    ["digest", "copies", "n_a", "n_b", "n_groups", "n_links", "pairs", "counts",
                     "groups_sha256"],
                )

    return texts.select("digest", "copies", TEXT).mapInArrow(run, SCHEMA)


def _lists(values: tuple[np.ndarray, ...]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int64), *values])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """``pair``, ``total`` and whether no other pair of its second id has a higher one.

    Partial sums come before the shuffle; a second id has at most one pair a first id.
    """
    each = aligned.select("copies", F.inline(F.arrays_zip("pairs", "counts")))
    totals = each.groupBy(F.col("pairs").alias("pair")).agg(
        F.sum(F.col("copies") * F.col("counts")).alias("total")
    )
    highest = F.max("total").over(Window.partitionBy(F.col("pair") % n_b))
    return totals.withColumn("best", F.col("total") == highest)


def measured(aligned: DataFrame, totals: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``digest``, ``n_best`` and ``count_sum`` of each text; ``totals`` is a written table."""
    each = aligned.select("digest", F.inline(F.arrays_zip("pairs", "counts")))
    each = each.withColumnRenamed("pairs", "pair")
    if totals.count() <= broadcast_pairs:
        joined = each.join(F.broadcast(totals), "pair")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        dealt = F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int")
        joined = each.withColumn("salt", dealt).join(totals.select("*", salts), ["pair", "salt"])
    return joined.groupBy("digest").agg(
        F.sum(F.when(F.col("best"), F.col("counts")).otherwise(0)).alias("n_best"),
        F.sum(F.col("counts") * F.col("total")).alias("count_sum"),
    )


def cross_align(
    rows: DataFrame, keys: list[str], vocabulary: bytes, model: bytes,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """``keys``, the measures and ``groups_sha256`` for every row of ``rows``, and the table of pair counts.

    ``rows`` has a ``text``; ``vocabulary`` and ``model`` are the contents of the two files.
    A pair is the first id times the second vocabulary's size plus the second id.
    """
    spark: SparkSession = rows.sparkSession
    size_b = len(Pieces(model).pieces)
    filled = F.col("text").isNotNull() & (F.col("text") != "")
    distinct = (
        rows.where(filled).groupBy(F.col("text").alias(TEXT)).agg(F.count("*").alias("copies"))
        .withColumn("digest", F.unhex(F.sha2(F.col(TEXT).cast("binary"), 256)))
    )
    aligned = keep(aligned_texts(distinct, vocabulary, model), "aligned")
    totals = keep(pair_counts(aligned, size_b), "pair-counts")
    facts = aligned.drop("pairs", "counts").join(measured(aligned, totals, broadcast_pairs), "digest", "left")
    facts = keep(facts, "text-measures").withColumnRenamed("digest", "_acct_digest")
    light = rows.select(
        *keys, F.when(filled, F.unhex(F.sha2(F.col("text").cast("binary"), 256))).alias("_acct_digest")
    )
    joined = join_facts(light, facts.withColumnRenamed("copies", "_acct_copies"), "_acct_digest", "_acct_copies")
    zeros = [F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES]
    hashed = F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    return joined.select(*keys, *zeros, hashed), totals
