"""Benchmark decontamination by a prefix-filtered join of word shingles.

A document is searched for every run of ``WINDOW`` words of a benchmark item. For a run to be
contained, all its shingles must be; so it is enough to join on one of them, the necessary
prefix: the one that is rarest in the corpus. Its place in the run fixes where the run would
have to lie (positional bound), the run must fit into the document (length bound), and what is
left is compared word by word.

One pass over the texts counts words and keeps the stretches of text whose shingles occur in the
benchmark, by a bit table of at most 32 MB; only these stretches are shuffled. Shingles found by
chance in the table are dropped by the exact join.

Defined cases: null and wordless texts have no words, no hits, and are not contaminated; a
wordless item is never found. An item that is repeated under another id counts as two items; a
document that is repeated is judged each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctpulse.llm import arrays
from acctpulse.llm.tables import KEY, keep

WINDOW = 13
SHINGLE = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BITS = 28


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Distinct runs: ``wid``, ``run`` (words joined by blanks), ``len``; and ``items`` as rows.

    Columns: item_id, run, len, k (words of its shingles).
    """
    words = benchmark.select("item_id", words_of(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (
        words.where(F.size("w") > 0)
        .select("item_id", "w", F.explode(starts).alias("i"))
        .select("item_id", F.slice("w", F.col("i"), F.lit(window)).alias("w"))
        .select("item_id", F.array_join("w", " ").alias("run"), F.size("w").alias("len"))
        .distinct()
        .withColumn("k", F.least(F.col("len"), F.lit(shingle)))
    )


def run_shingles(runs: DataFrame) -> DataFrame:
    """``run``, ``len``, ``offset`` and ``shingle`` for each distinct run and place in it."""
    w = F.split("run", " ")
    places = F.sequence(F.lit(0), F.col("len") - F.col("k"))
    return (
        runs.select("run", "len", "k")
        .distinct()
        .select("run", "len", "k", w.alias("w"), F.explode(places).alias("offset"))
        .select(
            "run", "len", "offset",
            F.array_join(F.slice("w", F.col("offset") + 1, F.col("k")), " ").alias("shingle"),
        )
    )


def _bit_table(shingles: DataFrame) -> tuple[np.ndarray, int, list[int]]:
    """Bits set at the hashes of all shingles; the table's size in bits as a power of two; k's."""
    distinct = keep(shingles.select("shingle").distinct(), "benchmark-shingles")
    row = distinct.agg(
        F.count("*").alias("n"),
        F.collect_set(F.size(F.split("shingle", " "))).alias("ks"),  # SHINGLE values at most
    ).first()
    bits = min(MAX_BITS, max(16, int(row["n"] * 64).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = arrays.Words(*arrays.utf8(batch.column("shingle")))
            at = []
            for k in row["ks"]:
                h, doc, _ = words.shingles(k)
                at.append(h[np.diff(words.first)[doc] == k])
            h = np.concatenate(at or [np.zeros(0, np.uint64)]) >> np.uint64(64 - bits)
            one = np.left_shift(np.int64(1), (h & np.uint64(31)).astype(np.int64))
            yield pa.RecordBatch.from_pydict(
                {"cell": (h >> np.uint64(5)).astype(np.int64), "bits": one}
            )

    cells = (
        distinct.mapInArrow(places, "cell bigint, bits bigint")
        .groupBy("cell")
        .agg(F.bit_or("bits").alias("bits"))
        .collect()  # 2 ** (MAX_BITS - 5) rows at most
    )
    table = np.zeros(1 << (bits - 5), np.uint32)
    if cells:
        table[[c["cell"] for c in cells]] = [c["bits"] for c in cells]
    return table, bits, sorted(row["ks"])


def scan(docs: DataFrame, shingles: DataFrame, names: list[str]) -> DataFrame:
    """Per row ``names``, ``n_words`` and ``parts``: stretches that may hold benchmark shingles.

    A part has the place of its first word, its words, and the places (from its start) and word
    counts of the shingles that were found.
    """
    table, bits, ks = _bit_table(shingles)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # 2 ** MAX_BITS bits at most

    def found(h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - bits)
        cell = shared.value[(at >> np.uint64(5)).astype(np.int64)]
        return ((cell >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1)).astype(bool)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.blocks(batch, "_acct_text"):
                words = arrays.Words(*arrays.utf8(part.column("_acct_text")))
                cover = np.zeros(len(words.hash) + 1, np.int64)
                hits = []
                for k in ks:
                    h, _, at = words.shingles(k)
                    at = at[found(h)]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + k, -1)
                    hits.append(np.stack([at, np.full(len(at), k)], 1))
                covered = np.cumsum(cover[:-1]) > 0
                edge = np.diff(words.doc, prepend=-1) > 0
                begins = np.flatnonzero(covered & (edge | ~np.r_[False, covered[:-1]]))
                stops = np.flatnonzero(covered & np.r_[edge[1:] | ~covered[1:], True]) + 1
                hits = np.concatenate(hits) if hits else np.zeros((0, 2), np.int64)
                owner = np.searchsorted(begins, hits[:, 0], "right") - 1
                rows: list[list] = [[] for _ in range(part.num_rows)]
                by_part: dict[int, list] = {}
                for (at, k), p in zip(hits.tolist(), owner.tolist(), strict=True):
                    by_part.setdefault(p, []).append({"at": at - int(begins[p]), "k": k})
                for p, places in by_part.items():
                    s, e = int(begins[p]), int(stops[p])
                    doc = int(words.doc[s])
                    rows[doc].append(
                        {"start": s - int(words.first[doc]), "text": words.text(s, e),
                         "found": places}
                    )
                cols = [part.column(c) for c in names]
                cols.append(pa.array(np.diff(words.first).astype(np.int64)))
                cols.append(pa.array(rows, PARTS))
                yield pa.RecordBatch.from_arrays(cols, [*names, "n_words", "parts"])

    given = docs.select(*names, F.col("text").alias("_acct_text"))
    kinds = ", ".join(f"{c} {given.schema[c].dataType.simpleString()}" for c in names)
    return given.mapInArrow(
        search,
        f"{kinds}, n_words bigint, parts array<struct<start: bigint, text: string, "
        "found: array<struct<at: bigint, k: bigint>>>>",
    )


PARTS = pa.list_(pa.struct([
    ("start", pa.int64()), ("text", pa.string()),
    ("found", pa.list_(pa.struct([("at", pa.int64()), ("k", pa.int64())]))),
]))


def contained_runs(scanned: DataFrame, runs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Row key, ``start``, ``len`` and ``run`` of every benchmark run that a document contains."""
    shingles = run_shingles(runs)
    parts = scanned.where(F.size("parts") > 0).select(
        *KEY, "n_words", F.explode("parts").alias("p")
    )
    # Each place with the words around it, as far as a run through it could reach.
    w = F.split("p.text", " ")
    found = parts.select(
        *KEY, "n_words", F.col("p.start").alias("_s"), w.alias("_w"),
        F.explode("p.found").alias("f"),
    )
    at, k = F.col("f.at").cast("int"), F.col("f.k").cast("int")
    back = F.least(at, F.lit(window))
    found = keep(
        found.select(
            *KEY, "n_words", (F.col("_s") + at).alias("place"), back.alias("back"),
            F.array_join(F.slice("_w", at + 1, k), " ").alias("shingle"),
            F.array_join(F.slice("_w", at - back + 1, back + window), " ").alias("around"),
        ),
        "shingles-found",
    )
    frequency = found.groupBy("shingle").agg(F.count("*").alias("freq"))
    rarest = (
        shingles.join(frequency, "shingle", "left")
        .groupBy("run", "len")
        .agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "shingle", "offset")
                   ).alias("prefix"))
        .where(F.col("prefix.freq") > 0)
        .select("run", "len", "prefix.shingle", "prefix.offset")
    )
    start = F.col("place") - F.col("offset")
    inside = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    first = F.col("back") - F.col("offset") + 1
    candidate = F.array_join(F.slice(F.split("around", " "), first, F.col("len")), " ")
    return (
        found.join(rarest, "shingle")
        .where(inside & (first >= 1))
        .where(candidate == F.col("run"))
        .select(*KEY, start.alias("start"), "len", "run")
        .distinct()
    )


def hits_per_row(docs: DataFrame, benchmark: DataFrame, extra: list[str]) -> DataFrame:
    """Row key, ``extra``, ``n_words``, ``n_hit``, ``items`` (sorted as text), ``contaminated``.

    ``docs`` has the row key. ``n_hit`` counts words inside any run; a document is contaminated if
    they are at least a twentieth of its words.
    """
    runs = keep(item_windows(benchmark), "runs")
    scanned = keep(scan(docs, run_shingles(runs), [*KEY, *extra]), "scanned")
    hits = keep(contained_runs(scanned, runs), "hits")
    order = Window.partitionBy(*KEY).orderBy("start", "len")
    before = F.max(F.col("start") + F.col("len")).over(
        order.rowsBetween(Window.unboundedPreceding, -1)
    )
    fresh = F.col("start") + F.col("len") - F.greatest("start", F.coalesce(before, F.lit(0)))
    covered = (
        hits.select(*KEY, "start", "len")
        .distinct()
        .withColumn("fresh", F.greatest(fresh, F.lit(0)))
        .groupBy(*KEY)
        .agg(F.sum("fresh").alias("n_hit"))
    )
    items = (
        hits.join(runs.select("item_id", "run"), "run")
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    verdict = covered.join(items, KEY)
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (
        scanned.select(*KEY, *extra, "n_words")
        .join(verdict, KEY, "left")
        .select(
            *KEY, *extra, "n_words", n_hit.cast("bigint").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
        )
    )
