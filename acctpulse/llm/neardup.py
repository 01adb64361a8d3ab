"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of shingles of five words: (1 + ln tf) * idf. Weighted samples of it
(Ioffe's scheme) agree between two documents with the probability of their weighted Jaccard
similarity. ``BANDS`` bands of ``ROWS`` samples give buckets; inside a bucket the exact weighted
Jaccard similarity decides, and linked documents form classes (connected components). With
12 bands of 3 a pair of similarity 0.8 shares no bucket once in 3,000 times.

idf is ln(1 + N / df); N and df count distinct texts, so copies don't lower the weight of what they
hold. df is exact for every shingle. Near copies do raise it for what they share: by these weights alone
sixty edits of one text are like nothing. So a pair is also linked if it is similar by
weights that are level below a share of ``RARE`` of all documents; each of the two weights has its own
bands, and neither loses a link of the other.

Shingles in a share of ``RARE`` or more are counted by two passes over the texts and broadcast: the first
notes what is frequent in any block of documents (what it can't have missed by the pigeonhole
principle), the second counts those exactly over all documents. There are at most 1.4 / RARE
times as many as a document has shingles on average. All others are dealt by shingle and counted there,
and none of them fills a task. Counts of two or more go back to their texts. A text of which
what several texts hold weighs less than the similarity asked for is like no other, and has no bands.

Equal texts are one document for all of this: one row of each is written, counted, signed and
compared; copies are never paired. A bucket is compared in blocks of
bounded rows and bytes. Blocks are dealt anew in each band, so they grow together. The documents of a
bucket of several blocks that still holds several classes are joined on prefixes instead: shingles are put in the order
of their rarity among these documents, and two documents that are similar enough share one of the first shingles that make up
a fifth of their weight. What many of them share, a passage or a form, comes last and joins nothing, so work follows the
documents and not their pairs. Only documents that share a rare shingle and are not in one class yet are compared.

Defined cases: a null text is like nothing; texts without words are like equal texts only; a text
of fewer than five words is one shingle; texts may be of any length; an empty table gives no rows; ``extra`` may have any
names. Repeated rows are copies. Of a class the row with the
smallest doc_id stays (null last; then by place in the table).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctpulse.llm import arrays
from acctpulse.llm.components import components
from acctpulse.llm.tables import FILE, KEY, ROW, keep

SHINGLE = 5
BANDS, ROWS = 12, 3
SIMILARITY = 0.8
RARE = 0.05
BLOCK_ROWS = 2000
BLOCK_BYTES = 8 << 20
SAME = ["bytes", "crc", "hash"]
SLICES = 2  # shingles are counted one half after the other, which halves the disk of their shuffle
CELLS = 1 << 20  # counters of a shingle's documents; shared ones only make the order of rarity coarser


@dataclass
class Idf:
    """``docs`` documents; ``df`` of the ``shingles`` (sorted) in a share of ``rare`` or more."""

    docs: int = 0
    shingles: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    df: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rare: float = RARE

    def count(self, shingles: np.ndarray) -> np.ndarray:
        """Documents of each; 0 if not listed."""
        n = np.zeros(len(shingles), np.int64)
        if len(self.shingles):
            place = np.searchsorted(self.shingles, shingles)
            place[place == len(self.shingles)] = 0
            hit = np.flatnonzero(self.shingles[place] == shingles)
            n[hit] = self.df[place[hit]]
        return n

    def of(self, shingles: np.ndarray) -> np.ndarray:
        """Weights that are level below ``rare``."""
        n = self.count(shingles)
        return np.where(n > 0, np.log1p(self.docs / np.maximum(n, 1)), np.log1p(1 / self.rare))


def both_weights(df: np.ndarray, docs: int) -> np.ndarray:
    """Two rows: idf by the exact counts, and level below a share of ``RARE``."""
    return np.log1p(docs / np.stack([df, np.maximum(df, RARE * docs)]))


def counted_shingles(words: arrays.Words, n_docs: int, k: int = SHINGLE):
    """Distinct shingles per text, ordered by text and hash: hash, text, occurrences."""
    h, doc, _ = words.shingles(k)
    n = np.diff(words.first)
    for few in range(1, k):
        if (n == few).any():
            h1, doc1, _ = words.shingles(few)
            short = n[doc1] == few
            h, doc = np.concatenate([h, h1[short]]), np.concatenate([doc, doc1[short]])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return h[at], doc[at], np.diff(np.append(at, len(h)))


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def fit_idf(docs: DataFrame, rare: float = RARE) -> Idf:
    """Exact document counts of all shingles in a share of ``rare`` of the documents or more.

    Each row of ``docs`` is a document; see ``one_of_each`` for copies.
    """
    spark, part = docs.sparkSession, rare / 4

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, n_docs = [], 0
            for piece in arrays.blocks(batch, "text"):
                words = arrays.Words(*arrays.utf8(piece.column("text")))
                seen.append(counted_shingles(words, piece.num_rows)[0])
                n_docs += piece.num_rows
            h, n = np.unique(np.concatenate(seen or [np.zeros(0, np.uint64)]), return_counts=True)
            often = n >= part * n_docs
            yield pa.RecordBatch.from_pydict(
                {"shingle": _signed(np.append(h[often], np.uint64(0))),
                 "n": np.append(n[often], 0), "docs": np.append(np.zeros(often.sum(), int), n_docs)}
            )

    texts = docs.select("text")
    noted = keep(
        texts.mapInArrow(frequent, "shingle bigint, n bigint, docs bigint")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "frequent",
    )
    total = noted.agg(F.sum("docs")).first()[0] or 0
    # A block that didn't note a shingle has it in less than `part` of its documents.
    likely = noted.where(F.col("n") >= (rare - part) * total).where(F.col("n") > 0)
    wanted = np.sort(np.array([r[0] for r in likely.select("shingle").collect()], np.int64)
                     .view(np.uint64))
    if total == 0 or len(wanted) == 0:
        return Idf(total, rare=rare)
    shared = spark.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        n = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for piece in arrays.blocks(batch, "text"):
                words = arrays.Words(*arrays.utf8(piece.column("text")))
                h = counted_shingles(words, piece.num_rows)[0]
                place = np.searchsorted(wanted, h)
                place[place == len(wanted)] = 0
                n += np.bincount(place[wanted[place] == h], minlength=len(wanted))
        yield pa.RecordBatch.from_pydict({"shingle": _signed(wanted), "n": n})

    counts = texts.mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle")
    counts = keep(counts.agg(F.sum("n").alias("n")), "counts")
    counted = counts.where(F.col("n") >= rare * total).collect()
    h = np.array([r["shingle"] for r in counted], np.int64).view(np.uint64)
    order = np.argsort(h)
    return Idf(total, h[order], np.array([r["n"] for r in counted], float)[order], rare)


def shared_counts(texts: DataFrame, often: Idf) -> DataFrame:
    """``cid`` and ``counts``: documents of each of its shingles that several hold, but for those in ``often``.

    Each row of ``texts`` (cid, text) is a document.
    """
    shared = texts.sparkSession.sparkContext.broadcast(vars(often))  # bounded, see fit_idf

    def counted(part: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            often = Idf(**shared.value)
            for batch in batches:
                for piece in arrays.blocks(batch, "text"):
                    words = arrays.Words(*arrays.utf8(piece.column("text")))
                    h, doc, _ = counted_shingles(words, piece.num_rows)
                    use = h % np.uint64(SLICES) == part
                    h, doc = h[use], doc[use]
                    rest = often.count(h) == 0
                    yield pa.RecordBatch.from_pydict(
                        {"cid": piece.column("cid").take(pa.array(doc[rest])), "shingle": _signed(h[rest])})

        each = texts.select("cid", "text").mapInArrow(run, "cid bigint, shingle bigint")
        n = F.count("*").over(Window.partitionBy("shingle"))
        return keep(each.withColumn("n", n).where(F.col("n") > 1), "shared-shingles")

    held = counted(0)
    for part in range(1, SLICES):
        held = held.unionByName(counted(part))
    return held.groupBy("cid").agg(F.collect_list(F.struct("shingle", "n")).alias("counts"))


def _document_counts(h: np.ndarray, doc: np.ndarray, counts: pa.Array, often: Idf) -> np.ndarray:
    """Documents of each shingle ``h`` of text ``doc``, ordered by both; ``counts`` as of ``shared_counts``."""
    df = np.maximum(often.count(h), 1)
    lengths = counts.value_lengths().fill_null(0).to_numpy()
    flat = counts.flatten()
    if len(flat):
        shingles = np.concatenate([h, flat.field("shingle").to_numpy().view(np.uint64)])
        owner = np.concatenate([doc, np.repeat(np.arange(len(counts)), lengths)])
        order = np.lexsort((shingles, owner))  # stable: a count follows its shingle
        at = np.flatnonzero(order >= len(h))
        df[order[at - 1]] = flat.field("n").to_numpy()[order[at] - len(h)]
    return df


class Sampler:
    """Weighted samples; the random numbers of a shingle come from tables of 2 ** 16 draws."""

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.rate = draw.gamma(2, 1, 1 << 16).astype(np.float32)
        self.cost = np.log(draw.gamma(2, 1, 1 << 16)).astype(np.float32)
        self.shift = draw.random(1 << 16).astype(np.float32)
        self.odd = draw.integers(1, 1 << 63, samples, np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(self, h: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """32-bit samples, one row per text; ``first`` has each text's first shingle.

        ``weight`` may have several rows; each gives samples of its own.
        """
        logs = np.log(np.atleast_2d(weight)).astype(np.float32)
        low, out = np.uint64(0xFFFF), np.zeros((len(logs), len(first), len(self.odd)), np.uint64)
        for i, odd in enumerate(self.odd):
            x = h * odd
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            rate = self.rate[(x >> np.uint64(48)).astype(np.int64)]
            cost = self.cost[((x >> np.uint64(32)) & low).astype(np.int64)]
            shift = self.shift[((x >> np.uint64(16)) & low).astype(np.int64)]
            for log, samples in zip(logs, out, strict=True):
                level = np.floor(log / rate + shift)
                value = (cost - rate * (level - shift + np.float32(1))).view(np.int32)
                sortable = (value ^ ((value >> 31) | np.int32(-(2**31)))).view(np.uint32)
                name = (x ^ (level.astype(np.int64).view(np.uint64) * arrays.BASE)) * arrays.BASE
                both = (sortable.astype(np.uint64) << np.uint64(32)) | (name >> np.uint64(32))
                samples[:, i] = np.minimum.reduceat(both, first) & np.uint64(0xFFFFFFFF)
        return out if np.ndim(weight) == 2 else out[0]


def name_texts(docs: DataFrame, extra: list[str]) -> DataFrame:
    """Row key, ``extra``, and ``bytes``, ``crc``, ``hash`` of the text, which equal texts share."""
    text = F.col("text")
    return docs.select(
        *KEY, *extra,
        F.octet_length(text).cast("bigint").alias("bytes"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.when(text.isNotNull(), F.xxhash64(text)).alias("hash"),
    )


def one_of_each(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The first row of each text: row key, ``bytes``, ``crc``, ``hash``, ``text``, ``cid``; none of null texts.

    ``named`` has the row keys and text names of ``docs``. Only rows that have an earlier copy are looked
    up, so texts are shuffled only where these are many.
    """
    place = F.struct(FILE, ROW)
    repeated = keep(
        named.where(F.col("hash").isNotNull())
        .groupBy(*SAME)
        .agg(F.min(place).alias("at"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .drop("n"),
        "repeated",
    )
    again = keep(named.join(repeated, SAME).where(place != F.col("at")).select(*KEY), "copies")
    texts = docs.where(F.col("text").isNotNull()).join(again, KEY, "left_anti")
    once = name_texts(texts.select(*KEY, "text"), ["text"])
    return keep(once.withColumn("cid", F.monotonically_increasing_id()), "distinct-texts")


def sign(texts: DataFrame, idf: Idf, similarity: float, bands: int = BANDS, rows: int = ROWS):
    """Row key, ``bytes``, ``crc``, ``hash``, ``cid`` of each text, ``df`` and ``bands``: a hash each.

    ``df`` has the documents of each of its shingles, ordered by hash. There are ``bands`` for either weight; they are
    null for a text without words and for one that holds too little of other texts to be like any.
    """
    shared = texts.sparkSession.sparkContext.broadcast(vars(idf))  # bounded, see fit_idf
    names = [*KEY, *SAME, "cid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, idf = Sampler(bands * rows), Idf(**shared.value)
        for batch in batches:
            for piece in arrays.blocks(batch, "text", 1 << 19):
                words = arrays.Words(*arrays.utf8(piece.column("text")))
                h, doc, tf = counted_shingles(words, piece.num_rows)
                df = _document_counts(h, doc, piece.column("counts"), idf)
                weight = (1 + np.log(tf)) * both_weights(df, idf.docs)
                alike = np.zeros(piece.num_rows, bool)
                for w in weight:
                    total = np.bincount(doc, w, piece.num_rows)
                    common = np.bincount(doc, w * (df > 1), piece.num_rows)
                    alike |= (total > 0) & (common >= (similarity - 1e-6) * total)
                lists: list = [None] * piece.num_rows
                if alike.any():
                    use = alike[doc]
                    have, first = np.unique(doc[use], return_index=True)
                    samples = sampler.sign(h[use], weight[:, use], first)
                    samples = samples.reshape(2, len(have), bands, rows).transpose(1, 0, 2, 3)
                    samples = samples.reshape(len(have), 2 * bands, rows)
                    band = np.zeros((len(have), 2 * bands), np.uint64)
                    for j in range(rows):
                        band = arrays.mix(band * arrays.BASE + samples[:, :, j] + np.uint64(1))
                    for d, hashes in zip(have.tolist(), band.view(np.int64).tolist(), strict=True):
                        lists[d] = hashes
                cuts = np.searchsorted(doc, np.arange(piece.num_rows + 1))
                dfs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(df).cast(pa.int32()))
                cols = [piece.column(c) for c in names] + [dfs, pa.array(lists, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, [*names, "df", "bands"])

    kinds = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in names)
    counted = texts.join(shared_counts(texts, idf), "cid", "left")
    return counted.select(*names, "text", "counts").mapInArrow(run, f"{kinds}, df array<int>, bands array<bigint>")


class Bucket:
    """Exact similarities in one block (or between two) and the links that keep it connected."""

    def __init__(self, ids, sides, feature, weight, first):
        self.ids, self.sides = ids, sides
        self.feature, self.weight, self.first = feature, weight, first

    def links(self, similarity: float) -> list[tuple[int, int]]:
        n = len(self.ids)
        lengths = np.diff(self.first)
        padded = np.pad(self.weight, ((0, 0), (0, 1)))
        total = np.add.reduceat(padded, self.first[:-1], axis=1) * (lengths > 0)
        owner = np.repeat(np.arange(n), lengths)
        order = np.argsort(self.feature, kind="stable")
        feature, holder = self.feature[order], owner[order]
        new = np.r_[True, feature[1:] != feature[:-1]]
        run = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(feature)))
        place = np.empty(len(order), np.int64)
        place[order] = run
        parent = list(range(n))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for u in range(n - 1):
            mine = slice(self.first[u], self.first[u + 1])
            runs = place[mine]
            more = size[runs] > 1
            runs, weight = runs[more], self.weight[:, mine][:, more]
            if not len(runs):
                continue
            sizes = size[runs]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(begin[runs] - (ends - sizes), sizes)
            alike = np.zeros(n, bool)
            for w, all_ in zip(weight, total, strict=True):
                common = np.bincount(holder[at], np.repeat(w, sizes), n)
                alike |= common >= (similarity - 1e-9) * (all_[u] + all_ - common)
            if self.sides is not None:
                alike &= self.sides != self.sides[u]
            for v in np.flatnonzero(alike[u + 1 :]) + u + 1:
                a, b = top(u), top(int(v))
                if a != b:
                    parent[b] = a
                    out.append((self.ids[u], self.ids[int(v)]))
        return out


def _features(texts: pa.Array, df: pa.Array, docs: int):
    """Each text as a set of features, by either weight, whose overlap is the overlap of weighted shingles.

    A shingle that occurs tf times is tf features, the j-th with what the j-th occurrence adds. ``df`` as of ``sign``.
    """
    words = arrays.Words(*arrays.utf8(texts))
    h, doc, tf = counted_shingles(words, len(texts))
    level = np.arange(tf.sum()) - np.repeat(np.cumsum(tf) - tf, tf) + 1
    gain = np.where(level > 1, np.log(level) - np.log(np.maximum(level - 1, 1)), 1.0)
    feature = arrays.mix(np.repeat(h, tf) + level.astype(np.uint64) * arrays.BASE)
    owner = np.repeat(doc, tf)
    weight = both_weights(df.flatten().to_numpy(), docs)
    return feature, gain * np.repeat(weight, tf, axis=1), np.searchsorted(owner, np.arange(len(texts) + 1))


def compare(members: DataFrame, docs: int, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` inside each ``bucket`` of ``members`` (cid, text, df, side).

    Rows of a bucket follow each other in one task, and only one bucket is held at a time. If
    ``side`` is not null, only pairs of different sides count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None

        def done():
            rows = pa.Table.from_batches(held).combine_chunks()
            side = rows["side"].to_numpy()
            feature, weight, first = _features(rows["text"].combine_chunks(), rows["df"].combine_chunks(), docs)
            bucket = Bucket(rows["cid"].to_pylist(), None if np.isnan(
                side.astype(float)).any() else side, feature, weight, first)
            found = bucket.links(similarity)
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([x for x, _ in found], pa.int64()),
                 "b": pa.array([x for _, x in found], pa.int64())}
            )

        for batch in batches:
            names = batch.column("bucket").to_numpy()
            cuts = np.flatnonzero(np.diff(names)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(names)], strict=True):
                if s == e:
                    continue
                if held and names[s] != name:
                    yield done()
                    held = []
                name = names[s]
                held.append(batch.slice(s, e - s))
        if held:
            yield done()

    dealt = members.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.select("bucket", "cid", "text", "df", "side").mapInArrow(run, "a bigint, b bigint")


def rare_prefixes(texts: DataFrame, docs: int, similarity: float) -> DataFrame:
    """``cid`` and ``h``: of each text the first features, by rarity, that every similar text shares one of.

    ``texts`` (cid, text, df) is a written table. Features that two texts share weigh ``similarity`` of the heavier at least, so
    those before the first shared one weigh less than the rest of it.
    """
    spark = texts.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CELLS, np.int64)
        for batch in batches:
            for piece in arrays.blocks(batch, "text"):
                h, _, _ = _features(piece.column("text"), piece.column("df"), docs)
                seen += np.bincount((h % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"cell": at, "n": seen[at]})

    told = texts.select("text", "df").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    told = told.toArrow()  # CELLS rows at most
    seen = np.zeros(CELLS, np.int64)
    seen[told["cell"].to_numpy()] = told["n"].to_numpy()
    often = spark.sparkContext.broadcast(seen)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.blocks(batch, "text"):
                h, weight, begin = _features(piece.column("text"), piece.column("df"), docs)
                owner = np.repeat(np.arange(piece.num_rows), np.diff(begin))
                order = np.lexsort((h, often.value[(h % np.uint64(CELLS)).astype(np.int64)], owner))
                h, kept = h[order], np.zeros(len(h), bool)
                for w in weight:
                    upto = np.concatenate([[0.0], np.cumsum(w[order])])
                    total = upto[begin[1:]] - upto[begin[:-1]]
                    before = upto[:-1] - upto[begin[:-1]][owner]
                    kept |= before <= ((1 - similarity) * total + 1e-6)[owner]
                yield pa.RecordBatch.from_pydict(
                    {"cid": piece.column("cid").take(pa.array(owner[kept])), "h": _signed(h[kept])})

    return texts.select("cid", "text", "df").mapInArrow(first, "cid bigint, h bigint")


def links_by_prefix(
    texts: DataFrame, labels: DataFrame, docs: int, similarity: float, block_rows: int, block_bytes: int
) -> DataFrame:
    """Links between ``texts`` (cid, text, df) of different ``label`` (cid, bytes, label)."""
    found = keep(rare_prefixes(texts, docs, similarity).join(labels, "cid"), "prefixes")
    groups = (
        found.groupBy("h")
        .agg(
            F.count("*").alias("n"), F.sum("bytes").alias("size"), F.min("cid").alias("low"),
            F.max("cid").alias("high"), F.bit_xor(F.xxhash64("cid")).alias("all"),
            F.min("label").alias("x"), F.max("label").alias("y"),
        )
        .where((F.col("n") > 1) & (F.col("x") != F.col("y")))
        .groupBy("n", "size", "low", "high", "all")
        .agg(F.min("h").alias("h"))
        .select("h", F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("size") / block_bytes))
                .cast("bigint").alias("blocks"))
    )
    members = keep(
        found.join(groups, "h").select(
            "cid", "h", "blocks", F.pmod(F.xxhash64("cid", "h"), F.col("blocks")).alias("block")),
        "prefix-members",
    )
    inside = members.select("cid", F.xxhash64("h", "block").alias("bucket"), F.lit(None).cast("bigint").alias("side"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    across = members.where(F.col("blocks") > 1).select("*", other).where(F.col("block") != F.col("other"))
    across = across.select(
        "cid", F.xxhash64("h", F.least("block", "other"), F.greatest("block", "other")).alias("bucket"),
        F.col("block").alias("side"),
    )
    return compare(inside.unionByName(across).join(texts, "cid"), docs, similarity)


def near_duplicates(
    docs: DataFrame,
    extra: list[str],
    similarity: float = SIMILARITY,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: row key, ``doc_id``, ``extra``, ``class_id``, ``kept``, ``class_rows``.

    ``docs`` has the row key, ``doc_id`` and ``text``. ``class_id`` is the smallest doc_id of the
    class; ``kept`` marks the one row of it that stays.
    """
    named = keep(name_texts(docs, ["doc_id", *extra]), "named")
    once = one_of_each(docs, named)
    idf = fit_idf(once)
    classes = keep(sign(once, idf, similarity), "signed")
    spread = classes.where(F.col("bands").isNotNull()).select(
        "cid", "bytes", F.posexplode("bands").alias("band", "value")
    )
    buckets = (
        spread.groupBy("band", "value")
        .agg(
            F.count("*").alias("n"), F.sum("bytes").alias("size"), F.min("cid").alias("low"),
            F.max("cid").alias("high"), F.bit_xor(F.xxhash64("cid")).alias("all"),
        )
        .where(F.col("n") > 1)
        # The same documents meet in many bands; they are compared in one of them.
        .groupBy("n", "size", "low", "high", "all")
        .agg(F.min(F.struct("band", "value")).alias("first"))
        .select(
            "n", "first.band", "first.value",
            F.greatest(
                F.ceil(F.col("n") / block_rows), F.ceil(F.col("size") / block_bytes)
            ).cast("bigint").alias("blocks"),
        )
    )
    members = keep(
        spread.join(buckets, ["band", "value"]).select(
            "cid", "band", "value", "blocks",
            F.pmod(F.xxhash64("cid", "band"), F.col("blocks")).alias("block"),
        ),
        "members",
    )
    involved = members.select("cid").distinct().join(classes.select("cid", "df"), "cid")
    texts = keep(once.select("cid", "text").join(involved, "cid"), "texts")
    name = F.xxhash64("band", "value", "block")
    inside = members.select("cid", name.alias("bucket"), F.lit(None).cast("bigint").alias("side"))
    links = keep(compare(inside.join(texts, "cid"), idf.docs, similarity), "links")
    roots = components(links)
    wide = members.where(F.col("blocks") > 1)
    if not wide.isEmpty():
        known = wide.join(roots, F.col("cid") == F.col("node"), "left").withColumn(
            "label", F.coalesce("root", "cid")
        )
        unsettled = known.groupBy("band", "value").agg(
            F.min("label").alias("x"), F.max("label").alias("y")
        ).where(F.col("x") != F.col("y")).select("band", "value")
        open_ids = keep(wide.join(unsettled, ["band", "value"]).select("cid").distinct(), "unsettled")
        if not open_ids.isEmpty():
            known = classes.select("cid", "bytes").join(open_ids, "cid", "left_semi")
            known = known.join(roots, F.col("cid") == F.col("node"), "left").select(
                "cid", "bytes", F.coalesce("root", "cid").alias("label"))
            open_texts = keep(texts.join(open_ids, "cid", "left_semi"), "unsettled-texts")
            more = links_by_prefix(open_texts, known, idf.docs, similarity, block_rows, block_bytes)
            roots = components(keep(links.unionByName(more), "all-links"))
    labels = classes.join(roots, F.col("cid") == F.col("node"), "left").select(
        *SAME, F.coalesce("root", "cid").alias("label")
    )
    labelled = keep(
        named.join(labels, SAME, "left"), "labelled"
    )  # a null text has no label
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(FILE), F.col(ROW))
    # Written, so that the join below has an exchange on either side and large classes are split.
    chosen = keep(
        labelled.where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.min(order).alias("best"), F.count("*").alias("class_rows")),
        "chosen",
    )
    alone = F.col("label").isNull()
    best = F.col("best")
    kept = alone | ((best[FILE] == F.col(FILE)) & (best[ROW] == F.col(ROW)))
    return labelled.join(chosen, "label", "left").select(
        *KEY, "doc_id", *extra,
        F.when(alone, F.col("doc_id")).otherwise(best["doc_id"]).alias("class_id"),
        kept.alias("kept"),
        F.coalesce("class_rows", F.lit(1)).cast("bigint").alias("class_rows"),
    )
