"""Near-duplicate vectors by product quantisation.

Coarse centroids give inverted lists; a vector is stored in the list of its nearest centroid with its
residual as one code per subspace. Each vector searches the lists near it: a table of
distances from its residual to all codes gives asymmetric distances by look-up, a candidate is kept
if that distance, less the candidate's own quantisation error, could still be near enough (so the
codes lose no pair), and candidates are decided by the exact cosine in double precision.

There is a list for every ``LIST_ROWS`` vectors. Up to ``MAX_LISTS`` each has a centroid of its own; beyond that each
coarse cell is divided by second centroids, which all cells share, so a codebook is bounded and lists stay short.
A vector searches the ``probes`` lists nearest to it, about ``3 * lists ** 0.25``, so work per vector hardly grows. A pair is
found if either vector searches the list of the other, and then counts for both. ``probes=0`` searches every list
within reach instead: cells that hold a vector within the angle of ``similarity`` lie within twice
that angle of the nearest centroid; ``margin`` is how much of that is searched, and 1 finds every pair.

Vectors are compared with those of their own length; each length has its codebook and its lists.
Equal vectors are one entry with a count, so copies never meet. Lists and the queries to them
are cut into blocks of bounded size; a task holds two blocks and emits only counts and as
many links as keep their vectors connected, not all pairs.

Defined cases: vectors that are null or zero or hold null or non-finite components link with nothing.
Repeated rows are copies and link with each other. Null ids come after all others when the smallest is sought.
Vectors may be of any length; extra columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctpulse.llm.components import components
from acctpulse.llm.tables import KEY, keep

SIMILARITY = 0.9
BLOCK = 512
SAMPLE = 16_384
MARGIN = 1.0
LIST_ROWS = 64
MAX_LISTS, MAX_SECOND = 4096, 256
BROADCAST_LISTS = 100_000
PAIRS = 1 << 15  # candidates whose vectors are held at a time


@dataclass
class Codebook:
    """``centroids`` of the cells (unit length), ``second`` to be added to one for a list's centre, ``codes``:
    subspace, code, component; how many lists a query searches, or 0 for all in reach."""

    centroids: np.ndarray
    second: np.ndarray
    codes: np.ndarray
    margin: float
    probes: int

    def centre(self, at: int) -> np.ndarray:
        cell, part = divmod(at, len(self.second))
        return self.centroids[cell] + self.second[part]

    def lists(self, x: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
        """Row and list of each probe."""
        alike = np.clip(x @ self.centroids.T, -1, 1)
        parts = len(self.second)
        if not self.probes:
            angle = np.arccos(alike)
            reach = 2 * self.margin * math.acos(similarity) + 1e-6
            row, cell = np.nonzero(angle <= angle.min(1, keepdims=True) + reach)
            return np.repeat(row, parts), (cell[:, None] * parts + np.arange(parts)).ravel()
        most = min(self.probes, alike.shape[1])
        cell = np.argpartition(-alike, most - 1, axis=1)[:, :most]
        if parts == 1:
            return np.repeat(np.arange(len(x)), most), cell.ravel()
        # Squared distance to a centre c + s, without |x|^2: |c|^2 - 2 x c + |s|^2 - 2 (x - c) s.
        c = np.take_along_axis(alike, cell, axis=1)
        away = (1 - 2 * c)[:, :, None] + (self.second**2).sum(1)[None, None, :]
        away = away - 2 * ((x @ self.second.T)[:, None, :] - (self.centroids @ self.second.T)[cell])
        flat = away.reshape(len(x), -1)
        pick = np.argpartition(flat, self.probes - 1, axis=1)[:, : self.probes]
        own = np.take_along_axis(cell, pick // parts, axis=1) * parts + pick % parts
        return np.repeat(np.arange(len(x)), own.shape[1]), own.ravel()

    def nearest(self, x: np.ndarray) -> np.ndarray:
        cell = (x @ self.centroids.T).argmax(1)
        if len(self.second) == 1:
            return cell
        return cell * len(self.second) + _distances(x - self.centroids[cell], self.second).argmin(1)

    def centres(self, at: np.ndarray) -> np.ndarray:
        return self.centroids[at // len(self.second)] + self.second[at % len(self.second)]

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes per subspace, and how far the coded residual is from the true one."""
        parts = np.array_split(residual, len(self.codes), axis=1)
        out = np.empty((len(residual), len(self.codes)), np.uint8)
        error = np.zeros(len(residual))
        for j, part in enumerate(parts):
            book = self.codes[j][:, : part.shape[1]]
            far = _distances(part, book)
            out[:, j] = far.argmin(1)
            error += np.maximum(far.min(1), 0)
        return out, np.sqrt(error)

    def tables(self, residual: np.ndarray) -> np.ndarray:
        """Squared distances from each residual's parts to all codes: row, subspace, code."""
        parts = np.array_split(residual, len(self.codes), axis=1)
        return np.stack(
            [_distances(p, self.codes[j][:, : p.shape[1]]) for j, p in enumerate(parts)], 1
        )


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :]


def _means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm from distinct random rows; an empty cell keeps its place."""
    draw = np.random.default_rng(seed)
    centres = x[np.sort(draw.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        near = _distances(x, centres).argmin(1)
        order = np.argsort(near, kind="stable")
        have, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        centres[have] = sums / np.diff(np.append(first, len(x)))[:, None]
    return centres


def fit_codebook(
    sample: np.ndarray, n: int, subspaces: int = 16, codes: int = 256, rounds: int = 6,
    margin: float = MARGIN, seed: int = 5, probes: int | None = None,
) -> Codebook:
    """Learns from unit vectors of a bounded sample; the number of lists follows ``n``, the size."""
    wanted = max(1, -(-n // LIST_ROWS))
    centroids = _means(sample, min(MAX_LISTS, wanted, len(sample)), rounds, seed)
    length = np.linalg.norm(centroids, axis=1, keepdims=True)
    centroids = np.where(length > 0, centroids / np.maximum(length, 1e-300), sample[:1])
    residual = sample - centroids[(sample @ centroids.T).argmax(1)]
    parts = min(MAX_SECOND, -(-wanted // len(centroids)), len(sample))
    second = np.zeros((1, sample.shape[1])) if parts == 1 else _means(residual, parts, rounds, seed)
    lists = len(centroids) * len(second)
    if probes is None:
        probes = min(lists, math.ceil(3 * lists**0.25))
    book = Codebook(centroids, second, np.zeros((0, 0, 0)), margin, probes)
    residual = sample - book.centres(book.nearest(sample))
    parts = np.array_split(residual, min(subspaces, sample.shape[1]), axis=1)
    width = max(p.shape[1] for p in parts)
    books = [_means(p, codes, rounds, seed + 1 + j) for j, p in enumerate(parts)]
    books = [np.pad(b, ((0, 0), (0, width - b.shape[1]))) for b in books]
    book.codes = np.stack(books)
    return book


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _search(similarity: float, books: dict[int, dict]):
    """Counts and links of the entries of one block among those of another."""
    far = math.sqrt(2 - 2 * similarity)

    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(entries):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        book = Codebook(**books[int(entries["width"].iloc[0])])
        q, x = np.stack(queries["v"].to_numpy()), np.stack(entries["v"].to_numpy())
        codes = np.stack(entries["code"].to_numpy()).astype(np.int64)
        error, n = entries["error"].to_numpy(), entries["n"].to_numpy()
        centre = book.centre(int(entries["list"].iloc[0]))
        qid, xid = queries["cid"].to_numpy(), entries["cid"].to_numpy()
        home, many = queries["home"].to_numpy(), queries["n"].to_numpy()
        lists = len(book.centroids) * len(book.second)
        asked = entries["probes"].to_numpy()  # the lists that entries search
        asks = np.repeat(np.arange(len(x)), [len(a) for a in asked]) * lists + np.concatenate(asked)
        back = np.zeros(len(x), np.int64)
        tables = book.tables(q - centre)
        links_a, links_b, counts = [], [], np.zeros(len(q), np.int64)
        parent = {}

        def top(v):
            while parent.setdefault(v, v) != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        distance = np.zeros((len(q), len(x)))
        for j in range(codes.shape[1]):
            distance += tables[:, j][:, codes[:, j]]
        near = (distance <= (far + error + 1e-6) ** 2) & (qid[:, None] != xid[None, :])
        row, col = np.nonzero(near)
        for s in range(0, len(row), PAIRS):
            i, k = row[s : s + PAIRS], col[s : s + PAIRS]
            alike = np.einsum("ij,ij->i", q[i], x[k]) >= similarity
            i, k = i[alike], k[alike]
            counts += np.bincount(i, n[k], len(q)).astype(np.int64)
            unasked = ~np.isin(k * lists + home[i], asks)  # the other side won't find this pair
            back += np.bincount(k[unasked], many[i[unasked]], len(x)).astype(np.int64)
            for one, other in zip(qid[i].tolist(), xid[k].tolist(), strict=True):
                a, b = top(one), top(other)
                if a != b:
                    parent[b] = a
                    links_a.append(one)
                    links_b.append(other)
        hit, owed = counts > 0, back > 0
        own = np.concatenate([qid[hit], xid[owed]])
        return pd.DataFrame({
            "a": np.concatenate([own, np.array(links_a, np.int64)]),
            "b": np.concatenate([own, np.array(links_b, np.int64)]),
            "n": np.concatenate([counts[hit], back[owed], np.zeros(len(links_a), np.int64)]),
        })

    return run


def _books(entries: DataFrame, sample_rows: int, margin: float, probes: int | None) -> dict[int, dict]:
    """A codebook for each length, all fitted on about ``sample_rows`` entries, 256 of each length at least."""
    counts = {r["width"]: r["count"] for r in entries.groupBy("width").count().collect()}
    if not counts:
        return {}
    most = max(256, sample_rows // len(counts))
    share = F.create_map(*[F.lit(x) for w, n in counts.items() for x in (w, int(min(1.0, most / n) * (1 << 30)))])
    chosen = F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < share[F.col("width")]
    picked = entries.where(chosen).orderBy("width", "h", "cid").select("width", "v").toArrow()
    widths = picked["width"].to_numpy()
    books = {}
    for width, n in counts.items():
        own = picked["v"].take(pa.array(np.flatnonzero(widths == width))).combine_chunks()
        if not len(own):  # a few entries may all be passed over by the hash
            own = entries.where(F.col("width") == width).orderBy("h").limit(1).toArrow()["v"].combine_chunks()
        books[width] = vars(fit_codebook(_unit(_matrix(own, width)), n, margin=margin, probes=probes))
    return books


def linked_vectors(
    vectors: DataFrame, similarity: float = SIMILARITY, margin: float = MARGIN,
    sample_rows: int = SAMPLE, block: int = BLOCK, probes: int | None = None,
) -> DataFrame:
    """Per row: row key, ``vec_id``, ``n_links``, ``component_id`` (smallest vec_id), ``kept``.

    ``vectors`` has the row key, ``vec_id`` and ``embedding``. Codebooks are fitted on at most
    about ``sample_rows`` distinct vectors, chosen by hash; all rows are indexed and searched.
    ``probes`` is the number of lists that a vector searches; 0 for all within ``margin`` of its reach.
    """
    spark = vectors.sparkSession
    wide = vectors.select(*KEY, "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    good = usable(F.col("v"))
    # Equal vectors, -0.0 and 0.0 alike, are one entry.
    v = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = keep(wide.select(*KEY, "vec_id", F.when(good, F.xxhash64(v)).alias("h"),
                            F.when(good, v).alias("v")), "vectors")
    entries = keep(
        rows.where(F.col("v").isNotNull()).groupBy("h", "v")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
        .withColumns({"cid": F.monotonically_increasing_id(), "width": F.size("v")}),
        "entries",
    )
    books = _books(entries, sample_rows, margin, probes)
    if books:
        shared = spark.sparkContext.broadcast(books)  # lists and codes are bounded for each length

        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                widths = batch.column("width").to_numpy()
                for width in np.unique(widths).tolist():
                    book = Codebook(**shared.value[width])
                    every = np.flatnonzero(widths == width)
                    for s in range(0, len(every), block):
                        part = batch.take(pa.array(every[s : s + block]))
                        x = _unit(_matrix(part.column("v"), width))
                        at = book.nearest(x)
                        code, error = book.encode(x - book.centres(at))
                        row, to = book.lists(x, similarity)
                        order = np.argsort(row, kind="stable")
                        probes = np.split(to[order], np.cumsum(np.bincount(row, minlength=len(x)))[:-1])
                        yield pa.RecordBatch.from_pydict({
                            "cid": part.column("cid"), "n": part.column("n"), "width": part.column("width"),
                            "v": pa.array(list(x)), "list": at.astype(np.int64),
                            "code": pa.array(list(code.astype(np.int16))), "error": error,
                            "probes": pa.array([p.astype(np.int64) for p in probes]),
                        })

        indexed = keep(
            entries.select("cid", "n", "width", "v").mapInArrow(
                index, "cid bigint, n bigint, width int, v array<double>, list bigint, "
                       "code array<smallint>, error double, probes array<bigint>"),
            "index",
        )
        place = ["width", "list"]
        blocks = keep(
            indexed.groupBy(*place).agg(F.ceil(F.count("*") / block).cast("bigint").alias("blocks")), "blocks"
        )
        asked = indexed.select(
            "cid", "v", "n", "width", F.col("list").alias("home"), F.explode("probes").alias("list")
        )
        sizes = keep(asked.groupBy(*place).agg(F.ceil(F.count("*") / block).cast("bigint").alias("asks")), "asks")
        # A row for each list in use: MAX_LISTS * MAX_SECOND for a length at most, and fewer than entries / LIST_ROWS.
        loads = keep(blocks.join(sizes, place), "loads")
        if loads.count() <= BROADCAST_LISTS:
            loads = F.broadcast(loads)
        stored = indexed.join(loads, place).select(
            "cid", "n", "v", *place, "code", "error", "probes",
            F.pmod(F.xxhash64("cid"), "blocks").alias("part"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("asks") - 1)).alias("ask"),
        )
        asked = asked.join(loads, place).select(
            "cid", "v", "n", "home", *place, F.pmod(F.xxhash64("cid"), "asks").alias("ask"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("part"),
        )
        stored = stored.toDF(*stored.columns)  # own columns, as both sides come from the index
        group = ["width", "list", "part", "ask"]

        def compare(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            return _search(similarity, shared.value)(queries, held)

        found = keep(
            asked.groupBy(*group).cogroup(stored.groupBy(*group))
            .applyInPandas(compare, "a bigint, b bigint, n bigint"),
            "found",
        )
        counts = found.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("links"))
        roots = components(found.where(F.col("a") != F.col("b")).select("a", "b"))
    else:
        none = spark.createDataFrame([], "cid bigint, links bigint, node bigint, root bigint")
        counts, roots = none.select("cid", "links"), none.select("node", "root")
    classes = (
        entries.join(counts, "cid", "left")
        .join(roots, F.col("cid") == F.col("node"), "left")
        .select("h", F.col("v").alias("w"), "first", F.coalesce("root", "cid").alias("root"),
                (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    smallest = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = classes.join(smallest, "root").withColumnRenamed("h", "g")
    joined = rows.join(classes, (F.col("h") == F.col("g")) & (F.col("v") == F.col("w")), "left")
    own = F.coalesce("component_id", "vec_id")
    return joined.select(
        *KEY, "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"),
    )
