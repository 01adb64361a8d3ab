"""Exact nearest neighbours by a pivot index.

Reference rows belong to the cell of their nearest centre.  Centres are found on a bounded sample and only
shape the cells; every row is indexed.  For each cell the index knows the least and largest distance of its rows to
a few pivots and to its own centre.  For a query this gives a lower bound of the distance to any row of a cell: by the
triangle inequality for each pivot, and by the plane between the cell's centre and the centre
nearest to the query.  Bounds are lowered by more than rounding can add.

A query first visits the cell of its nearest centre, which gives it a radius, and then all other cells within it; so
neighbours are exact, and cells out of reach are never read.  Queries travel in blocks of near cells: a cell is sent once
to a block in which any query reaches it, and not once to each query.  A task holds one block and lets a
group of cells pass by, slice by slice; both are of bounded size.  Pairs stay inside numpy, and only the k best of a
query leave the task.

Distances are first estimated by products of matrices of 4-byte floats, relative to the cell's centre.  What the error of
such a product cannot rule out is measured difference by difference in doubles.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acctpulse.session import cut_lineage, scratch_path

#: Rows a cell has on average, up to ``MAX_CELLS`` cells; beyond that cells grow and are cut into slices.
CELL_ROWS, MAX_CELLS = 1024, 4096
SLICE_ROWS = 1024
#: Rows of the sample on which centres are found, per centre and in all; rounds of moving the centres.
SAMPLE_PER_CELL, SAMPLE_ROWS, MOVES = 64, 65_536, 4
PIVOTS = 8
#: Queries that are compared with a slice at once.
BLOCK = 1024
#: Bytes of a block of queries with their best rows, and of the rows of a group of cells; queries of a block.
BLOCK_BYTES, GROUP_BYTES, BLOCK_LEAST = 1 << 26, 1 << 27, 1024
#: Tasks for each core, where blocks are large enough for that, and the most partitions for them.
TASKS_PER_CORE, MOST_TASKS = 3, 1 << 14
#: Parts are so much larger than an even share, as cells do not fill them and the rest would be a part of its own.
DEALT = 1.1
#: A slice with more candidates than this for each neighbour asked for is looked at again with a nearer limit.
CANDIDATES = 4
#: Candidates that are measured at once.
MEASURED = 1 << 14
#: Rows of the planning of visits that leave together, and queries that leave a block together.
ASKS_AT_ONCE = 4096
#: Distances between rows and centres that a task holds at once.
DISTANCES = 1 << 18
#: Squared distances from products of matrices are off by less than this part of the squared lengths.
ROUNDING = 1e-11

#: Stands for a null id inside numpy.
NULL = np.iinfo(np.int64).min

#: A query (``cell`` -1) or a reference row on its way to task ``key``; ``p`` is the packed vector.
SENT = "key int, cell int, id bigint, copies bigint, p binary, radius double, own int"
#: What a task tells of a query: the distance within which it has all neighbours, and its best rows.
TOLD = (
    "key int, qid bigint, own int, p binary, radius double, rids array<bigint>, dists array<double>, "
    "times array<bigint>"
)


@dataclass
class PivotIndex:
    """Centres (cells x width), which of them are pivots, and distances of a cell's rows."""

    centers: np.ndarray
    pivots: np.ndarray
    low: np.ndarray  # cells x pivots: least distance of a row to the pivot
    high: np.ndarray
    far: np.ndarray  # cells: largest distance of a row to its centre
    rows: np.ndarray

    def bounds(self, q: np.ndarray, cells: np.ndarray | None = None, known: tuple | None = None) -> np.ndarray:
        """Lower bounds of the distance of each query to any row of each cell, or of each of ``cells``.

        ``known``: what ``known`` tells of the queries, if that is at hand.
        """
        cells = np.arange(len(self.centers)) if cells is None else cells
        nearest, least, to_pivot, off = known or self.known(q)
        sq = squared(q, self.centers[cells])[0]
        slack = np.sqrt(off)
        out = np.sqrt(sq) - self.far[None, cells]
        for p in range(len(self.pivots)):
            at = to_pivot[:, p, None]
            np.maximum(out, at - self.high[None, cells, p], out=out)
            np.maximum(out, self.low[None, cells, p] - at, out=out)
        out -= 2 * slack
        for c in np.unique(nearest):
            own = np.flatnonzero(nearest == c)
            apart = np.sqrt(((self.centers[cells] - self.centers[c]) ** 2).sum(axis=1))
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (sq[own] - least[own, None] - 3 * off[own]) / (2 * apart[None, :])
            plane[:, cells == c] = 0
            out[own] = np.maximum(out[own], np.nan_to_num(plane, nan=0.0, posinf=0.0, neginf=0.0))
        return np.maximum(out, 0.0)

    def known(self, q: np.ndarray, own: np.ndarray | None = None) -> tuple:
        """Each query's nearest centre (or ``own``, one it takes for that) and its squared distance, distances to
        the pivots, how far squared distances may be off."""
        to_pivot = np.sqrt(squared(q, self.centers[self.pivots])[0])
        off = ROUNDING * ((q * q).sum(axis=1) + (self.centers**2).sum(axis=1).max(initial=0.0)) + 1e-300
        if own is not None:
            return own, ((q - self.centers[own]) ** 2).sum(axis=1), to_pivot, off[:, None]
        sq = squared(q, self.centers)[0]
        own = sq.argmin(axis=1)
        return own, sq[np.arange(len(q)), own], to_pivot, off[:, None]

    def reach(self, q: np.ndarray, rows: int) -> np.ndarray:
        """A distance within which each query has ``rows`` rows, by the cells' sizes alone; infinite if there are fewer."""
        out = np.full(len(q), np.inf)
        step = max(1, DISTANCES // len(self.centers))
        full = np.flatnonzero(self.rows > 0)
        for i in range(0, len(q), step):
            sq, off = squared(q[i : i + step], self.centers)
            upper = (np.sqrt(sq) + 3 * np.sqrt(off) + self.far[None, :])[:, full]
            order = np.argsort(upper, axis=1)
            enough = np.cumsum(self.rows[full][order], axis=1) >= rows
            if not enough.size:
                continue
            first = enough.argmax(axis=1)[:, None]
            found = np.take_along_axis(np.take_along_axis(upper, order, axis=1), first, axis=1)[:, 0]
            out[i : i + step] = np.where(enough.any(axis=1), found, np.inf)
        return out


def squared(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one product of matrices, and how far each query's may be off."""
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    sq = xx[:, None] + yy[None, :] - 2.0 * (x @ y.T)
    return np.maximum(sq, 0.0), (ROUNDING * (xx + yy.max(initial=0.0)) + 1e-300)[:, None]


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def packed(v: np.ndarray) -> pa.Array:
    """Vectors as bytes: a row as 4-byte floats if these hold it exactly, else as doubles."""
    with np.errstate(over="ignore"):
        small = v.astype(np.float32)
    exact = (small == v).all(axis=1)
    if not exact.all():
        return pa.array([(s if e else r).tobytes() for s, r, e in zip(small, v, exact)], pa.binary())
    offsets = np.arange(len(v) + 1, dtype=np.int32) * np.int32(4 * v.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(offsets), pa.py_buffer(small.tobytes())])


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a column that ``packed`` made."""
    column, n = column.cast(pa.binary()), len(column)
    if not n or not width:
        return np.zeros((n, width))
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    if (size == 4 * width).all():
        return data.view(np.float32).reshape(n, width).astype(np.float64)
    out = np.empty((n, width))
    for kind in (np.float32, np.float64):
        length = width * np.dtype(kind).itemsize
        some = np.flatnonzero(size == length)
        at = (offsets[some] - offsets[0])[:, None] + np.arange(length)
        out[some] = np.ascontiguousarray(data[at]).view(kind).reshape(len(some), width)
    return out


def vectors_of(column: pa.Array) -> np.ndarray:
    """Vectors of a column of lists of equal length."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def numbers(column: pa.Array) -> np.ndarray:
    """Whole numbers of a column; ``NULL`` stands for null."""
    return column.cast(pa.int64()).fill_null(NULL).to_numpy(zero_copy_only=False)


def _centers(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of the sample: rows of it, moved to the mean of their cell a few times."""
    sample = np.unique(sample, axis=0)
    sample = sample[np.random.default_rng(0).permutation(len(sample))]
    centers = sample[:cells].copy()
    for _ in range(MOVES):
        own = np.concatenate(
            [squared(sample[i : i + 4096], centers)[0].argmin(axis=1) for i in range(0, len(sample), 4096)]
        )
        sums = np.zeros_like(centers)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=len(centers))
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return np.unique(centers, axis=0)


def _pivots(centers: np.ndarray) -> np.ndarray:
    """Centres far from each other, the first far from the mean."""
    away = ((centers - centers.mean(axis=0)) ** 2).sum(axis=1)
    out: list[int] = []
    while len(out) < min(PIVOTS, len(centers)):
        out.append(int(away.argmax()))
        apart = ((centers - centers[out[-1]]) ** 2).sum(axis=1)
        away = apart if len(out) == 1 else np.minimum(away, apart)
    return np.array(out)


def build_index(refs: DataFrame, rows: int) -> tuple[DataFrame, PivotIndex]:
    """``refs`` (rid, copies, v; a written table) with ``cell``, written once, and its index."""
    cells = min(MAX_CELLS, max(1, -(-rows // CELL_ROWS)))
    wanted = min(SAMPLE_ROWS, SAMPLE_PER_CELL * cells)
    share = F.lit(min(1.0, 1.2 * wanted / max(rows, 1)) * (1 << 30))
    picked = refs.where(F.pmod(F.xxhash64("rid"), F.lit(1 << 30)) <= share).select("v")
    sample = matrix(picked.toPandas()["v"])
    if not len(sample):
        sample = matrix(refs.limit(1).toPandas()["v"])
    centers = _centers(sample, cells) if len(sample) else np.zeros((1, 0))
    pivots = _pivots(centers)
    shared = refs.sparkSession.sparkContext.broadcast((centers, pivots))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centers, pivots = shared.value
        for pdf in batches:
            step = max(1, DISTANCES // len(centers))
            for i in range(0, len(pdf), step):
                part = pdf.iloc[i : i + step]
                v = matrix(part["v"])
                sq = squared(v, centers)[0]
                cell = sq.argmin(axis=1)
                near = np.sqrt(np.concatenate([sq[np.arange(len(v)), cell][:, None], sq[:, pivots]], axis=1))
                yield part.assign(cell=cell.astype(np.int32), near=list(near))

    placed = refs.select("rid", "copies", "v").mapInPandas(
        place, "rid bigint, copies bigint, v array<double>, cell int, near array<double>"
    )
    placed = cut_lineage(placed)
    places = range(1, len(pivots) + 1)
    told = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max(F.col("near")[0]).alias("far"),
        F.array(*[F.min(F.col("near")[i]) for i in places]).alias("low"),
        F.array(*[F.max(F.col("near")[i]) for i in places]).alias("high"),
    ).toPandas()
    size = len(centers)
    # A cell without rows is out of every query's reach.
    low, high = np.full((size, len(pivots)), np.inf), np.full((size, len(pivots)), -np.inf)
    far, n = np.full(size, -np.inf), np.zeros(size, np.int64)
    at = told["cell"].to_numpy()
    if len(at):
        low[at], high[at] = matrix(told["low"]), matrix(told["high"])
        far[at], n[at] = told["far"], told["n"]
    return placed.drop("near"), PivotIndex(centers, pivots, low, high, far, n)


def near_pairs(
    a: np.ndarray, b: np.ndarray, limit: np.ndarray, k: int, kind: type = np.float32
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``a`` and ``b`` among which are all within ``limit`` that can be among the k nearest of a.

    Estimated with numbers of ``kind``; where these tell too little, with doubles.
    """
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    top = bb.max(initial=0.0)
    if kind is np.float32 and max(aa.max(initial=0.0), top) > 1e30:
        kind = np.float64
    # Of a squared distance: rounding of both rows and of a product with one term more than they have.
    off = (a.shape[1] + 16) * float(np.finfo(kind).eps) * (aa + top) + 1e-30
    # d * d <= l * l if and only if a.b - b.b / 2 >= (a.a - l * l) / 2.
    half = np.concatenate([b, -bb[:, None] / 2], axis=1).astype(kind)
    est = np.concatenate([a, np.ones((len(a), 1))], axis=1).astype(kind) @ half.T
    with np.errstate(over="ignore"):
        least = ((aa - limit**2 * (1 + 1e-9) - off) / 2).astype(kind)
    hit = est >= least[:, None]
    most = CANDIDATES * k * len(a)
    if np.count_nonzero(hit) > most and k < len(b):
        kth = np.partition(est, len(b) - k, axis=1)[:, len(b) - k]
        hit = est >= np.maximum(least, kth - off.astype(kind))[:, None]
        if kind is np.float32 and np.count_nonzero(hit) > most:
            return near_pairs(a, b, limit, k, np.float64)
    return np.divmod(_true(hit.ravel()), len(b))


def _true(flags: np.ndarray) -> np.ndarray:
    """Places of the few that are true: eight are looked at together."""
    whole = len(flags) // 8 * 8
    some = np.flatnonzero(flags[:whole].view(np.uint64))
    at = np.append((some[:, None] * 8 + np.arange(8)).ravel(), np.arange(whole, len(flags)))
    return at[flags[at]]


def _ordered(query: np.ndarray, dist: np.ndarray, rid: np.ndarray) -> np.ndarray:
    """Order by query, distance, id: one sort by 32 bits of each of the first two; what these leave equal again."""
    with np.errstate(over="ignore"):
        key = (query.astype(np.uint64) << np.uint64(32)) | dist.astype(np.float32).view(np.uint32)
    order = np.argsort(key)
    key = key[order]
    equal = key[1:] == key[:-1]
    again = np.flatnonzero(np.append(equal, False) | np.append(False, equal))
    some = order[again]
    order[again] = some[np.lexsort((rid[some], dist[some], query[some]))]
    return order


class Block:
    """Queries of a task, and the first rows that cover k copies of each among those it has met."""

    def __init__(self, index: PivotIndex, k: int, self_free: bool, own_only: bool):
        self.index, self.k, self.self_free, self.own_only = index, k, self_free, own_only
        self.asked: list[tuple] = []
        self.qid: np.ndarray | None = None
        self.cell, self.waiting, self.rows_waiting = -1, [], 0
        self.found, self.rows_found = [], 0

    def ask(self, qid: np.ndarray, own: np.ndarray, x: np.ndarray, radius: np.ndarray) -> None:
        self.asked.append((qid, own, x, radius))

    def begin(self) -> None:
        """All queries are here."""
        none = np.zeros(0, np.int64)
        self.asked.append((none, none, np.zeros((0, self.index.centers.shape[1])), np.zeros(0)))
        self.qid, self.own, self.x, self.limit = (np.concatenate(c) for c in zip(*self.asked))
        self.asked, n = [], len(self.qid)
        self.known = self.index.known(self.x, self.own)
        self.dist = np.full((n, self.k), np.inf)
        self.rid = np.zeros((n, self.k), np.int64)
        self.copies = np.zeros((n, self.k), np.int64)

    def meet(self, cell: int, rid: np.ndarray, copies: np.ndarray, r: np.ndarray) -> None:
        """Reference rows of a cell pass by; rows of one cell come one after another."""
        if self.qid is None:
            self.begin()
        if cell != self.cell:
            self.compare()
            self.cell = cell
            if self.own_only:
                self.live = np.flatnonzero(self.own == cell)
            else:
                bound = self.index.bounds(self.x, np.array([cell]), self.known)[:, 0]
                self.live = np.flatnonzero((bound <= self.limit * (1 + 1e-9) + 1e-12) & (self.own != cell))
        for i in range(0, len(rid) if len(self.live) else 0, SLICE_ROWS):
            if self.rows_waiting + min(SLICE_ROWS, len(rid) - i) > SLICE_ROWS:
                self.compare()
            self.waiting.append(tuple(c[i : i + SLICE_ROWS] for c in (rid, copies, r)))
            self.rows_waiting += len(self.waiting[-1][0])

    def compare(self) -> None:
        """Candidates of the slice that has gathered."""
        if not self.waiting:
            return
        rid, copies, r = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.rows_waiting = [], 0
        center = self.index.centers[self.cell]
        b = r - center
        for i in range(0, len(self.live), BLOCK):
            at = self.live[i : i + BLOCK]
            x = self.x[at]
            # A row may find itself, which does not count.
            query, row = near_pairs(x - center, b, self.limit[at], self.k + self.self_free)
            for j in range(0, len(query), MEASURED):
                self.measure(at[query[j : j + MEASURED]], row[j : j + MEASURED], rid, copies, r)

    def measure(self, query: np.ndarray, row: np.ndarray, rid: np.ndarray, copies: np.ndarray, r: np.ndarray) -> None:
        dist = np.sqrt(((r[row] - self.x[query]) ** 2).sum(axis=1))
        rid, copies = rid[row], copies[row]
        keep = dist <= self.limit[query]
        if self.self_free:
            copies = copies - ((rid == self.qid[query]) & (rid != NULL))
            keep &= copies > 0
        self.found.append((query[keep], dist[keep], rid[keep], copies[keep]))
        self.rows_found += len(self.found[-1][0])
        if self.rows_found > max(MEASURED, self.k * len(self.live) // 2):
            self.merge()

    def merge(self) -> None:
        """The best of what was known and what was found; limits shrink."""
        if not self.rows_found:
            return
        k = self.k
        query, dist, rid, copies = (np.concatenate(c) for c in zip(*self.found))
        self.found, self.rows_found = [], 0
        mark = np.zeros(len(self.qid), bool)
        mark[query] = True
        some = np.flatnonzero(mark)
        old = np.flatnonzero(self.copies[some].ravel())
        query = np.concatenate([np.repeat(some, k)[old], query])
        dist = np.concatenate([self.dist[some].ravel()[old], dist])
        rid = np.concatenate([self.rid[some].ravel()[old], rid])
        copies = np.concatenate([self.copies[some].ravel()[old], copies])
        order = _ordered(query, dist, rid)
        query, dist, rid, copies = query[order], dist[order], rid[order], copies[order]
        start = np.flatnonzero(np.diff(query, prepend=-1))
        length = np.diff(start, append=len(query))
        place = np.arange(len(query)) - np.repeat(start, length)
        upto = np.cumsum(copies)
        upto -= np.repeat(upto[start] - copies[start], length)  # now of its own query
        keep = (place < k) & (upto - copies < k)
        self.dist[some], self.copies[some] = np.inf, 0
        query, place = query[keep], place[keep]
        self.dist[query, place], self.rid[query, place], self.copies[query, place] = dist[keep], rid[keep], copies[keep]
        covers = keep & (upto >= k)  # of each query that is covered the last that is kept
        last = covers[keep]
        self.limit[query[last]] = np.minimum(self.limit[query[last]], dist[covers])

    def end(self) -> Iterator[tuple[slice, dict]]:
        """Each run of queries and what ``TOLD`` says of their best rows."""
        if self.qid is None:
            self.begin()
        self.compare()
        self.merge()
        if self.own_only:
            bare = np.flatnonzero(self.copies.sum(axis=1) < self.k)
            self.limit[bare] = self.index.reach(self.x[bare], self.k + self.self_free)
        for i in range(0, len(self.qid), ASKS_AT_ONCE):
            run = slice(i, i + ASKS_AT_ONCE)
            has = self.copies[run] > 0
            offsets = np.concatenate([[0], np.cumsum(has.sum(axis=1))]).astype(np.int32)
            lists = {"rids": self.rid, "dists": self.dist, "times": self.copies}
            yield run, {n: pa.ListArray.from_arrays(offsets, _nullable(c[run][has])) for n, c in lists.items()}


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, mask=values == NULL) if values.dtype == np.int64 else pa.array(values)


def _visits(shared, k: int, self_free: bool, own_only: bool) -> Callable:
    """The task that lets reference rows pass by blocks of queries; rows come ordered by key and cell."""

    def told(key: int, block: Block) -> Iterator[pa.RecordBatch]:
        for run, lists in block.end():
            part = {
                "key": pa.array(np.full(len(block.qid[run]), key, np.int32)),
                "qid": _nullable(block.qid[run]), "own": pa.array(block.own[run].astype(np.int32)),
                "p": packed(block.x[run]), "radius": pa.array(block.limit[run]), **lists,
            }
            yield pa.RecordBatch.from_pydict(part)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = PivotIndex(**shared.value)
        width, key, block = index.centers.shape[1], None, None
        for batch in batches:
            keys, cells = batch.column("key").to_numpy(), batch.column("cell").to_numpy()
            new = np.flatnonzero((np.diff(keys, prepend=-1) != 0) | (np.diff(cells, prepend=-2) != 0))
            for start, end in zip(new, np.append(new[1:], len(keys))):
                if keys[start] != key:
                    if block is not None:
                        yield from told(key, block)
                    key, block = keys[start], Block(index, k, self_free, own_only)
                part = batch.slice(start, end - start)
                ids, x = numbers(part.column("id")), unpacked(part.column("p"), width)
                if cells[start] < 0:
                    block.ask(ids, part.column("own").to_numpy(), x, part.column("radius").to_numpy().copy())
                else:
                    block.meet(int(cells[start]), ids, part.column("copies").to_numpy(), x)
        if block is not None:
            yield from told(key, block)

    return visit


def dealt(rows: np.ndarray, order: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts of at most ``most`` rows: each cell's first part and how many it fills.

    Cells that follow each other in ``order`` share a part; one that is too large fills several alone.
    """
    first, parts, at, used = np.zeros(len(rows), np.int64), np.maximum(1, -(-rows // most)), 0, 0
    for c in order:
        if used and used + rows[c] > most:
            at, used = at + 1, 0
        first[c] = at
        used += rows[c]
        if parts[c] > 1:
            at, used = at + parts[c], 0
    return first, parts


def _spread(ids: np.ndarray) -> np.ndarray:
    """A number of 31 bits that tells ids of one cell apart."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C55)) >> np.uint64(33)).astype(np.int64)


def neighbourly(centers: np.ndarray) -> np.ndarray:
    """An order in which near centres tend to follow each other: halves along the widest axis, and so on."""
    out, stack = [], [np.arange(len(centers))]
    while stack:
        some = stack.pop()
        if len(some) < 3 or not centers.shape[1]:
            out.append(some)
            continue
        axis = np.ptp(centers[some], axis=0).argmax()
        some = some[np.argsort(centers[some, axis], kind="stable")]
        stack += [some[len(some) // 2 :], some[: len(some) // 2]]
    return np.concatenate(out)


def _sent(asked: DataFrame, refs: DataFrame, plan: DataFrame, groups: int) -> DataFrame:
    """All that tasks get: a cell's rows once for each block that reaches it, a query once for each group of cells.

    ``asked``: block, qid, own, p, radius.  ``refs``: cell, part, rid, copies, p.  ``plan``: block, cell and ``parts``,
    the groups over which the cell's rows are dealt.  With a single group no query is left out.
    """
    by_cell = F.broadcast(plan.groupBy("cell").agg(F.collect_set("block").alias("blocks")))  # at most MAX_CELLS rows
    right = refs.join(by_cell, "cell").withColumn("block", F.explode("blocks"))
    right = right.select(
        (F.col("block") * groups + F.col("part")).alias("key"), "cell", F.col("rid").alias("id"), "copies", "p",
        F.lit(0.0).alias("radius"), F.lit(-1).alias("own"),
    )
    if groups > 1:
        by_block = plan.select("block", F.explode("parts").alias("part")).groupBy("block")
        by_block = F.broadcast(by_block.agg(F.collect_set("part").alias("parts")))
        asked = asked.join(by_block, "block").withColumn("part", F.explode("parts"))
    else:
        asked = asked.withColumn("part", F.lit(0))
    left = asked.select(
        (F.col("block") * groups + F.col("part")).alias("key"), F.lit(-1).alias("cell"), F.col("qid").alias("id"),
        F.lit(0).cast("bigint").alias("copies"), "p", "radius", "own",
    )
    return left.unionByName(right)


def _compared(sent: DataFrame, tasks: int, visit: Callable) -> DataFrame:
    tasks = int(min(tasks, MOST_TASKS))
    return sent.repartitionById(tasks, F.col("key")).sortWithinPartitions("key", "cell").mapInArrow(visit, TOLD)


def first_k(hits: DataFrame, k: int) -> DataFrame:
    """The k nearest copies per query: rows in order until ``k`` copies are covered."""
    order = W.partitionBy("qid").orderBy("dist", "rid")
    before = F.coalesce(
        F.sum("copies").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .withColumn("before", before)
        .where(F.col("before") < k)
        .select("qid", "rid", "dist", F.least("copies", F.lit(k) - F.col("before")).alias("copies"))
    )


def _asks(queries: DataFrame, index: PivotIndex, start: int, end: int) -> DataFrame:
    """How many queries (v, radius) of each ``qid``, which may name a block of them, reach which cell: (qid, cell, n).

    Places ``start`` to ``end`` of a query's list count, which begins with the cell ``own``.
    """
    shared = queries.sparkSession.sparkContext.broadcast(vars(index))  # arrays only: workers may lack this package

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = PivotIndex(**shared.value)
        cells = np.arange(len(index.centers))
        for pdf in batches:
            step = max(1, DISTANCES // len(cells))
            for i in range(0, len(pdf), step):
                part = pdf.iloc[i : i + step]
                v = part["v"]
                packs = len(v) and isinstance(v.iloc[0], bytes)
                v = unpacked(pa.array(v, pa.binary()), index.centers.shape[1]) if packs else matrix(v)
                inside = index.bounds(v) <= part["radius"].to_numpy()[:, None]
                inside &= index.rows > 0
                if start > 0 or end < len(cells):
                    own = part["own"].to_numpy()[:, None]
                    place = np.where(cells == own, 0, cells + (cells < own))
                    inside &= (start <= place) & (place < end)
                names = part["qid"].to_numpy()
                many = np.unique(names)
                n = np.stack([inside[names == name].sum(axis=0) for name in many])
                row, cell = np.nonzero(n)
                for s in range(0, len(row), ASKS_AT_ONCE):  # a query may visit all cells
                    some = slice(s, s + ASKS_AT_ONCE)
                    told = {"qid": many[row[some]], "cell": cell[some].astype(np.int32), "n": n[row[some], cell[some]]}
                    yield pd.DataFrame(told)

    return queries.select("qid", "v", "radius", "own").mapInPandas(plan, "qid int, cell int, n bigint")


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "neighbours")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _packed_rows(refs: DataFrame, first: np.ndarray, parts: np.ndarray) -> DataFrame:
    """Reference rows with packed vectors and the group ``part`` each belongs to."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), ASKS_AT_ONCE):
                part = batch.slice(i, ASKS_AT_ONCE)
                cell = part.column("cell").to_numpy()
                to = first[cell] + _spread(numbers(part.column("rid"))) % parts[cell]
                yield pa.RecordBatch.from_pydict({
                    "cell": part.column("cell"), "part": pa.array(to.astype(np.int32)), "rid": part.column("rid"),
                    "copies": part.column("copies"), "p": packed(vectors_of(part.column("v"))),
                })

    return refs.select("cell", "rid", "copies", "v").mapInArrow(
        pack, "cell int, part int, rid bigint, copies bigint, p binary"
    )


def _own_cells(queries: DataFrame, index: PivotIndex) -> Callable[[np.ndarray, np.ndarray], DataFrame]:
    """Gives queries (block, qid, own, p, radius), once the blocks are known in which cells begin and which they fill."""
    shared = queries.sparkSession.sparkContext.broadcast(vars(index))

    def of(first: np.ndarray, parts: np.ndarray) -> DataFrame:
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = PivotIndex(**shared.value)
            step = min(ASKS_AT_ONCE, max(1, DISTANCES // len(index.centers)))
            for batch in batches:
                for i in range(0, len(batch), step):
                    part = batch.slice(i, step)
                    x, qid = vectors_of(part.column("v")), part.column("qid")
                    own = squared(x, index.centers)[0].argmin(axis=1)
                    block = first[own] + _spread(numbers(qid)) % parts[own]
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array(block.astype(np.int32)), "qid": qid, "own": pa.array(own.astype(np.int32)),
                        "p": packed(x), "radius": pa.array(np.full(len(x), np.inf)),
                    })

        return queries.select("qid", "v").mapInArrow(
            place, "block int, qid bigint, own int, p binary, radius double"
        )

    return of


def neighbours(
    queries: DataFrame,
    refs: DataFrame,
    index: PivotIndex,
    k: int,
    self_free: bool = False,
    visits: list | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Exact k nearest reference rows of every query as (qid, rid, dist, copies).

    ``queries``: qid, v; a written table.  ``refs``: rid, copies, v, cell.  ``visits`` receives the number of
    visited (query, cell) pairs of each round.  ``known``: the neighbours of all reference rows, of which none counts
    itself, as this function returns them; ids of rows must differ.  A query equal to a row has these and the row.
    """
    if known is not None:
        rows = refs.select("v", "rid", F.col("copies").alias("times"))
        met = queries.join(rows, "v", "left")
        met = _written(met.select("qid", "rid", "times", F.when(F.col("rid").isNull(), F.col("v")).alias("v")))
        equal = met.where("rid IS NOT NULL").select("qid", F.col("rid").alias("row"), "times")
        own = equal.select("qid", F.col("row").alias("rid"), F.lit(0.0).alias("dist"), F.col("times").alias("copies"))
        others = equal.join(known.withColumnRenamed("qid", "row"), "row").where("rid <> row")
        best = own.unionByName(others.select("qid", "rid", "dist", "copies"))
        rest = met.where("rid IS NULL").select("qid", "v")
        if not rest.isEmpty():
            best = best.unionByName(neighbours(rest, refs, index, k, self_free, visits))
        return _written(first_k(best, k))
    spark, cells, width = queries.sparkSession, len(index.centers), index.centers.shape[1]
    cores = spark.sparkContext.defaultParallelism
    order, one = neighbourly(index.centers), np.ones(cells, np.int64)
    placed = _own_cells(queries, index)
    rows = np.zeros(cells, np.int64)
    for own, n in placed(0 * one, one).groupBy("own").count().collect():  # at most MAX_CELLS rows
        rows[own] = n
    # Tasks are blocks times groups.  A group sends a block's queries and their best rows again, a block all rows it reaches.
    asks, tasks = int(rows.sum()), TASKS_PER_CORE * cores
    most = max(BLOCK_LEAST, math.ceil(DEALT * int(index.rows.sum()) / math.ceil(math.sqrt(tasks / 6))))
    first_group, parts = dealt(index.rows, order, max(1, min(most, GROUP_BYTES // (8 * width + 16))))
    groups = int((first_group + parts).max())
    most = min(max(BLOCK_LEAST, math.ceil(DEALT * asks * groups / tasks)), BLOCK_BYTES // (8 * width + 24 * k))
    first_block, shares = dealt(rows, order, max(1, most))
    blocks = int((first_block + shares).max())
    shared = spark.sparkContext.broadcast(vars(index))

    # Each query in the cell of its nearest centre; a block's cells all come to its one task.
    asked = placed(first_block, shares)
    plan = [(int(b), int(c)) for c in np.flatnonzero(rows) for b in range(first_block[c], first_block[c] + shares[c])]
    plan = spark.createDataFrame(plan, "block int, cell int").withColumn("parts", F.array(F.lit(0)))
    sent = _sent(asked, _packed_rows(refs, 0 * one, one), plan, 1)
    near = _written(_compared(sent, blocks, _visits(shared, k, self_free, True)))
    if visits is not None:
        visits.append(int(rows.sum()))
    best = [near]
    if cells > 1:
        # All other cells that a block's queries reach.
        named = near.select(F.col("key").alias("qid"), F.col("p").alias("v"), "radius", "own")
        plan = _asks(named, index, 1, cells).groupBy(F.col("qid").alias("block"), "cell").agg(F.sum("n").alias("n"))
        plan = cut_lineage(plan)
        if visits is not None:
            visits.append(plan.agg(F.sum("n")).first()[0] or 0)
        where = [(c, list(range(int(first_group[c]), int(first_group[c] + parts[c])))) for c in range(cells)]
        where = F.broadcast(spark.createDataFrame(where, "cell int, parts array<int>"))
        asked = near.select(F.col("key").alias("block"), "qid", "own", "p", "radius")
        sent = _sent(asked, _packed_rows(refs, first_group, parts), plan.join(where, "cell"), groups)
        best.append(_compared(sent, blocks * groups, _visits(shared, k, self_free, False)))
    hits = [
        b.select("qid", F.inline(F.arrays_zip("rids", "dists", "times"))).toDF("qid", "rid", "dist", "copies") for b in best
    ]
    return _written(first_k(hits[0] if len(hits) == 1 else hits[0].unionByName(hits[1]), k))
