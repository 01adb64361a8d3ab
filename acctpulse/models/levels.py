"""Isolation trees on samples that no task could hold.

A tree's sample is the ``size`` rows with the smallest hashes of its own. The largest of these hashes is found by counting:
each pass narrows every tree's range by ``BINS``, until a border has exactly ``size`` rows below it. So a row knows by
itself which trees it belongs to, in every later pass.

Trees grow level by level: one pass sends each row down the trees built so far and returns, for each open
node, its rows and the least and largest value of each feature; the driver draws the splits. A node of at most
``FINISH_ROWS`` rows is left to a task of its own, which gets its rows and builds all that is below it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096
FINISH_ROWS = 16_384
HASH = "_pick"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def picks(row_hash: np.ndarray, tree: int) -> np.ndarray:
    """Each row's hash for a tree."""
    own = _mix(np.array([tree + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _mix(row_hash.astype(np.int64).view(np.uint64) ^ own)


def hash_limits(rows: DataFrame, n_trees: int, size: int) -> np.ndarray:
    """For each tree the hash below which exactly ``size`` rows lie; ``rows`` has ``_pick``."""
    low, high = [0] * n_trees, [1 << 64] * n_trees
    below, limit = [0] * n_trees, [-1] * n_trees
    open_trees = list(range(n_trees))
    while open_trees:
        step = {t: -(-(high[t] - low[t]) // BINS) for t in open_trees}
        ranges = [(t, low[t], high[t], step[t]) for t in open_trees]

        def count(batches: Iterator[pd.DataFrame], ranges: list = ranges) -> Iterator[pd.DataFrame]:
            seen = np.zeros((len(ranges), BINS), np.int64)
            for pdf in batches:
                for i, (t, lo, hi, width) in enumerate(ranges):
                    h = picks(pdf[HASH].to_numpy(), t)
                    h = h[(h >= np.uint64(lo)) & (h <= np.uint64(hi - 1))] - np.uint64(lo)
                    seen[i] += np.bincount((h // np.uint64(width)).astype(np.int64), minlength=BINS)
            i, at = np.nonzero(seen)
            yield pd.DataFrame({"tree": np.array([r[0] for r in ranges])[i], "bin": at, "n": seen[i, at]})

        told = rows.select(HASH).mapInPandas(count, "tree int, bin int, n bigint")
        told = told.groupBy("tree", "bin").agg(F.sum("n").alias("n")).toPandas().sort_values(["tree", "bin"])
        for t, own in told.groupby("tree"):
            for at, n in zip(own["bin"].tolist(), own["n"].tolist(), strict=True):
                if below[t] + n >= size:
                    break
                below[t] += n
            end = min(low[t] + (at + 1) * step[t], high[t])
            # Equal hashes of one tree can't be told apart; with 64 bits there are none to speak of.
            if below[t] + n == size or end - (low[t] + at * step[t]) <= 1:
                limit[t] = end
            low[t], high[t] = low[t] + at * step[t], end
        open_trees = [t for t in open_trees if limit[t] < 0 and t in set(told["tree"])]
    return np.array([max(0, x - 1) for x in limit], np.uint64)


class Splits:
    """The splits drawn so far, by tree and place; each node is open, split or to be finished."""

    def __init__(self, n_trees: int):
        self.feature: list[dict[int, int]] = [{} for _ in range(n_trees)]
        self.threshold: list[dict[int, float]] = [{} for _ in range(n_trees)]

    def tables(self, levels: int) -> tuple[np.ndarray, np.ndarray]:
        """Feature (-1: none) and threshold for the places of the first levels."""
        size = 2 ** (levels + 1) - 1
        feature = np.full((len(self.feature), size), -1, np.int32)
        threshold = np.zeros((len(self.feature), size))
        for t, own in enumerate(self.feature):
            for node, f in own.items():
                feature[t, node], threshold[t, node] = f, self.threshold[t][node]
        return feature, threshold


def _walk(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, levels: int) -> np.ndarray:
    """The place in one tree where each row ends."""
    at = np.zeros(len(x), np.int64)
    for _ in range(levels):
        f = feature[at]
        right = x[np.arange(len(x)), np.maximum(f, 0)] > threshold[at]
        at = np.where(f >= 0, 2 * at + 1 + right, at)
    return at


def grow(
    df: DataFrame, features: list[str], n_trees: int, size: int, seed: int, max_depth: int,
    build: Callable[[np.ndarray, np.random.Generator, int], list[tuple]], seq: str, schema: str,
) -> pd.DataFrame:
    """Nodes of all trees. ``build`` makes the nodes below one from its rows; ``df`` is a written table."""
    rows = df.select(*features, F.xxhash64(F.lit(seed), F.col(seq)).alias(HASH))
    limits = hash_limits(rows, n_trees, size)
    splits = Splits(n_trees)
    nodes: list[tuple] = []
    open_nodes = {(t, 0) for t in range(n_trees)}
    ready: list[tuple[int, int]] = []
    width, level = len(features), 0
    while open_nodes:
        feature, threshold = splits.tables(level)
        wanted = open_nodes

        def spans(batches: Iterator[pd.DataFrame], level: int = level, wanted: set = wanted,
                  feature: np.ndarray = feature, threshold: np.ndarray = threshold) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                x, h = pdf[features].to_numpy(np.float64), pdf[HASH].to_numpy()
                for t in sorted({t for t, _ in wanted}):
                    own = x[picks(h, t) <= limits[t]]
                    at = _walk(own, feature[t], threshold[t], level)
                    order = np.argsort(at, kind="stable")
                    at, own = at[order], own[order]
                    begin = np.flatnonzero(np.diff(at, prepend=-1))
                    keep = [i for i, b in enumerate(begin) if (t, int(at[b])) in wanted]
                    if not keep:
                        continue
                    low, high = np.minimum.reduceat(own, begin), np.maximum.reduceat(own, begin)
                    n = np.diff(np.append(begin, len(at)))
                    yield pd.DataFrame({"tree": t, "node": at[begin][keep], "n": n[keep]}).join(
                        pd.DataFrame(np.concatenate([low, high], 1)[keep], columns=names))

        names = [f"l{i}" for i in range(width)] + [f"h{i}" for i in range(width)]
        kinds = "tree int, node bigint, n bigint, " + ", ".join(f"{c} double" for c in names)
        told = rows.mapInPandas(spans, kinds).groupBy("tree", "node").agg(
            F.sum("n").alias("n"), *[F.min(c).alias(c) for c in names[:width]], *[F.max(c).alias(c) for c in names[width:]]
        ).toPandas()
        open_nodes = set()
        values = told[names].to_numpy()
        for t, node, n, value in zip(told["tree"].tolist(), told["node"].tolist(), told["n"].tolist(), values, strict=True):
            if n <= FINISH_ROWS:
                ready.append((t, node))
                continue
            low, high = value[:width], value[width:]
            usable = np.flatnonzero(high > low)
            if level >= max_depth or not len(usable):
                nodes.append((t, node, -1, 0.0, n, level))
                continue
            rng = np.random.default_rng([seed, t, node])
            f = int(rng.choice(usable))
            cut = float(rng.uniform(low[f], high[f]))
            cut = float(low[f]) if cut >= high[f] else cut
            splits.feature[t][node], splits.threshold[t][node] = f, cut
            nodes.append((t, node, f, cut, n, level))
            open_nodes |= {(t, 2 * node + 1), (t, 2 * node + 2)}
        level += 1
    feature, threshold = splits.tables(level)
    deal = set(ready)

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, h = pdf[features].to_numpy(np.float64), pdf[HASH].to_numpy()
            for t in sorted({t for t, _ in deal}):
                own = np.flatnonzero(picks(h, t) <= limits[t])
                at = _walk(x[own], feature[t], threshold[t], level)
                there = np.array([(t, a) in deal for a in at.tolist()], bool)
                yield pd.DataFrame({"tree": t, "node": at[there], HASH: h[own][there]}).join(
                    pd.DataFrame(x[own][there], columns=features))

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        t, node = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        depth = int(node + 1).bit_length() - 1
        sample = pdf.sort_values(HASH)[features].to_numpy(np.float64)
        below = build(sample, np.random.default_rng([seed, t, node]), max_depth - depth)
        out = []
        for local, f, cut, n, deep in below:
            place = (node + 1) * 2**deep + (local + 1 - 2**deep) - 1
            out.append((t, place, f, cut, n, depth + deep))
        return pd.DataFrame(out, columns=["tree", "node", "feature", "threshold", "rows", "depth"])

    columns = ", ".join(f"`{c}` double" for c in features)
    dealt = rows.mapInPandas(members, f"tree int, node bigint, {HASH} bigint, {columns}")
    built = dealt.groupBy("tree", "node").applyInPandas(finish, schema).toPandas()
    whole = pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "rows", "depth"])
    whole = pd.concat([whole, built]) if len(whole) else built
    kinds = {"tree": "int32", "node": "int32", "feature": "int32", "rows": "int32", "depth": "int32"}
    return whole.astype(kinds).sort_values(["tree", "node"]).reset_index(drop=True)
