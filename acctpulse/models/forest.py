"""Isolation forest (Liu, Ting and Zhou 2008) as Spark jobs.

Fitting needs only ``max_samples`` rows per tree.  Rows are chosen by a hash of
(seed, tree, seq), so a fit does not depend on partitioning, and every tree is
built in its own task from its own small sample.  Larger samples than ``GROUPED_SAMPLES`` are never held by a task: their
trees grow level by level (``levels``).  Trees are stored as complete
binary trees of fixed depth: node ``i`` has the children ``2i+1`` and ``2i+2``.  A model has up to
2 ``max_samples`` nodes a tree, so its size, and that of the broadcast that scores with it, follows ``max_samples``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.functions import scalar
from acctpulse.models import levels
from acctpulse.operators.quantile import exact_quantile
from acctpulse.session import scratch_path

EULER_GAMMA = 0.5772156649015329
# Candidates per wanted row: with 256 wanted, running short is beyond 10 deviations.
POOL_FACTOR = 3

# Rows of a tree's sample that one task may hold.
GROUPED_SAMPLES = 4096
NODE_SCHEMA = "tree int, node int, feature int, threshold double, rows int, depth int"


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=np.float64)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, long))


@dataclass
class ForestModel:
    """Trees plus the cut-off below which a row counts as anomalous."""

    features: list[str]
    nodes: pd.DataFrame  # NODE_SCHEMA; at most n_trees * (2 * max_samples - 1) rows
    n_trees: int
    max_samples: int
    offset: float = -0.5
    #: Raw scores (seq, raw) of the rows it was fitted on, where the fit had to compute them.
    fitted: DataFrame | None = field(default=None, repr=False, compare=False)

    kind = "IsolationForest"

    @property
    def depth(self) -> int:
        return max(1, math.ceil(math.log2(max(self.max_samples, 2))))

    def packed(self) -> dict[str, np.ndarray | float | int]:
        """Arrays for scoring: [trees, 2^depth - 1] splits and [trees, 2^depth] leaves.

        A leaf above the last level is padded downwards with splits that always
        lead left.
        """
        inner = 2**self.depth - 1
        feature = np.zeros((self.n_trees, inner), dtype=np.intp)
        threshold = np.full((self.n_trees, inner), np.inf)
        leaf = np.zeros((self.n_trees, inner + 1))
        n = self.nodes
        split = n["feature"].to_numpy() >= 0
        at = n[split]
        feature[at["tree"], at["node"]] = at["feature"]
        threshold[at["tree"], at["node"]] = at["threshold"]
        ends = n[~split]
        node, depth = ends["node"].to_numpy(), ends["depth"].to_numpy()
        bottom = (node + 1) * 2 ** (self.depth - depth) - 1 - inner
        leaf[ends["tree"], bottom] = depth + average_path(ends["rows"].to_numpy())
        return {
            "feature": feature,
            "threshold": threshold,
            "leaf": leaf,
            "depth": self.depth,
            "scale": float(average_path(self.max_samples)),
            "offset": self.offset,
        }


def sample_size(max_samples: int | float | str, rows: int) -> int:
    """Rows that a tree is built from."""
    if max_samples == "auto":
        return min(256, rows)
    if isinstance(max_samples, float):
        if not 0 < max_samples <= 1:
            raise ValueError("max_samples as a part of the rows is above 0 and at most 1.0")
        return max(1, int(max_samples * rows))
    if max_samples < 1:
        raise ValueError("max_samples is at least 1")
    return min(int(max_samples), rows)


def _build_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Random splits down to single rows, equal rows or ``max_depth``."""
    out, todo = [], [(0, 0, x)]
    while todo:
        node, depth, part = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= max_depth or len(part) <= 1 or not len(usable):
            out.append((node, -1, 0.0, len(part), depth))
            continue
        f = int(rng.choice(usable))
        cut = float(rng.uniform(low[f], high[f]))
        left = part[:, f] <= cut
        if left.all():  # rounding put the cut on the highest value
            cut = float(low[f])
            left = part[:, f] <= cut
        out.append((node, f, cut, len(part), depth))
        todo.append((2 * node + 2, depth + 1, part[~left]))
        todo.append((2 * node + 1, depth + 1, part[left]))
    return out


def sample_per_tree(
    df: DataFrame, rows: int, n_trees: int, max_samples: int, seed: int, factor: int = POOL_FACTOR
) -> DataFrame:
    """``max_samples`` rows for each tree, uniform and without replacement.

    Each tree takes the rows with the smallest hash of its own.  To keep that cheap, one hash
    per row first reduces the table to a pool, and a row becomes a candidate of a tree only
    if its hash for the tree is low.  Both limits leave ``factor`` times the wanted rows (or all
    rows of a small table), so a tree that runs short is practically impossible;
    ``fit_forest`` checks it and doubles the factor.
    """
    wanted = n_trees * max_samples * factor
    row_hash = F.xxhash64(F.lit(seed), F.lit("pool"), F.col(schema.SEQ))
    pool = df.where(row_hash <= _hash_limit(min(1.0, wanted / max(rows, 1))))
    share = min(1.0, factor * max_samples / max(min(rows, wanted), 1))
    trees = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))
    pick = F.xxhash64(F.lit(seed), F.col("tree"), F.col(schema.SEQ))
    lowest = W.partitionBy("tree").orderBy("pick", schema.SEQ)
    return (
        pool.withColumn("tree", trees)
        .withColumn("pick", pick)
        .where(F.col("pick") <= _hash_limit(share))
        .withColumn("rank", F.row_number().over(lowest))
        .where(F.col("rank") <= max_samples)
    )


def _hash_limit(share: float) -> Column:
    """Upper bound that a ``share`` of all 64-bit hashes stays below."""
    return F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64)))


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    n_estimators: int = 100,
    max_samples: int | float | str = "auto",
    contamination: float | str = 0.01,
    random_state: int = 42,
) -> ForestModel:
    """Fit trees, then set the cut-off so that ``contamination`` of the rows lie below.

    ``max_samples`` is a number of rows, a part of all rows (above 0, up to 1.0, as a float), or "auto" for 256.
    """
    features = list(features)
    x = df.select(
        schema.SEQ, *[scalar.finite_or_zero(F.col(c), True).alias(c) for c in features]
    )
    rows, keyed = x.agg(F.count("*"), F.count(schema.SEQ)).first()
    if keyed < rows:
        raise ValueError(f"{rows - keyed} rows have no {schema.SEQ}; rows are picked by it")
    size = sample_size(max_samples, rows)
    depth = max(1, math.ceil(math.log2(max(size, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        if pdf[schema.SEQ].duplicated().any():
            raise ValueError(f"{schema.SEQ} is not unique; rows are picked by it")
        sample = pdf.sort_values(["pick", schema.SEQ])[features].to_numpy(np.float64)
        rng = np.random.default_rng([random_state, tree])
        nodes = _build_tree(sample, rng, depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "rows", "depth"])
        out.insert(0, "tree", tree)
        return out

    factor = POOL_FACTOR
    if size > GROUPED_SAMPLES:
        path = scratch_path(df.sparkSession, "forest-rows")
        x.write.parquet(path)
        x = df.sparkSession.read.parquet(path)
        nodes = levels.grow(
            x, features, n_estimators, size, random_state, depth, _build_tree, schema.SEQ, NODE_SCHEMA
        )
    while size <= GROUPED_SAMPLES:
        picked = sample_per_tree(x, rows, n_estimators, size, random_state, factor)
        nodes = picked.groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()
        nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
        full = (nodes.loc[nodes["node"] == 0, "rows"] == size).sum() == n_estimators
        if full or factor * size >= rows:  # nothing is left out by then
            break
        factor *= 2
    model = ForestModel(features, nodes, n_estimators, size)
    if contamination != "auto":
        scores = x.select(schema.SEQ, raw_score(x, model).alias("raw"))
        path = scratch_path(df.sparkSession, "forest-scores")
        scores.write.parquet(path)
        scores = df.sparkSession.read.parquet(path)
        model.offset = exact_quantile(scores, "raw", float(contamination))
        model.fitted = scores
    return model


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.nan_to_num(pdf.to_numpy(dtype=np.float64), nan=0.0)


def mean_path(x: np.ndarray, m: dict) -> np.ndarray:
    """Mean path length of every row over all trees, level by level."""
    n, width = x.shape
    flat = np.ascontiguousarray(x).ravel()
    base = np.arange(n) * width
    total = np.zeros(n)
    for feature, threshold, leaf in zip(m["feature"], m["threshold"], m["leaf"]):
        at = np.zeros(n, dtype=np.intp)
        for _ in range(m["depth"]):
            right = flat.take(base + feature.take(at)) > threshold.take(at)
            at = 2 * at + 1 + right
        total += leaf.take(at - len(feature))
    return total / len(m["feature"])


def decision(x: np.ndarray, m: dict) -> np.ndarray:
    """Score relative to the cut-off."""
    return -(2.0 ** (-mean_path(x, m) / m["scale"])) - m["offset"]


def raw_score(df: DataFrame, model: ForestModel, offset: float = 0.0) -> Column:
    """-2^(-mean path / expected path); close to -1 for isolated rows."""
    packed = {**model.packed(), "offset": offset}
    shared = df.sparkSession.sparkContext.broadcast(packed)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        m = shared.value
        for pdf in batches:
            yield pd.Series(decision(_matrix(pdf), m))

    return score(F.struct(*[F.col(c).cast("double") for c in model.features]))


def score_forest(df: DataFrame, model: ForestModel) -> DataFrame:
    """Adds anomaly_score (negative = anomalous), anomaly_label (-1 / 1), is_anomaly."""
    scored = df.withColumn("anomaly_score", raw_score(df, model, model.offset))
    return with_labels(scored)


def with_labels(scored: DataFrame) -> DataFrame:
    label = F.when(F.col("anomaly_score") < 0, -1).otherwise(1)
    scored = scored.withColumn("anomaly_label", label)
    return scored.withColumn("is_anomaly", scalar.label_to_flag(F.col("anomaly_label")))


def save_forest(spark: SparkSession, model: ForestModel, path: str) -> None:
    path = path.rstrip("/")
    spark.createDataFrame(model.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/trees"
    )
    meta = [(model.kind, model.features, model.n_trees, model.max_samples, model.offset)]
    names = "kind string, features array<string>, n_trees int, max_samples int, offset double"
    spark.createDataFrame(meta, names).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_forest(spark: SparkSession, path: str) -> ForestModel:
    path = path.rstrip("/")
    meta = spark.read.parquet(f"{path}/meta").first()
    nodes = spark.read.parquet(f"{path}/trees").toPandas()
    nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
    return ForestModel(
        list(meta["features"]), nodes, meta["n_trees"], meta["max_samples"], meta["offset"]
    )
