"""Signed feature contributions to a row's mean path length.

Path-dependent Shapley values (Lundberg et al. 2020): a feature that is left out
sends a row down both branches in proportion to the training rows.  For one leaf
with the distinct features F on its path, let ``o`` be 1 where the row satisfies
the leaf's interval of a feature and ``z`` the training share that does.  The
Shapley weight s!(d-1-s)!/d! is the integral of t^s (1-t)^(d-1-s), so the
contribution of feature j is

    value * (o_j - z_j) * integral over [0, 1] of prod_{k != j} (o_k t + z_k (1 - t))

a polynomial of degree d - 1, which Gauss-Legendre nodes integrate exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctpulse.models.forest import (
    ForestModel,
    _matrix,
    average_path,
    decision,
    raw_score,
    with_labels,
)

CONTRIBUTION_TYPE = "array<struct<name:string,value:double>>"
ROWS_AT_ONCE = 16


def leaf_boxes(model: ForestModel) -> list[dict[str, np.ndarray]]:
    """Leaves grouped by their number of distinct features.

    Per group: value [L], and for each path feature its index, interval and
    training share [L, d].
    """
    groups: dict[int, list[tuple]] = {}
    for tree, nodes in model.nodes.groupby("tree"):
        table = {r.node: r for r in nodes.itertuples()}
        todo = [(0, {})]
        while todo:
            node, path = todo.pop()
            r = table[node]
            if r.feature < 0:
                value = r.depth + float(average_path(r.rows))
                groups.setdefault(len(path), []).append((value, path))
                continue
            low, high, share = path.get(r.feature, (-np.inf, np.inf, 1.0))
            left, right = table[2 * node + 1], table[2 * node + 2]
            cut = r.threshold
            todo.append(
                (left.node, {**path, r.feature: (low, min(high, cut), share * left.rows / r.rows)})
            )
            todo.append(
                (right.node, {**path, r.feature: (max(low, cut), high, share * right.rows / r.rows)})
            )
    out = []
    for d, leaves in sorted(groups.items()):
        box = np.array([list(p.values()) for _, p in leaves], dtype=np.float64).reshape(-1, d, 3)
        out.append(
            {
                "value": np.array([v for v, _ in leaves]) / model.n_trees,
                "feature": np.array([list(p) for _, p in leaves], dtype=np.intp).reshape(-1, d),
                "low": box[..., 0],
                "high": box[..., 1],
                "share": box[..., 2],
            }
        )
    return out


def base_value(groups: list[dict[str, np.ndarray]]) -> float:
    """Expected mean path length over the training samples."""
    return float(sum((g["value"] * g["share"].prod(axis=1)).sum() for g in groups))


def contributions(x: np.ndarray, groups: list[dict[str, np.ndarray]], width: int) -> np.ndarray:
    """[rows, features]; a row's values sum to its mean path length minus the base.

    With o_j = 1 the part (o_j - z_j) / (o_j t + z_j (1 - t)) of the integrand is (1 - z_j) / (t + z_j (1 - t)), else
    -1 / (1 - t), which is the same for all features: so whole arrays of (row, leaf) are only multiplied and added.
    """
    out = np.zeros((len(x), width))
    for g in groups:
        d = g["feature"].shape[1]
        if d == 0:
            continue
        feature, low, high, share = (np.ascontiguousarray(g[c].T) for c in ("feature", "low", "high", "share"))
        points, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
        steps = []
        for t, w in zip((points + 1) / 2, weights / 2):
            beside = -1 / (1 - t)
            steps.append((t, w * g["value"], share * (1 - t), beside, (1 - share) / (t + share * (1 - t)) - beside))
        cells = feature[:, None, :] + width * np.arange(ROWS_AT_ONCE)[None, :, None]
        for start in range(0, len(x), ROWS_AT_ONCE):
            part = x[start : start + ROWS_AT_ONCE]
            shape = (len(part), feature.shape[1])
            inside = np.empty((d, *shape))
            for k in range(d):
                v = part.take(feature[k], axis=1)
                np.logical_and(v > low[k], v <= high[k], out=inside[k], casting="unsafe")
            phi, rest, factor = np.zeros((d, *shape)), np.zeros(shape), np.empty(shape)
            for t, value, outside, beside, more in steps:
                product = np.repeat(value[None, :], len(part), axis=0)
                for k in range(d):
                    np.multiply(inside[k], t, out=factor)
                    factor += outside[k]
                    product *= factor
                for k in range(d):
                    np.multiply(product, more[k], out=factor)
                    phi[k] += factor
                product *= beside
                rest += product
            phi *= inside
            phi += rest
            sums = np.bincount(cells[:, : len(part)].ravel(), phi.ravel(), minlength=len(part) * width)
            out[start : start + len(part)] += sums.reshape(len(part), width)
    return out


def with_contributions(
    df: DataFrame, model: ForestModel, flagged_only: bool, name: str = "contributions"
) -> DataFrame:
    """Score, label, flag and contributions in one pass over the features.

    With ``flagged_only`` the contributions are computed for anomalous rows and
    null for the others, so their cost follows the number of anomalies.  Without, scores and contributions are functions
    of their own, so Spark leaves out the costly contributions where nobody reads them.
    """
    names = list(model.features)
    if not flagged_only:
        return with_labels(
            df.withColumns({"anomaly_score": raw_score(df, model, model.offset), name: _all_contributions(df, model)})
        )
    shared = df.sparkSession.sparkContext.broadcast((model.packed(), leaf_boxes(model)))

    @F.pandas_udf("struct<score:double,contributions:array<double>>")
    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed, groups = shared.value
        for pdf in batches:
            x = _matrix(pdf)
            score = decision(x, packed)
            wanted = np.flatnonzero(score < 0) if flagged_only else np.arange(len(x))
            out = np.empty(len(x), dtype=object)
            for at, row in zip(wanted, contributions(x[wanted], groups, len(names))):
                out[at] = row
            yield pd.DataFrame({"score": score, "contributions": out})

    result = evaluate(F.struct(*[F.col(c).cast("double") for c in names]))
    scored = df.withColumn("_result", result).withColumns(
        {"anomaly_score": F.col("_result.score"), name: _named(names, F.col("_result.contributions"))}
    )
    return with_labels(scored.drop("_result"))


def _named(names: list[str], values: Column) -> Column:
    return F.zip_with(
        F.array(*[F.lit(n) for n in names]), values, lambda n, v: F.struct(n.alias("name"), v.alias("value"))
    )


def _all_contributions(df: DataFrame, model: ForestModel) -> Column:
    """Every row's contributions."""
    names = list(model.features)
    shared = df.sparkSession.sparkContext.broadcast(leaf_boxes(model))

    @F.pandas_udf("array<double>")
    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for pdf in batches:
            yield pd.Series(list(contributions(_matrix(pdf), shared.value, len(names))), dtype=object)

    return _named(names, explain(F.struct(*[F.col(c).cast("double") for c in names])))


def topn_contributions(contribs: Column, n: int = 5) -> Column:
    """Largest by absolute value, signed, rounded to 4; ties by name."""

    def before(a: Column, b: Column) -> Column:
        da, db = F.abs(a["value"]), F.abs(b["value"])
        return (
            F.when(da > db, -1)
            .when(da < db, 1)
            .when(a["name"] < b["name"], -1)
            .when(a["name"] > b["name"], 1)
            .otherwise(0)
        )

    top = F.slice(F.array_sort(contribs, before), 1, n)
    return F.transform(
        top, lambda c: F.struct(c["name"].alias("name"), F.round(c["value"], 4).alias("value"))
    )


def topn_names(top: Column) -> Column:
    return F.transform(top, lambda c: c["name"])


def first_contributions(top: Column, n: int = 3) -> Column:
    """The chips of the feed."""
    return F.slice(top, 1, n)


def as_map(top: Column) -> Column:
    return F.map_from_entries(top)


def score_and_explain(
    df: DataFrame, model: ForestModel, n: int = 5, flagged_only: bool = True
) -> DataFrame:
    """Scored rows with ``top_features``, the ``n`` strongest contributions."""
    full = with_contributions(df, model, flagged_only, "_all")
    return full.withColumn("top_features", topn_contributions(F.col("_all"), n)).drop("_all")
