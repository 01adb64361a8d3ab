"""One-class SVM with an RBF kernel, approximated by random Fourier features.

Rahimi and Recht (2007): cos(w x + b) with Gaussian w approximates the kernel, so
the machine becomes linear.  Its dual is the shortest weighted mean ``w`` of the mapped
rows in which no row weighs more than 1/(nu n).  Where ``w`` stands, the best mean to move to is that of the
``nu`` share of rows with the lowest margin (Frank-Wolfe); the driver then takes the shortest vector
among all means found so far, a problem of a few numbers.

A step is one pass that returns sums of mapped rows for bins of margins and a histogram of all margins.  The bins lie
where the step before expects the cut; rows of the bin that holds it count in part.  So a step needs neither
margins written nor a second pass for their quantile, and a cut outside the bins only makes that step coarser.  The
squared length is within ``gap`` of the best, which each pass proves for the vector that it started from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.models.forest import _matrix, with_labels
from acctpulse.models.lof import scaled, scaling
from acctpulse.operators.quantile import exact_quantile
from acctpulse.session import scratch_path


@dataclass
class OcsvmModel:
    features: list[str]
    weights: list[float]
    gamma: float
    center: list[float]
    width: list[float]
    seed: int
    offset: float = 0.0
    #: How far the squared length of the weights may be above the least one.
    gap: float = 0.0

    kind = "OneClassSVM"


def fourier_map(n_features: int, n_components: int, gamma: float, seed: int):
    """Frequencies and phases; repeatable from the seed."""
    rng = np.random.default_rng(seed)
    w = rng.normal(scale=np.sqrt(2.0 * gamma), size=(n_features, n_components))
    return w, rng.uniform(0.0, 2.0 * np.pi, n_components)


def mapped(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(2.0 / len(b)) * np.cos(x @ w + b)


def nearly_mapped(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As ``mapped``, but for cosines of seven digits, which take a tenth of the time; for the passes of a fit.

    Angles are brought near zero in full precision first, so large ones lose nothing.
    """
    out = np.empty((len(x), len(b)))
    for i in range(0, len(x), 256):
        angle = x[i : i + 256] @ w
        angle += b
        angle -= np.rint(angle * (0.5 / np.pi)) * (2 * np.pi)
        out[i : i + 256] = np.cos(angle.astype(np.float32))
    out *= np.sqrt(2.0 / len(b))
    return out


def scale_gamma(x: DataFrame, features: Sequence[str]) -> float:
    """1 / (number of features * variance of all values)."""
    stats = x.agg(
        *[F.avg(c) for c in features], *[F.var_pop(c) for c in features]
    ).first()
    n = len(features)
    means, variances = np.array(stats[:n]), np.array(stats[n:])
    total = float(np.mean(variances) + np.var(means))
    return 1.0 / (n * total) if total > 0 else 1.0


BINS, FINE = 32, 512


def _step(x: DataFrame, model: OcsvmModel, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and sums of mapped rows of each bin of margins, and a histogram of the margins' whole range."""
    features, weights = model.features, np.array(model.weights)
    n_components, gamma, seed = len(weights), model.gamma, model.seed
    span = _span(weights)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, b = fourier_map(len(features), n_components, gamma, seed)
        sums = np.zeros((len(edges) + 1, n_components + 1))
        fine = np.zeros(FINE)
        for pdf in batches:
            z = nearly_mapped(_matrix(pdf[features]), w, b)
            margin = z @ weights
            fine += np.bincount(_fine(margin, span), minlength=FINE)
            place = np.searchsorted(edges, margin)
            # Sums of the low bins one by one; what is left is the last.
            for at in np.unique(place[place < len(edges)]):
                own = place == at
                sums[at, :-1] += z[own].sum(axis=0)
                sums[at, -1] += own.sum()
            last = place == len(edges)
            sums[-1, :-1] += z.sum(axis=0) - z[~last].sum(axis=0)
            sums[-1, -1] += last.sum()
        value = np.concatenate([sums.ravel(), fine])
        at = np.flatnonzero(value)
        yield pd.DataFrame({"at": at, "value": value[at]})

    sums = x.select(*features).mapInPandas(partial, "at bigint, value double").groupBy("at")
    told = sums.agg(F.sum("value").alias("value")).toPandas()
    size = (len(edges) + 1) * (n_components + 1)
    value = np.zeros(size + FINE)
    value[told["at"].to_numpy()] = told["value"].to_numpy()
    table = value[:size].reshape(len(edges) + 1, -1)
    return table[:, -1], table[:, :-1], value[size:]


def _span(weights: np.ndarray) -> float:
    """No margin is larger: a mapped row is no longer than the root of 2."""
    return float(np.sqrt(2.0) * np.linalg.norm(weights)) or 1.0


def _fine(margin: np.ndarray, span: float) -> np.ndarray:
    return np.clip(((margin / span + 1) * (FINE / 2)).astype(np.int64), 0, FINE - 1)


def _edges(fine: np.ndarray, span: float, wanted: float, shrink: float) -> np.ndarray:
    """Borders of bins around the ``wanted`` lowest rows, finest there; margins have shrunk by about ``shrink`` since."""
    ranks = wanted * np.geomspace(1 / 16, 16, BINS - 1)
    upto = np.concatenate([[0], np.cumsum(fine)])
    borders = np.linspace(-span, span, FINE + 1)
    return np.unique(np.interp(ranks, upto, borders) * shrink)


def _shortest(points: np.ndarray) -> np.ndarray:
    """Weights of the shortest mean of a few vectors, by moving weight from the worst to the best of them."""
    gram = points @ points.T
    share = np.zeros(len(points))
    share[int(np.argmin(np.diag(gram)))] = 1.0
    for _ in range(20_000):
        slope = gram @ share
        to = int(slope.argmin())
        held = np.where(share > 0, slope, -np.inf)
        away = int(held.argmax())
        if held[away] - slope[to] < 1e-14 * max(gram[0, 0], 1e-300):
            break
        curve = gram[to, to] - 2 * gram[to, away] + gram[away, away]
        step = min(share[away], (slope[away] - slope[to]) / max(curve, 1e-300))
        share[to], share[away] = share[to] + step, share[away] - step
    return share


def fit_ocsvm(
    df: DataFrame,
    features: Sequence[str],
    kernel: str = "rbf",
    nu: float = 0.01,
    gamma: float | str = "scale",
    n_components: int = 256,
    steps: int = 16,
    seed: int = 42,
    scale: bool = False,
    tolerance: float = 0.02,
) -> OcsvmModel:
    """At most ``steps`` passes, fewer once the squared length is within ``tolerance`` of itself of the best."""
    if kernel != "rbf":
        raise ValueError("only the rbf kernel is supported")
    features = list(features)
    center, width = scaling(df, features, scale)
    path = scratch_path(df.sparkSession, "ocsvm")
    scaled(df.select(schema.SEQ, *features), features, center, width, True).write.parquet(path)
    x = df.sparkSession.read.parquet(path)
    g = scale_gamma(x, features) if gamma == "scale" else float(gamma)
    model = OcsvmModel(features, [0.0] * n_components, g, center, width, seed)
    # Without weights every margin is 0: the pass returns the mean of all rows.
    rows, sums, _ = _step(x, model, np.array([-1.0]))
    n = rows.sum()
    wanted = nu * n
    points = [sums.sum(axis=0) / max(n, 1)]
    weights = points[0]
    edges = np.linspace(-1, 1, BINS - 1) * _span(weights)
    for _ in range(steps if n else 0):
        model.weights = weights.tolist()
        rows, sums, fine = _step(x, model, edges)
        # Whole bins from the lowest up, and a part of the one that holds the cut.
        part = np.clip((wanted - (np.cumsum(rows) - rows)) / np.maximum(rows, 1), 0, 1)
        points.append((part[:, None] * sums).sum(axis=0) / wanted)
        # No mean has a lower margin than this: rows of the cut bin may all lie at its lower border.
        borders = np.concatenate([[-_span(weights)], edges])
        lowest = np.where(part == 1, sums @ weights, part * rows * borders).sum() / wanted
        model.gap = max(0.0, float(2 * (weights @ weights - lowest)))
        if model.gap <= tolerance * float(weights @ weights):
            break
        before, span = weights, _span(weights)
        kept = np.stack(points)
        weights = _shortest(kept) @ kept
        edges = _edges(fine, span, wanted, float(weights @ before / (before @ before)))
    model.weights = weights.tolist()
    margins = scratch_path(df.sparkSession, "ocsvm-margins")
    x.select(_margin(x, model).alias("margin")).write.parquet(margins)
    model.offset = exact_quantile(df.sparkSession.read.parquet(margins), "margin", nu)
    return model


def _margin(df: DataFrame, model: OcsvmModel) -> Column:
    n = len(model.features)
    w, b = fourier_map(n, len(model.weights), model.gamma, model.seed)
    weights = np.array(model.weights)
    shared = df.sparkSession.sparkContext.broadcast((w, b, weights))

    @F.pandas_udf("double")
    def margin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        w, b, weights = shared.value
        for pdf in batches:
            yield pd.Series(mapped(_matrix(pdf), w, b) @ weights)

    return margin(F.struct(*[F.col(c).cast("double") for c in model.features]))


def score_ocsvm(df: DataFrame, model: OcsvmModel) -> DataFrame:
    """Adds score (margin minus offset; negative = outside), label and flag."""
    raw = [f"_x{i}" for i in range(len(model.features))]
    x = df.withColumns({r: F.col(c) for r, c in zip(raw, model.features)})
    x = scaled(x, raw, model.center, model.width)
    inner = OcsvmModel(
        raw, model.weights, model.gamma, model.center, model.width, model.seed, model.offset
    )
    scored = x.withColumn("anomaly_score", _margin(x, inner) - F.lit(model.offset)).drop(*raw)
    return with_labels(scored)


def save_ocsvm(spark: SparkSession, model: OcsvmModel, path: str) -> None:
    meta = [
        (
            model.kind, model.features, model.weights, model.gamma, model.center, model.width,
            model.seed, model.offset, model.gap,
        )
    ]
    names = (
        "kind string, features array<string>, weights array<double>, gamma double, "
        "center array<double>, width array<double>, seed int, offset double, gap double"
    )
    target = f"{path.rstrip('/')}/meta"
    spark.createDataFrame(meta, names).coalesce(1).write.mode("overwrite").parquet(target)


def load_ocsvm(spark: SparkSession, path: str) -> OcsvmModel:
    meta = spark.read.parquet(f"{path.rstrip('/')}/meta").first().asDict()
    meta.pop("kind")
    return OcsvmModel(**meta)
