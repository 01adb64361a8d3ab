"""Local outlier factor (Breunig et al. 2000) in novelty mode.

The model is the whole training table with each row's k-distance and local
reachability density.  Equal rows are stored once with a count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctpulse import schema
from acctpulse.functions import scalar
from acctpulse.models import knn
from acctpulse.models.forest import with_labels
from acctpulse.operators.quantile import exact_quantile
from acctpulse.session import cut_lineage, scratch_path

# Keeps the density of exact copies finite.
TINY = 1e-10


@dataclass
class LofModel:
    features: list[str]
    refs: DataFrame  # rid, copies, v, cell, kdist, lrd
    index: knn.PivotIndex
    center: list[float]
    width: list[float]
    k: int
    rows: int  # distinct training rows
    offset: float = -1.5
    near: DataFrame | None = None  # the training rows' neighbours, after a fit whose rows have ids of their own

    kind = "LocalOutlierFactor"


def scaling(df: DataFrame, features: Sequence[str], scale: bool) -> tuple[list, list]:
    """Shift and width per feature; 0 and 1 unless ``scale`` is set."""
    if not scale:
        return [0.0] * len(features), [1.0] * len(features)
    stats = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)],
    ).first()
    n = len(features)
    return [stats[i] for i in range(n)], [stats[n + i] or 1.0 for i in range(n)]


def scaled(df: DataFrame, features, center, width, infinities: bool = False) -> DataFrame:
    return df.withColumns(
        {
            c: (scalar.finite_or_zero(F.col(c), infinities) - F.lit(float(m))) / F.lit(float(s))
            for c, m, s in zip(features, center, width)
        }
    )


def vectors(df: DataFrame, features, center, width, infinities: bool = False) -> DataFrame:
    """Each row's seq and its scaled features as ``v``."""
    x = scaled(df.select(schema.SEQ, *features), features, center, width, infinities)
    return x.select(schema.SEQ, F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("v"))


def _density(hits: DataFrame, kdist: DataFrame) -> DataFrame:
    """Local reachability density per query."""
    reach = F.greatest("dist", "kdist")
    mean = F.sum(reach * F.col("copies")) / F.sum("copies")
    return (
        hits.join(kdist, "rid").groupBy("qid").agg((1.0 / (mean + F.lit(TINY))).alias("lrd"))
    )


def _factor(hits: DataFrame, densities: DataFrame, own: DataFrame) -> DataFrame:
    """Negative outlier factor per query: -(mean density of neighbours / own density)."""
    mean = F.sum(F.col("lrd") * F.col("copies")) / F.sum("copies")
    return (
        hits.join(densities, "rid")
        .groupBy("qid")
        .agg(mean.alias("around"))
        .join(own, "qid")
        .select("qid", "lrd", (-F.col("around") / F.col("lrd")).alias("raw"))
    )


def fit_lof(
    df: DataFrame,
    features: Sequence[str],
    n_neighbors: int = 20,
    contamination: float | str = 0.01,
    novelty: bool = True,
    scale: bool = False,
    visits: list | None = None,
) -> LofModel:
    """Neighbours, k-distance and density of every training row.

    ``visits`` receives the numbers of (row, cell) pairs that the search visited, a number a round.
    """
    if not novelty:
        raise ValueError("only novelty=True can score new rows")
    features = list(features)
    center, width = scaling(df, features, scale)
    x = vectors(df, features, center, width, True)
    unique = cut_lineage(
        x.groupBy("v").agg(F.min(schema.SEQ).cast("bigint").alias("rid"), F.count("*").alias("copies"))
    )
    n_unique, rows, ids = unique.agg(F.count("*"), F.sum("copies"), F.count_distinct("rid")).first()
    k = max(1, min(n_neighbors, (rows or 0) - 1))
    refs, index = knn.build_index(unique, n_unique)
    queries = refs.select(F.col("rid").alias("qid"), "v")
    hits = knn.neighbours(queries, refs, index, k, self_free=True, visits=visits)
    kdist = hits.groupBy("qid").agg(F.max("dist").alias("kdist"))
    kdist = kdist.withColumnRenamed("qid", "rid")
    lrd = cut_lineage(_density(hits, kdist))
    trained = refs.join(kdist, "rid").join(lrd.withColumnRenamed("qid", "rid"), "rid")
    path = scratch_path(df.sparkSession, "lof")
    trained.write.parquet(path)
    trained = df.sparkSession.read.parquet(path)
    model = LofModel(features, trained, index, center, width, k, n_unique)
    if ids == n_unique:
        model.near = hits
    if contamination != "auto":
        raw = _factor(hits, trained.select("rid", "lrd"), lrd).join(
            trained.select(F.col("rid").alias("qid"), "copies"), "qid"
        )
        raw = cut_lineage(raw.select("raw", "copies"))
        model.offset = exact_quantile(raw, "raw", float(contamination), "copies")
    return model


def score_lof(df: DataFrame, model: LofModel) -> DataFrame:
    """Adds score, label and flag to every row (keyed by seq).

    Rows equal to a training row take their neighbours from the fit; all others are searched for, as are all with a
    loaded model.
    """
    queries = vectors(df, model.features, model.center, model.width)
    queries = cut_lineage(queries.select(F.col(schema.SEQ).cast("bigint").alias("qid"), "v"))
    hits = knn.neighbours(queries, model.refs, model.index, model.k, known=model.near)
    own = _density(hits, model.refs.select("rid", "kdist"))
    raw = _factor(hits, model.refs.select("rid", "lrd"), own).select(
        F.col("qid").alias(schema.SEQ), (F.col("raw") - F.lit(model.offset)).alias("anomaly_score")
    )
    return with_labels(df.join(raw, schema.SEQ))


CELL_SCHEMA = (
    "cell int, center array<double>, low array<double>, high array<double>, far double, "
    "`rows` bigint, pivot int"
)


def save_lof(spark: SparkSession, model: LofModel, path: str) -> None:
    path = path.rstrip("/")
    model.refs.write.mode("overwrite").parquet(f"{path}/refs")
    index = model.index
    place = {int(c): i for i, c in enumerate(index.pivots)}
    cells = [
        (i, index.centers[i].tolist(), index.low[i].tolist(), index.high[i].tolist(), float(index.far[i]),
         int(index.rows[i]), place.get(i))
        for i in range(len(index.centers))
    ]
    spark.createDataFrame(cells, CELL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    meta = [(model.kind, model.features, model.center, model.width, model.k, model.rows, model.offset)]
    names = (
        "kind string, features array<string>, center array<double>, width array<double>, k int, "
        "`rows` bigint, offset double"
    )
    spark.createDataFrame(meta, names).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_lof(spark: SparkSession, path: str) -> LofModel:
    path = path.rstrip("/")
    meta = spark.read.parquet(f"{path}/meta").first().asDict()
    meta.pop("kind")
    cells = spark.read.parquet(f"{path}/cells").toPandas().sort_values("cell")
    pivots = cells.dropna(subset=["pivot"]).sort_values("pivot")["cell"].to_numpy()
    index = knn.PivotIndex(
        knn.matrix(cells["center"]), pivots, knn.matrix(cells["low"]), knn.matrix(cells["high"]),
        cells["far"].to_numpy(), cells["rows"].to_numpy(),
    )
    return LofModel(refs=spark.read.parquet(f"{path}/refs"), index=index, **meta)
