"""Sharding by a k-d tree over document metadata.

The box of all documents is split again and again at the weighted median along its widest
dimension, each median found by a distributed sort with running sums, until there is a leaf for
each ``target_bytes``. Weights are bytes, so shards are near equal in bytes.

Names become numbers by their dense rank among the distinct names of the table, so names of any length and with any
beginning in common have places of their own. What the tree knows of nodes is joined as a table of a row a node, so plans
do not grow with the number of shards.

The points of the tree are groups of equal texts, so copies stay together. A group heavier than
1/64 of a shard is first dealt into pieces by the hash of its rows, or no split could be even.

Defined cases: a null text has size 1 and is no different from other nulls; null metadata comes
first in its dimension; texts may be of any length; extra columns are ignored; empty tables give no rows; with fewer points
than shards some shards are empty.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctpulse.llm.tables import FILE, KEY, PART, ROW, join_facts, keep, running_sums

GRAIN = 64
#: Names of the rows, and the dimensions they become.
NAMES = {"_acct_n0": "_acct_d0", "_acct_n1": "_acct_d1"}
GROUP = ["size", "text_crc32", "_acct_hash"]
POINT = [*GROUP, "_acct_piece"]


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def text_crc32(text: Column) -> Column:
    """CRC-32 of the text's UTF-8 bytes; that of no bytes for null."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def name_ranks(names: DataFrame, name: str) -> DataFrame:
    """``name``, how many rows hold it (``_acct_rows``) and its dense rank; null has none."""
    distinct = names.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("_acct_rows"))
    return running_sums(distinct, [], [F.col(name)], {"_acct_rank": F.lit(1).cast("bigint")})


def with_places(points: DataFrame, names: dict[str, str]) -> DataFrame:
    """``points`` with a place for each name column: its rank, and -1 for null."""
    for name, place in names.items():
        ranks = keep(name_ranks(points, name), "name-ranks")
        ranked = join_facts(points, ranks, name, "_acct_rows").withColumn(
            place, F.coalesce(F.col("_acct_rank").cast("double"), F.lit(-1.0))
        )
        points = keep(ranked.drop(name, "_acct_rows", "_acct_rank"), "placed")
    return points


def light_rows(docs: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """What the tree needs of each row, without the text; ``docs`` has the row key."""
    text = F.col("text")
    return docs.select(
        *KEY, *extra,
        size_of(text).alias("size"),
        text_crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("_acct_hash"),
        F.col("source").cast("string").alias("_acct_n0"),
        F.col("lang").cast("string").alias("_acct_n1"),
        F.log2(size_of(text).cast("double")).alias("_acct_d2"),
    )


def _points(rows: DataFrame, dims: Sequence[str], n_shards: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``_acct_piece``, and the weighted points of the tree."""
    groups = rows.groupBy(*GROUP).agg(F.sum("size").alias("w"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    grain = max(1, total // (n_shards * GRAIN))
    heavy = groups.where(F.col("w") > grain)  # GRAIN * n_shards groups at most, for any input
    pieces = F.ceil(F.col("w") / F.lit(grain)).cast("bigint").alias("_acct_n")
    heavy = heavy.where(F.col("w") > F.col("size")).select(*GROUP, pieces)
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"heavy.{c}")) for c in GROUP]
    piece = F.coalesce(F.pmod(F.xxhash64(*[F.col(k) for k in KEY]), "_acct_n"), F.lit(0))
    rows = keep(
        rows.alias("rows")
        .join(F.broadcast(heavy).alias("heavy"), same[0] & same[1] & same[2], "left")
        .select("rows.*", piece.alias("_acct_piece")),
        "light-rows",
    )
    names = {n: d for n, d in NAMES.items() if d in dims}
    own = [d for d in dims if d not in names.values()]
    points = rows.groupBy(*POINT).agg(
        F.sum("size").alias("w"), *[F.min(d).alias(d) for d in [*own, *names]], F.lit(1).alias("node")
    )
    return rows, with_places(keep(points, "points"), names)


def _node_table(points: DataFrame, rows: list[tuple], columns: str) -> DataFrame:
    """What is known of nodes; a row each, so broadcast."""
    return F.broadcast(points.sparkSession.createDataFrame(rows, columns))


def _cuts(points: DataFrame, wanted: dict[int, float]) -> dict[int, dict]:
    """Per node the point after which ``wanted`` weight lies before, along ``_acct_x``."""
    order = ["_acct_x", *POINT]
    goals = _node_table(points, [(n, float(w)) for n, w in wanted.items()], "n int, goal double")
    dealt = keep(
        points.join(goals, F.col("node") == F.col("n")).drop("n")
        .repartitionByRange("node", *order)
        .withColumn(PART, F.spark_partition_id()),
        "ordered",
    )
    sums = dealt.groupBy("node", PART).agg(F.sum("w").alias("w")).collect()  # one per range
    at: dict[int, tuple[int, int]] = {}
    seen: dict[int, int] = {}
    for r in sorted(sums, key=lambda r: (r["node"], r[PART])):
        before = seen.get(r["node"], 0)
        seen[r["node"]] = before + r["w"]
        if r["node"] not in at and before + r["w"] >= wanted[r["node"]]:
            at[r["node"]] = (r[PART], before)
    begins = _node_table(
        points, [(n, part, before) for n, (part, before) in at.items()], "n int, hit int, start bigint"
    )
    inside = Window.partitionBy("node", PART).orderBy(*order)
    upto = F.col("start") + F.sum("w").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    near = dealt.join(begins, (F.col("node") == F.col("n")) & (F.col(PART) == F.col("hit")))
    near = near.withColumn("_acct_gap", F.abs(upto - F.col("goal")))
    best = near.groupBy("node").agg(
        F.min_by(F.struct(*order), F.struct("_acct_gap", *order)).alias("cut")
    )
    return {r["node"]: r["cut"].asDict() for r in best.collect()}


def kd_leaves(points: DataFrame, dims: Sequence[str], n_leaves: int) -> DataFrame:
    """Adds ``leaf``, 0 to n_leaves - 1, to weighted ``points`` in ``node`` 1; near equal in weight.

    Per level: ranges per node, one sort by range with sums per range, and one row per node that
    tells where to cut. The driver sees one row per node or range only.
    """
    spans = [F.struct(F.min(d).alias("a"), F.max(d).alias("b")).alias(d) for d in dims]
    box = points.agg(*spans).first()
    scale = {d: (box[d]["b"] or 0) - (box[d]["a"] or 0) for d in dims}
    nodes = {1: (0, n_leaves)}  # node: its first leaf and how many
    while any(n > 1 for _, n in nodes.values()):
        stats = points.groupBy("node").agg(F.sum("w").alias("w"), *spans).collect()
        widest, wanted = {}, {}
        for r in stats:
            if nodes[r["node"]][1] > 1:
                width = [(r[d]["b"] - r[d]["a"]) / scale[d] if scale[d] else 0.0 for d in dims]
                widest[r["node"]] = dims[width.index(max(width))]
                n = nodes[r["node"]][1]
                wanted[r["node"]] = r["w"] * (n // 2) / n
        if not wanted:
            break
        axes = _node_table(points, [(n, dims.index(d) + 1) for n, d in widest.items()], "n int, axis int")
        along = F.element_at(F.array(*[F.col(d).cast("double") for d in dims]), F.col("axis"))
        placed = points.join(axes, F.col("node") == F.col("n"), "left").withColumn("_acct_x", along)
        placed = placed.drop("n", "axis")
        cuts = _cuts(placed, wanted)
        order = ["_acct_x", *POINT]
        kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
        fields = ", ".join(f"c_{c} {kinds[c]}" for c in order)
        table = _node_table(points, [(n, *[c[k] for k in order]) for n, c in cuts.items()], f"n int, {fields}")
        here = F.struct(*order)
        there = F.struct(*[F.col(f"c_{c}").alias(c) for c in order])
        child = F.when(F.col("n").isNull(), F.col("node")).otherwise(
            F.col("node") * 2 + (here > there).cast("int")
        )
        points = keep(
            placed.join(table, F.col("node") == F.col("n"), "left").select(
                *POINT, "w", *dims, child.alias("node")
            ),
            "split",
        )
        for node in cuts:
            first, n = nodes.pop(node)
            nodes[node * 2] = (first, n // 2)
            nodes[node * 2 + 1] = (first + n // 2, n - n // 2)
        nodes = {k: v if k in cuts or k // 2 in cuts else (v[0], 1) for k, v in nodes.items()}
    firsts = _node_table(points, [(node, first) for node, (first, _) in nodes.items()], "n int, leaf int")
    return points.join(firsts, F.col("node") == F.col("n"), "left").drop("n")


def kd_shards(
    rows: DataFrame,
    n_shards: int | None = None,
    target_bytes: int | None = None,
    dims: Sequence[str] = ("_acct_d0", "_acct_d1", "_acct_d2"),
) -> DataFrame:
    """``rows`` (see ``light_rows``) with ``shard`` and ``slot``, gapless within a shard.

    Give the number of shards, or the bytes that a shard should have.
    """
    rows = keep(rows, "rows-to-shard")
    if n_shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        n_shards = max(1, math.ceil(total / target_bytes))
    columns = rows.columns
    rows, points = _points(rows, dims, n_shards)
    leaves = kd_leaves(points, dims, n_shards)
    same = F.lit(True)
    for c in POINT:
        same &= F.col(f"rows.{c}").eqNullSafe(F.col(f"points.{c}"))
    sharded = (
        rows.alias("rows")
        .join(leaves.alias("points"), same)
        .select(*[F.col(f"rows.{c}") for c in columns], F.col("points.leaf").alias("shard"))
    )
    # By the text before the place, which another run's files may change.
    order = [*[F.col(c) for c in GROUP], F.col(FILE), F.col(ROW)]
    if "doc_id" in columns:
        order.insert(0, F.col("doc_id"))
    numbered = running_sums(sharded, ["shard"], order, {"slot": F.lit(1).cast("bigint")})
    return numbered.withColumn("slot", F.col("slot") - 1)
