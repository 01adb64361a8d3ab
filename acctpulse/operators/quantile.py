"""Exact quantile of a column in two reads, without sorting or gathering it."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctpulse.session import cut_lineage

#: Size of a sketch; its ranks are off by about 1.5 / size of all rows, seldom by twice that.
SKETCH_SIZE = 4096
RANK_ERROR = 4 / SKETCH_SIZE
#: Ranks at which a sketch is asked.
STEPS = 2048
# No more distinct values than this are gathered.
GATHER_ROWS = 10_000


def exact_quantile(df: DataFrame, column: str, q: float, weight: str | None = None) -> float | None:
    """Quantile with linear interpolation between the two neighbouring values; null and NaN do not count.

    ``weight`` names a column of whole numbers that tells how often a row counts; without it each counts once.

    The first read fills mergeable sketches (KLL), which tell between which two values the
    wanted ranks lie.  The second counts what lies below exactly and keeps the distinct values
    between, some thousandths of all, each with its number; on these it goes on in the same way
    until few are left.  A sketch may err; then the counts show it and the rows are read again with wider borders.
    The result is exact in any case.  A weight's binary digits go to one sketch each, so a
    heavy row is as cheap as a light one.  ``df`` is read as often, so pass a written table.
    """
    count = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    data = df.select(F.col(column).cast("double").alias("v"), count.alias("w"))
    data = data.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.col("w") > 0))
    total, sketched = _sketched(data, weight is None)
    if not total:
        return None
    rank = q * (total - 1)
    below = math.floor(rank)
    wanted = [below, below + (rank > below)]
    first, second = _values_at(data, wanted, total, sketched)
    return first if first == second else first + (second - first) * (rank - below)


def _sketched(data: DataFrame, single: bool) -> tuple[int, list]:
    """Total weight, and per binary digit of the weights (digit, rows, values at equal steps of rank)."""
    held = F.expr("explode(filter(sequence(0, 62), b -> (shiftright(w, b) & 1) = 1))")
    digits = data.select("v", (F.lit(0) if single else held).alias("digit"))
    # Asked at the middles of STEPS equal parts, so that each value stands for one part.
    ranks = F.array(*[F.lit((i + 0.5) / STEPS) for i in range(STEPS)])
    rows = (
        digits.groupBy("digit")
        .agg(F.count("*").alias("n"), F.kll_sketch_agg_double("v", SKETCH_SIZE).alias("sketch"))
        .select("digit", "n", F.kll_sketch_get_quantile_double("sketch", ranks).alias("values"))
        .collect()
    )
    return sum(r["n"] << r["digit"] for r in rows), rows


def _borders(sketched: list, wanted: list[int], total: int, slack: float) -> tuple[float, float]:
    """Two values between which the wanted ranks lie, if the sketches are right."""
    values = np.concatenate([r["values"] for r in sketched])
    parts = np.concatenate([np.full(STEPS, (r["n"] << r["digit"]) / STEPS) for r in sketched])
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(parts[order])
    margin = total * (slack + 1 / STEPS) + 1
    low = int(np.searchsorted(upto, wanted[0] - margin, side="right")) - 1
    high = int(np.searchsorted(upto, wanted[1] + 1 + margin, side="left")) + 1
    ordered = values[order]
    return (
        -math.inf if low < 0 else float(ordered[low]),
        math.inf if high >= len(ordered) else float(ordered[high]),
    )


def _values_at(data: DataFrame, wanted: list[int], total: int, sketched: list) -> list[float]:
    """The values at 0-based ranks that are equal or neighbours."""
    slack = RANK_ERROR
    while True:
        low, high = _borders(sketched, wanted, total, slack)
        v = F.col("v")
        side = F.when(v < low, -1).when(v > high, 1).otherwise(0)
        counted = cut_lineage(
            data.groupBy(side.alias("side"), F.when(side == 0, v).alias("v")).agg(F.sum("w").alias("w"))
        )
        told = counted.groupBy("side").agg(F.sum("w").alias("w"), F.count("*").alias("n")).collect()
        weight = {r["side"]: r["w"] for r in told}
        inside, under = weight.get(0, 0), weight.get(-1, 0)
        if under <= wanted[0] and wanted[1] < under + inside:
            break
        slack *= 8
    left = counted.where("side = 0").select("v", "w")
    wanted = [r - under for r in wanted]
    if next(r["n"] for r in told if r["side"] == 0) > GATHER_ROWS:
        return _values_at(left, wanted, inside, _sketched(left, False)[1])
    rows = sorted((r["v"], r["w"]) for r in left.collect())
    upto = np.cumsum([w for _, w in rows])
    return [rows[int(np.searchsorted(upto, r, side="right"))][0] for r in wanted]
