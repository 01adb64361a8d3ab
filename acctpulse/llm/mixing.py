"""Mixing sources to target weights by entropy balancing.

For each source the document rates closest to 1 in relative entropy are sought whose words meet
the source's target. They are tilted exponentially, rate = min(3, exp(dual * size / mean size)), and
the dual variable solves a convex problem: Newton steps, each one aggregation over the
counts of documents by source and size. Rates are then rounded to whole copies along the
documents of a source in order of size, which keeps the words taken within half of the largest
document of the source's target; of 32 starting points for the rounding the closest is taken.

Defined cases: a null source is a source of its own, the last. A text that is null or without
words has size 0 and is neither dropped nor repeated. Documents with the same content are
rounded one after the other, as different documents are. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctpulse.llm.tables import FILE, KEY, ROW, keep, running_sums
from acctpulse.operators.reports import arrival_index

SPACE = r"[^\x20\x09-\x0D]+"
MOST = 3
BITS = 20
UNIT = 1 << BITS  # rates are counted in this part of 1, so that sums are exact and reruns agree
STARTS = 32
MAX_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """Per source: ``source``, ``source_size``, ``target``; weights 1, 2, 3 in the order of names.

    Targets share all words by weight; those above ``most`` times their source's size stop there
    and the excess goes to the others, until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = totals.withColumn("_acct_name", F.struct(F.col("source").isNull(), F.col("source")))
    placed = keep(arrival_index(named, "_acct_name", "_acct_n"), "sources").select(
        "source", "source_size", ((F.col("_acct_n") - 1) % 3 + 1).alias("weight")
    )
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.lit(most) * F.col("source_size") <= F.col("weight") * F.lit(level)
        if capped < 0:
            full = F.lit(False)
        row = placed.agg(
            F.count_if(full).alias("capped"),
            F.sum(F.when(full, F.col("source_size") * most).otherwise(0)).alias("taken"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row["capped"] == capped or not row["weight"]:
            break
        capped, level = row["capped"], (total - row["taken"]) / row["weight"]
    target = F.least(
        (F.col("source_size") * most).cast("double"), F.col("weight") * F.lit(float(level))
    )
    return placed.select("source", "source_size", target.alias("target"))


def solve_duals(cells: DataFrame, goal: DataFrame, most: int = MOST, rounds: int = 80) -> DataFrame:
    """The dual variable of each source: ``source``, ``dual``, ``mean``.

    ``cells`` counts documents by source and size. The driver holds one dual per
    constraint (``MAX_SOURCES`` at most); each Newton step is one aggregation over the cells. A step
    that leaves the bracket known so far is replaced by halving it.
    """
    spark = cells.sparkSession
    rows = goal.where(F.col("source_size") > 0).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; give coarser ones")
    counts = {r["source"]: r["n"] for r in cells.where(F.col("size") > 0).groupBy("source").agg(
        F.sum("n").alias("n")).collect()}
    state = {
        r["source"]: {"mean": r["source_size"] / counts[r["source"]], "dual": 0.0, "low": None,
                      "high": None, "target": r["target"], "open": True}
        for r in rows
    }
    schema = "s string, dual double, mean double"

    def table():
        return spark.createDataFrame([(k, v["dual"], v["mean"]) for k, v in state.items()], schema)

    if not state:
        return spark.createDataFrame([], schema).withColumnRenamed("s", "source")
    raw = F.col("dual") * F.col("size") / F.col("mean")
    free = raw < F.log(F.lit(float(most)))
    rate = F.when(free, F.exp(raw)).otherwise(F.lit(float(most)))
    words = F.col("n") * F.col("size") * rate
    slope = F.when(free, words * F.col("size") / F.col("mean")).otherwise(F.lit(0.0))
    exact = "decimal(38,8)"  # sums of decimals don't depend on their order
    for _ in range(rounds):
        sums = (
            cells.where(F.col("size") > 0)
            .join(table(), F.col("source").eqNullSafe(F.col("s")))
            .groupBy("source")
            .agg(F.sum(words.cast("decimal(28,8)")).cast(exact).alias("words"),
                 F.sum(slope.cast("decimal(28,8)")).cast(exact).alias("slope"))
            .collect()
        )
        for r in sums:
            s = state[r["source"]]
            gap = s["target"] - float(r["words"])
            if abs(gap) <= 1e-9 * s["target"]:
                s["open"] = False
                continue
            s["low" if gap > 0 else "high"] = s["dual"]
            slope_now = float(r["slope"])
            step = gap / slope_now if slope_now > 0 else (1.0 if gap > 0 else -1.0)
            new = s["dual"] + max(-4.0, min(4.0, step))
            low, high = s["low"], s["high"]
            if (low is not None and new <= low) or (high is not None and new >= high):
                new = (low + high) / 2 if low is not None and high is not None else new
            s["open"] = new != s["dual"]
            s["dual"] = new
        if not any(s["open"] for s in state.values()):
            break
    return table().withColumnRenamed("s", "source")


def balance(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """Copies of each document: the row key, ``source``, ``size``, ``source_size``, ``target``, ``copies``.

    ``sizes`` has the row key, ``source`` and ``size``; pass a written table, it is read many times.
    """
    goal = keep(targets(sizes, most), "targets")
    cells = keep(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    duals = solve_duals(cells, goal, most)
    given = goal.join(
        duals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left"
    ).select(F.col("source").alias("_acct_s"), "source_size", "target", "dual", "mean")
    raw = F.col("dual") * F.col("size") / F.col("mean")
    rate = F.when(raw < F.log(F.lit(float(most))), F.exp(raw)).otherwise(F.lit(float(most)))
    part = F.when(F.col("size") > 0, F.round(rate * UNIT)).otherwise(F.lit(UNIT)).cast("bigint")
    # One row per source, MAX_SOURCES at most: broadcast, as a hot source would fill one task.
    rated = sizes.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("_acct_s"))).select(
        *sizes.columns, "source_size", "target", part.alias("_acct_rate")
    )
    # Equal sizes are ordered by a hash of the key, so neighbours are unrelated documents.
    order = [F.col("size") == 0, F.col("size"), F.xxhash64(*KEY), F.col(FILE), F.col(ROW)]
    run = running_sums(rated, ["source"], order, {"_acct_sum": F.col("_acct_rate")})
    run = keep(run, "rounding")

    def copies(start: Column) -> Column:
        upto = F.shiftright(F.col("_acct_sum") + start, BITS)
        before = F.shiftright(F.col("_acct_sum") - F.col("_acct_rate") + start, BITS)
        return F.when(F.col("size") > 0, upto - before).otherwise(F.lit(1)).cast("bigint")

    tried = run.groupBy("source", "target").agg(
        *[F.sum(copies(F.lit(i * UNIT // STARTS)) * F.col("size")).alias(f"w{i}")
          for i in range(STARTS)]
    )
    best = F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"w{i}") - F.col("target")).alias("gap"),
                 F.lit(i * UNIT // STARTS).alias("start"))
        for i in range(STARTS)
    ]))
    starts = tried.select(F.col("source").alias("_acct_s"), best["start"].alias("_acct_start"))
    return run.join(F.broadcast(starts), F.col("source").eqNullSafe(F.col("_acct_s"))).select(
        *sizes.columns, "source_size", "target", copies(F.col("_acct_start")).alias("copies")
    )
