"""Newest or largest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acctpulse import schema


def top_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str | None = None,
    salts: int = 64,
) -> DataFrame:
    """First ``n`` rows of every key in ``order``.

    Ranked in two levels: Spark already drops rows beyond the n-th before each
    shuffle, and the salted level spreads what is left of a key with a large
    share of the rows over ``salts`` tasks before the final ranking.
    """
    salt = F.pmod(F.xxhash64(schema.SEQ), F.lit(salts))
    local = W.partitionBy(*keys, "_salt").orderBy(*order)
    final = W.partitionBy(*keys).orderBy(*order)
    rank_name = rank or "_rank"
    out = (
        df.withColumn("_salt", salt)
        .withColumn("_local", F.row_number().over(local))
        .where(F.col("_local") <= n)
        .drop("_salt", "_local")
        .withColumn(rank_name, F.row_number().over(final))
        .where(F.col(rank_name) <= n)
    )
    return out if rank else out.drop(rank_name)
