"""From raw documents to sharded training data, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs``, and returns a DataFrame that is
written and read again as the next one's ``docs``. All but the last return the columns of
``docs``. Rows are named by their place in the written table, so repeated documents, null ids and
further columns of any name are fine, and empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctpulse.llm import decontaminate, langid, mixing, neardup, sharding
from acctpulse.llm.queries import N_SHARDS, held_out, table
from acctpulse.llm.tables import KEY, keep, pick_rows, with_row_key

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the languages that the labelled ones are in."""
    model = langid.fit_filter(docs.where(~held_out(4, 2)), F.col("doc_id"))
    whole = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    named = langid.identify(whole, model, ["row"])
    return named.where(langid.accepted()).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    keyed = with_row_key(docs)
    classes = neardup.near_duplicates(keyed.select(*KEY, "doc_id", "text"), [])
    return pick_rows(docs, keyed, classes.where("kept").select(*KEY), "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in passages of the benchmark."""
    keyed = with_row_key(docs)
    hits = decontaminate.hits_per_row(
        keyed.select(*KEY, "text"), table(spark, sf_dir, "benchmark"), []
    )
    return pick_rows(docs, keyed, hits.where("contaminated").select(*KEY), "left_anti")


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that each source has its share of the words."""
    keyed = with_row_key(docs)
    sizes = keep(keyed.select(*KEY, "source", mixing.n_words(F.col("text")).alias("size")), "sizes")
    copies = mixing.balance(sizes).where(F.col("copies") > 0).select(
        *KEY, F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_acct_copy")
    )
    return pick_rows(docs, keyed, copies, "inner")


def kd_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``shard`` and ``slot``; the documents' own columns are in ``document``."""
    keyed = with_row_key(docs)
    shards = sharding.kd_shards(sharding.light_rows(keyed), n_shards=N_SHARDS)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    return keyed.select(*KEY, row).join(shards.select(*KEY, "shard", "slot"), KEY).select(
        "shard", "slot", F.col("document.doc_id").alias("doc_id"), "document"
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing_to_weights", mixing_to_weights),
    ("kd_sharding", kd_sharding),
]

#: SQL can't express weighted sampling, Newton steps or a tree of medians; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
