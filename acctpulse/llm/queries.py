"""The corpus operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctpulse.llm import (
    convrepair,
    crosstok,
    decontaminate,
    htmlwrap,
    langid,
    mixing,
    neardup,
    pq,
    quality,
    sharding,
    toxicity,
    urlfilter,
    warc,
)
from acctpulse.llm.tables import KEY, keep, with_row_key
from acctpulse.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
N_SHARDS = 16
#: Public vocabulary files; read on the driver and handed to the tasks.
TOKENIZERS = "/opt/tokenizers"
PLACE_RULES = [
    urlfilter.place_rule("block", "net/"),
    urlfilter.place_rule("allow", "example.net/en/"),
    urlfilter.place_rule("block", "example.com/de/"),
    urlfilter.place_rule("allow", "org/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, rest: int) -> Column:
    """Rows that nothing may be learned from: by CRC-32 of the id as text; a null id is not one."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(4, 2))
    model = langid.fit_filter(docs.where(~F.col("held_out")), F.col("doc_id"))
    return langid.identify(docs, model, ["doc_id", "held_out"])


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_row_key(table(spark, sf_dir, "pages"))
    path = scratch_path(spark, "warc")
    warc.archive(
        pages.select(*KEY, F.col("page_id").alias("record_id"), "url", F.col("html").alias("payload")),
        path,
    )
    return warc.verified(warc.read_records(spark, path)).select(
        warc.id_of(F.col("record")).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", warc.id_of(F.col("refers_to")).alias("refers_to"), "verified",
    )


def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row_key(table(spark, sf_dir, "documents"))
    shards = sharding.kd_shards(sharding.light_rows(docs, ["doc_id"]), n_shards=N_SHARDS)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row_key(table(spark, sf_dir, "documents"))
    hits = decontaminate.hits_per_row(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def _predicted(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", held_out(3, 1))
    labels = table(spark, sf_dir, "labels").where(~held_out(3, 1))
    machine = toxicity.train(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    return _predicted(toxicity.score(docs, machine, ["doc_id", "held_out"]))


def line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", held_out(4, 2))
    labels = table(spark, sf_dir, "labels").where(~held_out(4, 2))
    field = quality.train(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return _predicted(quality.score(docs, field, ["doc_id", "held_out"]))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, PLACE_RULES + urlfilter.DEFAULT_RULES).drop("url")


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row_key(table(spark, sf_dir, "documents"))
    sizes = docs.select(*KEY, "doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    rates = mixing.balance(keep(sizes, "sizes"))
    return rates.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = with_row_key(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return pq.linked_vectors(vectors).select("vec_id", "n_links", "component_id", "kept")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return neardup.near_duplicates(docs, []).select("doc_id", "class_id", "kept", "class_rows")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults, picked by CRC-32 of conversation and turn: dropped, emptied, cut off, repeated, another role."""
    spelled = F.concat(*[
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    ])
    rest = F.crc32(spelled.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(rest == 1, "").when(rest == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.explode(F.sequence(F.lit(1), F.when(rest == 3, 2).otherwise(1)))
    return conversations.where(rest != 0).select(
        "conv_id", "turn", F.when(rest == 4, "user").otherwise(role).alias("role"), text.alias("text"),
        copies.alias("copy"),
    ).drop("copy")


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return convrepair.repair(damaged(given), given)


def cross_tokens(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    vocabulary, model = (
        Path(tokenizers, name).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")
    )
    return crosstok.cross_align(table(spark, sf_dir, "documents"), ["doc_id"], vocabulary, model)[0]


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmlwrap.extract(pages, ["page_id", "url"])[0]


def registry() -> dict[str, Query]:
    return {
        "op1_language_id": language_id,
        "op2_warc": warc_archive,
        "op3_toxicity": toxic,
        "op4_kd_sharding": sharded,
        "op5_decontamination": decontaminated,
        "op6_url_filter": url_filter,
        "op7_entropy_mixing": mixed,
        "op8_pq_links": vector_links,
        "op9_line_quality": line_quality,
        "op10_near_duplicates": near_duplicates,
        "op11_conversation_repair": conversation_repair,
        "op12_cross_tokens": cross_tokens,
        "op13_main_text": main_texts,
    }
