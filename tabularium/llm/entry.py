"""Queries and oracle SQL of this subpackage, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, centroids, chat, decontaminate, langid, minhash, packing, quality, sharding, spotsigs, substring, vocabularies, warc
from .oracle import ORACLES
from .shared import columns, table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns(table(spark, sf_dir, "documents", "doc_id"), doc_id="long", text="string")
    text = F.coalesce("text", F.lit(""))
    keys = docs.select("doc_id", (F.octet_length(text) + F.lit(sharding.OVERHEAD)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.assign(keys, "doc_id", sharding.Ring(40), tiebreak=["size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id")
    model = langid.train(docs.filter(~langid.held_out()))
    found = langid.predict(columns(docs, doc_id="long", text="string"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"), F.col("_rejected").alias("rejected"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(spark, table(spark, sf_dir, "pages", "page_id"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = columns(table(spark, sf_dir, "documents", "doc_id"), doc_id="long", text="string")
    found = bpe.encoded(docs, bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN, ids=False)
    return found.select("doc_id", *[F.col(f"_{c}").alias(c) for c in ("n_tokens", "ids_sha256", "decoded_sha256")])


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compared(table(spark, sf_dir, "documents", "doc_id"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns(table(spark, sf_dir, "documents", "doc_id"), doc_id="long", text="string")
    left = substring.deduplicated(docs)
    return left.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.col("_kept_sha256").alias("kept_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judged(table(spark, sf_dir, "documents", "doc_id"), table(spark, sf_dir, "benchmark"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id"), percent=85)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(table(spark, sf_dir, "documents", "doc_id"), table(spark, sf_dir, "labels"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations")).drop("first_error")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(table(spark, sf_dir, "documents", "doc_id"), vocabularies.read(public_tokenizers.path("word_bpe_49k.json")), end=2, capacity=4096)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = (vocabularies.read(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.judged(table(spark, sf_dir, "documents", "doc_id"), a, b)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_sharding": op1_sharding, "op2_langid": op2_langid, "op3_warc": op3_warc, "op4_bpe": op4_bpe, "op5_spotsigs": op5_spotsigs, "op6_substring": op6_substring, "op7_decontaminate": op7_decontaminate, "op8_minhash": op8_minhash, "op9_quality": op9_quality, "op10_chat": op10_chat, "op11_packing": op11_packing, "op12_alignment": op12_alignment, "op13_centroids": op13_centroids}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
