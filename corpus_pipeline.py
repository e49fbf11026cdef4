"""A training-corpus pipeline over ``documents``: five stages, each written as Parquet in the shared folder and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept:

1. language ID: fitted on the labelled rows of its input; documents that it rejects go;
2. MinHash near-dedup: one document of each group stays;
3. substring dedup: words of windows that a smaller doc_id holds too go from the text;
4. benchmark decontamination: documents that hold a benchmark item go;
5. byte-level BPE: token ids of what is left.

All but the last return the columns of ``documents``, further columns included, whatever their names. SQL can't express them (a fitted model, hashed words, a tokenizer),
so ``ORACLE_SQL`` is None and the tests compare ``run`` with brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import bpe, decontaminate, langid, minhash, substring
from tabularium.llm.shared import free, stored, table

#: Of the near-dedup stage: 100 * intersection >= NEAR * union of the sets of 5-word shingles.
NEAR = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs.filter(~langid.held_out()))
    *_, rejected = free(docs.columns, *langid.ADDED)
    return langid.predict(docs, model).filter(~F.col(rejected)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.kept_documents(docs, percent=NEAR)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left, (_, _, removed, _) = substring.deduplicated(docs), free(docs.columns, *substring.ADDED)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col(removed) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found, (ids, n, sha, back) = bpe.encoded(docs, ranks, public_tokenizers.PATTERN), free(docs.columns, *bpe.ADDED)
    numbers = F.when(F.col(ids) == "", F.array().cast("array<int>")).otherwise(F.split(ids, " ").cast("array<int>"))
    return found.select("doc_id", "lang", F.col(n).alias("n_tokens"), numbers.alias("ids"), F.col(sha).alias("ids_sha256"), F.col(back).alias("decoded_sha256"))


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
