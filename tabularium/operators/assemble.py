"""Assembly: the last row of each article id, flags from the registry, release order and provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from .places import ranked


def keep_last(rows: DataFrame, key: str = "article_id", order: str = "ordinal") -> DataFrame:
    """The last row of each key, of several last ones the greatest, in the place of its first: one partial aggregate, no window over hot keys."""
    others = F.struct(*[c for c in rows.columns if c not in (key, order)])
    out = rows.groupBy(key).agg(F.max_by(others, F.struct(order, others)).alias("_r"), F.min(order).alias(order), F.count("*").alias("copies"))
    return out.select(key, "_r.*", order, "copies")


def one_of_each(rows: DataFrame, key: str, *first: str) -> DataFrame:
    """One row of each key: the greatest by the columns ``first``, then by all others. Whatever the order of rows, the same one."""
    names = [*first, *[c for c in rows.columns if c not in (key, *first)]]
    return rows.groupBy(key).agg(F.max(F.struct(*names)).alias("_r")).select(*[F.col(key) if c == key else F.col(f"_r.{c}") for c in rows.columns])


def flagged(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """``is_repealed`` from the registry's numbers, whatever the type; ``newly_flagged`` where the row didn't say so."""
    out = rows.join(registry.select("law_id", "repealed_articles"), "law_id", "left")
    gone = F.coalesce(F.array_contains("repealed_articles", F.col("article_number")), F.lit(False))
    return out.withColumn("newly_flagged", gone & ~F.coalesce("is_repealed", F.lit(False))).withColumn("is_repealed", gone).withColumn("is_current_version", F.lit(True)).drop("repealed_articles")


def ordered(rows: DataFrame) -> DataFrame:
    """``release_rank`` in a law: main before issuance, then by number (none counts as 0), then as before."""
    late, number = (F.col("article_type") == "issuance").cast("int"), F.coalesce("article_number", F.lit(0))
    return ranked(rows.withColumns({"_late": late, "_number": number}), "release_rank", "law_id", "_late", "_number", "ordinal", "article_id").drop("_late", "_number")


def with_provenance(rows: DataFrame, registry: DataFrame, confidence: DataFrame) -> DataFrame:
    source = registry.select("law_id", F.when(F.col("txt_filename").isNull(), "gemini_ocr").otherwise("text_file").alias("extraction_source"))
    out = rows.join(source, "law_id").join(confidence.select("law_id", "confidence_score"), "law_id", "left")
    meta = F.struct(F.lit(vocab.ARTICLE_SCHEMA).alias("schema_version"), F.lit(vocab.PIPELINE_VERSION).alias("pipeline_version"), "extraction_source", "confidence_score")
    return out.withColumn("corpus_metadata", meta).drop("extraction_source", "confidence_score")


def chunk_flags(chunks: DataFrame, assembled: DataFrame) -> DataFrame:
    gone = assembled.filter("is_repealed").select("article_id").distinct().withColumn("_gone", F.lit(True))
    out = chunks.drop("is_repealed").join(gone, "article_id", "left")
    return out.withColumn("is_repealed", F.coalesce("_gone", F.lit(False))).withColumn("is_current_version", F.lit(True)).drop("_gone")


def report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Articles in and out, duplicates removed and newly flagged, by law."""
    given = before.groupBy("law_id").agg(F.count("*").alias("total_articles_in"))
    left = after.groupBy("law_id").agg(F.count("*").alias("total_articles_out"), F.count_if("newly_flagged").alias("repealed_flagged"))
    out = given.join(left, "law_id")
    return out.select("law_id", "total_articles_in", "total_articles_out", (F.col("total_articles_in") - F.col("total_articles_out")).alias("duplicates_removed"), "repealed_flagged")


def full_report(before: DataFrame, after: DataFrame, chunks_before: DataFrame, chunks_after: DataFrame, registry: DataFrame) -> DataFrame:
    """The report with chunks in and out and the registry's repealed numbers."""
    out = report(before, after)
    for chunks, name in ((chunks_before, "total_chunks_in"), (chunks_after, "total_chunks_out")):
        out = out.join(chunks.groupBy("law_id").agg(F.count("*").alias(name)), "law_id", "left").na.fill(0, [name])
    gone = registry.select("law_id", F.size(F.array_distinct(F.coalesce("repealed_articles", F.array().cast("array<int>")))).alias("repealed_articles"))
    return out.join(gone, "law_id", "left").na.fill(0, ["repealed_articles"]).withColumn("is_current_version", F.lit(True))


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows, and the old ones whose key is not among them."""
    return new.unionByName(old.join(new.select(key).distinct(), key, "left_anti").select(new.columns))


def violations(rows: DataFrame, *key: str) -> DataFrame:
    """Keys that a unique index would refuse."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
