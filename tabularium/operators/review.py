"""Rows and statistics for reviewers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .places import placed


def chunk_counts(found: DataFrame, chunks: DataFrame) -> DataFrame:
    n = chunks.groupBy("article_id").agg(F.count("*").alias("chunk_count"))
    return found.join(n, "article_id", "left").withColumn("chunk_count", F.coalesce("chunk_count", F.lit(0)))


def article_rows(found: DataFrame, chunks: DataFrame) -> DataFrame:
    """The columns that a reviewer sees of an article, lists joined, review fields empty."""
    listed = lambda c: F.coalesce(F.array_join(c, " | "), F.lit("")).alias(c)
    out = chunk_counts(found, chunks)
    return out.select(
        "article_id", "law_id", "article_number", "article_number_raw", "article_type", "article_category", "topic", listed("keywords"), listed("legal_entities"), "article_summary", "is_repealed",
        "word_count", "char_count", "chunk_count", F.coalesce("enrichment_error", F.lit("")).alias("enrichment_error"), F.lit("").alias("review_status"), F.lit("").alias("review_notes"), "text",
    )


def chunk_rows(chunks: DataFrame) -> DataFrame:
    listed = lambda c: F.coalesce(F.array_join(c, " | "), F.lit("")).alias(c)
    return chunks.select(
        "chunk_id", "article_id", "law_id", "chunk_index", "chunk_total", "has_overlap", "article_number", "article_type", "article_category", "topic", listed("keywords"), listed("legal_entities"), "is_repealed",
        "word_count", "char_count", F.lit("").alias("review_status"), F.lit("").alias("review_notes"), "text",
    )


def stats(found: DataFrame, chunks: DataFrame) -> DataFrame:
    out = chunk_counts(found, chunks)
    return out.groupBy("law_id").agg(
        F.count("*").alias("total_articles"), F.count_if(F.col("article_type") == "issuance").alias("issuance_articles"), F.count_if(F.col("article_type") != "issuance").alias("main_articles"),
        F.count_if(F.coalesce("enrichment_error", F.lit("")) != "").alias("enrichment_errors"), F.sum("chunk_count").alias("total_chunks"), F.count_if(F.col("chunk_count") > 1).alias("multi_chunk_articles"), F.count_if(F.col("chunk_count") <= 1).alias("single_chunk_articles"),
    )


def prioritised(found: DataFrame, issues: DataFrame, registry: DataFrame) -> DataFrame:
    """Articles with ``priority`` (100 for an error, 10 for a warning, 20 if the law's text was recognised rather than read) and ``review_rank`` over the whole
    corpus: highest first, then by law and place. The order is a distributed sort, whatever the number of articles or laws."""
    error, warning = F.col("severity") == "error", F.col("severity") == "warning"
    points = issues.groupBy("article_id").agg((100 * F.count_if(error) + 10 * F.count_if(warning)).alias("_points"))
    read = registry.select("law_id", F.col("txt_filename").isNull().alias("_recognised"))
    out = found.join(points, "article_id", "left").join(read, "law_id", "left")
    score = F.coalesce("_points", F.lit(0)) + F.when(F.col("_recognised"), F.lit(20)).otherwise(F.lit(0))
    out = out.select(*found.columns, score.cast("long").alias("priority"), (-score).cast("long").alias("_first"))
    return placed(out, "_place", "_first", "law_id", "sequence_index", "article_id").withColumn("review_rank", F.col("_place") + 1).drop("_first", "_place")
