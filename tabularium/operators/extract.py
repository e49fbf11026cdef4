"""Extraction: the text of each law from the first source that gives one, with its route, measures and error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab
from . import confidence, split


def extracted(registry: DataFrame, texts: DataFrame, cache: DataFrame | None = None, native: DataFrame | None = None, recognise: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(law_id, text, extraction_source, char_count, page_count, arabic_density, replacement_density, success, error), a row for each law.

    ``texts`` (name, raw_text) are whole text files, ``cache`` (law_id, text) what an earlier run left, ``native`` (name, raw_text, page_count) texts out of
    documents, whose presentation forms are folded before anything looks for markers, and which count if their quick score is good enough. ``recognise`` takes (name, page_count) of the others and returns (name,
    raw_text); it is asked for no law that has a text already. A law that no source has a text for fails, and has no text. A null or blank text is none."""
    there = lambda c: T.utrim(F.coalesce(F.col(c), F.lit(""))) != ""
    laws = registry.select("law_id", "txt_filename", "pdf_filename", "expected_article_count", "expected_chapter_headings")
    rows = laws.join(texts.select(F.col("name").alias("txt_filename"), F.col("raw_text").alias("_plain")), "txt_filename", "left")
    rows = rows.join(cache.select("law_id", F.col("text").alias("_cached")), "law_id", "left") if cache is not None else rows.withColumn("_cached", F.lit(None).cast("string"))
    pages = native.select(F.col("name").alias("pdf_filename"), T.standard_forms(F.coalesce("raw_text", F.lit(""))).alias("text"), "page_count") if native is not None else None
    if pages is None:
        rows = rows.withColumns({"_native": F.lit(None).cast("string"), "page_count": F.lit(0)})
    else:
        scored = split.scanned(laws.select("law_id", "pdf_filename", "expected_article_count", "expected_chapter_headings").join(pages, "pdf_filename"))
        good = scored.withColumn("_quick", confidence.quick()).select("law_id", "page_count", F.when(F.col("_quick") >= vocab.CONFIDENCE, F.col("text")).alias("_native"))
        rows = rows.join(good, "law_id", "left")
    known = there("_plain") | there("_cached") | there("_native")
    if recognise is None:
        rows = rows.withColumn("_read", F.lit(None).cast("string"))
    else:
        asked = rows.filter(~known & F.col("pdf_filename").isNotNull()).select(F.col("pdf_filename").alias("name"), F.coalesce("page_count", F.lit(0)).alias("page_count")).distinct()
        rows = rows.join(recognise(asked).select(F.col("name").alias("pdf_filename"), F.col("raw_text").alias("_read")), "pdf_filename", "left")
    text = F.when(there("_plain"), F.col("_plain")).when(there("_cached"), F.col("_cached")).when(there("_native"), F.col("_native")).when(there("_read"), F.col("_read"))
    quick = F.when(there("_native"), F.lit(1.0)).otherwise(F.lit(0.0))
    rows = rows.select("law_id", text.alias("text"), confidence.route(there("_plain"), there("_cached"), quick, F.lit(False)).alias("_route"), F.coalesce("page_count", F.lit(0)).alias("page_count"))
    lost = rows.filter(F.col("text").isNull()).select("law_id", F.lit(None).cast("string").alias("text"), F.lit("failed").alias("extraction_source"), "page_count", F.lit("no source gave a text").alias("error"))
    held = split.scanned(rows.filter(F.col("text").isNotNull()))
    once = split.without_second_copy(held.select("law_id", "text", "orphan", "hits")).select("law_id", "text", "stripped").join(rows.select("law_id", "_route", "page_count"), "law_id")
    named = F.when(F.col("stripped"), F.concat("_route", F.lit("+dedup_stripped"))).otherwise(F.col("_route"))
    out = once.select("law_id", "text", named.alias("extraction_source"), "page_count", F.lit(None).cast("string").alias("error")).unionByName(lost)
    c = F.coalesce("text", F.lit(""))
    return out.select(
        "law_id", "text", "extraction_source", F.length(c).cast("long").alias("char_count"), "page_count", F.round(F.when(c == "", 0.0).otherwise(T.arabic_density(c)), 4).alias("arabic_density"),
        F.round(F.when(c == "", 0.0).otherwise(T.replacement_density(c)), 4).alias("replacement_density"), F.col("error").isNull().alias("success"), "error",
    )
