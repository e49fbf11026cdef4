"""Splitting laws into articles, and the report of a split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markers as M
from ..functions import text as T
from ..functions import vocab


def scanned(laws: DataFrame, text: str = "text", exclusions: str | None = None) -> DataFrame:
    """``laws`` with ``orphan`` and ``hits``."""
    found = M.segments(F.col(text), F.col(exclusions) if exclusions else None)
    return laws.withColumn("_s", found).select(*laws.columns, F.col("_s.orphan").alias("orphan"), F.col("_s.hits").alias("hits"))


def articles(laws: DataFrame, repealed: str | None = None) -> DataFrame:
    """One row for each article of scanned laws: (law_id, hits[, repealed]). Narrow but for the last article 1, which is found within the row."""
    return _articles(laws, repealed).filter("sequence_index is not null")


def measured(laws: DataFrame, repealed: str | None = None) -> DataFrame:
    """What checks and reports read, without texts: articles with ``bare_chars``, and ``orphan_text_chars`` of their law; a law without articles has one row without a
    ``sequence_index``."""
    out = _articles(laws.withColumn("orphan_text_chars", _orphan_chars()), repealed, ["orphan_text_chars"])
    return out.withColumn("bare_chars", F.length(T.utrim(F.col("text")))).drop("text", "article_number_raw")


def _orphan_chars() -> Column:
    return F.length(T.utrim(F.col("orphan"))).cast("long")


def _articles(laws: DataFrame, repealed: str | None, others: Sequence[str] = ()) -> DataFrame:
    last_first = F.coalesce(F.array_max(F.transform("hits", lambda h, i: F.when((h["number"] == 1) & (h["kind"] != "ordinal"), i + 1))), F.lit(0))
    # Not posexplode: the optimiser filters by the size of what that takes, and repeats the whole scan for the filter, twice.
    rows = laws.select("law_id", *others, last_first.alias("_last"), (F.col(repealed) if repealed else F.array().cast("array<int>")).alias("_gone"), F.posexplode_outer("hits").alias("_pos", "_h"))
    bare = T.utrim(F.col("_h.body"))
    body = F.when(F.startswith(bare, F.lit(":")), F.regexp_replace(bare, rf"(?U)^:{T.WS}*", "")).otherwise(bare)
    seq, number, ordinal = F.col("_pos") + 1, F.col("_h.number"), F.col("_h.kind") == "ordinal"
    kind = F.when(ordinal | (seq < F.col("_last")), "issuance").otherwise("main")
    out = rows.select("law_id", *others, seq.alias("sequence_index"), number.alias("article_number"), T.one_spaced(F.col("_h.raw")).alias("article_number_raw"), kind.alias("article_type"), body.alias("text"),
                      (F.array_contains("_gone", number) & ~ordinal).alias("is_repealed"), F.col("_h.kind").alias("marker_kind"))
    return out.select(F.format_string("%s_%03d", "law_id", "sequence_index").alias("article_id"), "*", F.lit("regex").alias("split_source"), T.word_count(F.col("text")).alias("word_count"), F.length("text").alias("char_count"))


def kind_histogram(found: DataFrame) -> DataFrame:
    return found.groupBy("law_id", "marker_kind").agg(F.count("*").alias("n"))


def report(laws: DataFrame, found: DataFrame, registry: DataFrame) -> DataFrame:
    """Counts of each law's split; laws without a marker have none."""
    counts = found.groupBy("law_id").agg(F.count("*").alias("articles_found"), F.count_if(F.col("article_type") == "issuance").alias("issuance_count"))
    orphans = laws.select("law_id", "orphan_text_chars" if "orphan_text_chars" in laws.columns else _orphan_chars().alias("orphan_text_chars"))
    out = orphans.join(counts, "law_id", "left").join(registry.select("law_id", "expected_article_count"), "law_id")
    n, iss = F.coalesce("articles_found", F.lit(0)), F.coalesce("issuance_count", F.lit(0))
    return out.select("law_id", n.alias("articles_found"), F.col("expected_article_count").cast("long").alias("expected_article_count"), iss.alias("issuance_count"), (n - iss).alias("main_count"), "orphan_text_chars")


def second_copy(text: str = "text") -> tuple[Column, Column, Column]:
    """Whether a text holds itself twice, by the numbers of its markers, how many markers a half has and how long the first half is; within the row."""
    n, half = F.size("hits"), F.floor(F.size("hits") / 2).cast("int")
    numbers = F.transform("hits", lambda h: h["number"])
    first = F.slice(numbers, F.lit(1), F.greatest(half, F.lit(0)))
    second = F.slice(numbers, half + 1, F.greatest(half, F.lit(0)))
    length = F.aggregate(F.slice("hits", F.lit(1), F.greatest(half, F.lit(0))), F.length("orphan"), lambda a, h: a + F.length(h["raw"]) + F.length(h["body"]))
    ratio = (F.length(text) - length) / F.greatest(length, F.lit(1))
    return (n >= 2 * vocab.DUPLICATE_HALF) & (n % 2 == 0) & (first == second) & ratio.between(0.6, 1.5), half, length


def without_second_copy(laws: DataFrame, text: str = "text") -> DataFrame:
    """A text that holds itself twice, by the numbers of its markers, keeps its first half; ``stripped`` tells. (law_id, text, hits, orphan)"""
    twice, half, length = second_copy(text)
    cut = F.regexp_replace(F.substring(F.col(text), F.lit(1), length), rf"(?U){T.WS}+$", "")
    return laws.select("law_id", twice.alias("stripped"), F.when(twice, cut).otherwise(F.col(text)).alias("text"), F.length(text).cast("long").alias("original_chars"), F.when(twice, half).otherwise(F.lit(0)).cast("long").alias("duplicate_marker_count"))
