"""Extraction quality: five factors and their weighted score, and the route that a text takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markers as M
from ..functions import text as T
from ..functions import vocab

# Weights of marker density, Arabic density, expected articles, headings and cleanness.
WEIGHTS = {"amd": 0.25, "acd": 0.25, "eacc": 0.25, "shc": 0.15, "cs": 0.10}


def rounded(c: Column) -> Column:
    """Four digits, halves up also where the product of two decimals falls short of the half in binary."""
    return F.floor(c * 10000 + 0.5000001) / 10000


def _score(parts: dict[str, Column]) -> Column:
    total = None
    for name, weight in WEIGHTS.items():
        term = parts[name] * F.lit(weight)
        total = term if total is None else total + term
    return rounded(total)


def _parts(acd: Column, cs: Column, markers: Column, expected: Column, heads: Column, expected_heads: Column, digits: int | None) -> dict[str, Column]:
    r = (lambda c: F.round(c, digits)) if digits else (lambda c: c)
    share = F.when(expected > 0, markers / F.when(expected > 0, expected)).otherwise(F.lit(0.0))
    heads_share = F.when(expected_heads > 0, F.least(F.lit(1.0), heads / F.when(expected_heads > 0, expected_heads))).otherwise(F.lit(1.0))
    return {
        "amd": r(F.greatest(F.lit(0.0), 1.0 - F.abs(1.0 - r(share)))), "acd": r(acd), "eacc": r(F.least(F.lit(1.0), share)), "shc": r(heads_share),
        "cs": r(F.greatest(F.lit(0.0), 1.0 - r(cs) / F.lit(0.05))),
    }


def measured(laws: DataFrame) -> DataFrame:
    """(law_id, text, hits, expected_article_count, expected_chapter_headings) to factors, raw and normalised, and score, each rounded to four digits."""
    t = F.col("text")
    base = laws.select("law_id", F.length("text").cast("long").alias("char_count"), T.arabic_density(t).alias("_acd"), T.replacement_density(t).alias("_cs"), M.distinct_markers(t, F.col("hits")).alias("_m"), T.headings(t).alias("_h"), "expected_article_count", "expected_chapter_headings")
    parts = _parts(F.col("_acd"), F.col("_cs"), F.col("_m"), F.col("expected_article_count"), F.col("_h"), F.col("expected_chapter_headings"), 4)
    out = base.select("law_id", "char_count", F.col("_m").cast("long").alias("article_markers_found"), F.col("_h").cast("long").alias("structural_headings_found"), *[c.alias(f"{k}_norm") for k, c in parts.items()],
                      F.round(F.when(F.col("expected_article_count") > 0, F.col("_m") / F.when(F.col("expected_article_count") > 0, F.col("expected_article_count"))).otherwise(F.lit(0.0)), 4).alias("_amd"), F.round("_cs", 4).alias("_cs"))
    out = out.withColumn("confidence_score", _score({k: F.col(f"{k}_norm") for k in WEIGHTS}))
    return out.withColumn("passed", F.col("confidence_score") >= vocab.CONFIDENCE)


def scored(laws: DataFrame) -> DataFrame:
    """Normalised factors and score of each law."""
    return measured(laws).drop("_amd", "_cs")


def breakdown(laws: DataFrame) -> DataFrame:
    """Five rows a law: raw and normalised value, weight and contribution of each factor. Only the shares of markers and of
    corruption are normalised beyond their raw value."""
    raw = lambda k: F.col(f"_{k}" if k in {"amd", "cs"} else f"{k}_norm")
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("factor"), raw(k).alias("raw"), F.col(f"{k}_norm").alias("norm"), F.lit(w).alias("weight")) for k, w in WEIGHTS.items()]))
    return measured(laws).select("law_id", rows.alias("f")).select("law_id", "f.*", rounded(F.col("f.norm") * F.col("f.weight")).alias("contribution"))


def factors(scores: DataFrame) -> DataFrame:
    """Five rows a law: normalised value, weight and contribution of each factor."""
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("factor"), F.col(f"{k}_norm").alias("norm"), F.lit(w).alias("weight")) for k, w in WEIGHTS.items()]))
    return scores.select("law_id", rows.alias("f")).select("law_id", "f.factor", "f.norm", "f.weight", rounded(F.col("f.norm") * F.col("f.weight")).alias("contribution"))


def quick() -> Column:
    """The score before cleanup, factors unrounded; 0 for short texts. Refers to text, hits and the registry's expectations."""
    t = F.col("text")
    parts = _parts(T.arabic_density(t), T.replacement_density(t), M.distinct_markers(t, F.col("hits")), F.col("expected_article_count"), T.headings(t), F.col("expected_chapter_headings"), None)
    return F.when(F.length(t) < vocab.MIN_CHARS, F.lit(0.0)).otherwise(_score(parts))


def route(has_txt: Column, cached: Column, quick_score: Column, stripped: Column, failed: Column | None = None) -> Column:
    """Where a text comes from: plain text, cache, native extraction if good enough, else recognition; ``failed`` if none gave one."""
    base = F.when(has_txt, "plaintext").when(cached, "cached").when(quick_score >= vocab.CONFIDENCE, "pymupdf").otherwise("gemini_ocr")
    named = F.when(stripped, F.concat(base, F.lit("+dedup_stripped"))).otherwise(base)
    return named if failed is None else F.when(failed, "failed").otherwise(named)
