"""Word-budget chunks with overlap, all within a row: paragraphs, or sentences of long paragraphs, merged up to a limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab


def merged(segments: Column, limit: int = vocab.CHUNK_WORDS) -> Column:
    """Word arrays of consecutive segments: a segment that would exceed the limit begins the next chunk; none is cut."""
    start = F.struct(F.array().cast("array<string>").alias("cur"), F.array().cast("array<array<string>>").alias("out"))

    def fold(a: Column, w: Column) -> Column:
        full = (F.size(a["cur"]) > 0) & (F.size(a["cur"]) + F.size(w) > limit)
        return F.when(full, F.struct(w.alias("cur"), F.concat(a["out"], F.array(a["cur"])).alias("out"))).otherwise(F.struct(F.concat(a["cur"], w).alias("cur"), a["out"].alias("out")))

    return F.aggregate(F.transform(segments, T.words), start, fold, lambda a: F.when(F.size(a["cur"]) > 0, F.concat(a["out"], F.array(a["cur"]))).otherwise(a["out"]))


def overlapped(chunks: Column, overlap: int = vocab.OVERLAP_WORDS) -> Column:
    """array<struct<text, has_overlap>>: each chunk but the first begins with the last words of the one before it, as that was."""

    def one(c: Column, i: Column) -> Column:
        before = F.get(chunks, i - 1)
        tail = F.slice(before, F.greatest(F.size(before) - overlap + 1, F.lit(1)), F.lit(overlap))
        return F.struct(F.array_join(F.when(i > 0, F.concat(tail, c)).otherwise(c), " ").alias("text"), (i > 0).alias("has_overlap"))

    return F.transform(chunks, one)


def rule_chunks(text: Column, limit: int = vocab.CHUNK_WORDS, overlap: int = vocab.OVERLAP_WORDS) -> Column:
    short = F.array(F.struct(T.utrim(text).alias("text"), F.lit(False).alias("has_overlap")))
    fine = F.flatten(F.transform(T.paragraphs(text), lambda p: F.when(T.word_count(p) > limit, T.sentences(p)).otherwise(F.array(p))))
    return F.when(T.word_count(text) <= limit, short).otherwise(T.let(merged(fine, limit), lambda c: overlapped(c, overlap)))


def semantic_chunks(reply: Column, text: Column) -> Column:
    """Chunks of a client's reply (JSON array of strings), or null: unreadable, empty, not all strings, or too few words."""
    parsed = F.from_json(reply, "array<string>", {"mode": "PERMISSIVE"})
    total = F.aggregate(parsed, F.lit(0), lambda a, c: a + T.word_count(c))
    strings = F.coalesce(F.schema_of_variant(F.try_parse_json(reply)) == "ARRAY<STRING>", F.lit(False))
    good = strings & (F.size(parsed) > 0) & (total >= T.word_count(text) * F.lit(vocab.SEMANTIC_SHARE))
    return F.when(good, F.filter(F.transform(parsed, lambda c: F.struct(T.utrim(c).alias("text"), F.lit(False).alias("has_overlap"))), lambda c: c["text"] != ""))


def _chunks(text: Column, reply: Column | None = None) -> Column:
    """array<struct<text, has_overlap, method>> of a text that is trimmed and not empty. A reply, if given, is for long articles only."""
    named = lambda chunks, method: F.transform(chunks, lambda c: F.struct(c["text"].alias("text"), c["has_overlap"].alias("has_overlap"), F.lit(method).alias("method")))
    parts = named(rule_chunks(text), "rule_based")
    if reply is None:
        return parts
    return F.coalesce(named(F.when(T.word_count(text) > vocab.CHUNK_WORDS, semantic_chunks(reply, text)), "semantic"), parts)


def _trimmed(found: DataFrame) -> DataFrame:
    return found.withColumn("_t", T.utrim(F.coalesce("text", F.lit(""))))


def methods(found: DataFrame, reply: str) -> DataFrame:
    """How each article is cut and into how many chunks of its reply: (article_id, chunk_method, semantic_chunks). A row for each, also where there is no text and so no
    chunk; what no reply cuts is left to the rule."""
    cut = F.when(F.col("_t") != "", F.size(F.filter(_chunks(F.col("_t"), F.col(reply)), lambda c: c["method"] == "semantic")))
    n = F.col("semantic_chunks")
    rows = _trimmed(found).select("article_id", F.coalesce(cut, F.lit(0)).alias("semantic_chunks"))
    return rows.select("article_id", F.when(n > 0, "semantic").otherwise("rule_based").alias("chunk_method"), n)


def chunked(found: DataFrame, reply: str | None = None) -> DataFrame:
    """One row for each chunk of the articles that have text, with the article's columns. A reply, if given, is for long articles only."""
    rows = _trimmed(found).filter("_t <> ''")
    parts = _chunks(F.col("_t"), F.col(reply) if reply else None)
    whole = T.let(parts, lambda p: F.transform(p, lambda c: F.struct(c["text"].alias("text"), c["has_overlap"].alias("has_overlap"), c["method"].alias("method"), F.size(p).alias("total"))))
    keep = [c for c in found.columns if c not in {"text", "word_count", "char_count", reply}]
    out = rows.select(*keep, F.posexplode(whole).alias("chunk_index", "_x"))
    chunk_id = F.format_string("%s_C%03d", "article_id", F.col("chunk_index") + 1)
    return out.select(
        chunk_id.alias("chunk_id"), *keep, F.col("chunk_index").cast("long").alias("chunk_index"), F.col("_x.total").cast("long").alias("chunk_total"), F.col("_x.method").alias("chunk_method"), F.col("_x.text").alias("text"),
        F.col("_x.has_overlap").alias("has_overlap"), T.word_count(F.col("_x.text")).cast("long").alias("word_count"), F.length("_x.text").cast("long").alias("char_count"),
    )


def report(chunks: DataFrame, by: str = "law_id") -> DataFrame:
    n = F.count("*")
    return chunks.groupBy(by).agg(
        n.alias("total_chunks"), F.round(F.sum("word_count") / n, 1).alias("avg_chunk_words"), F.max("word_count").alias("max_chunk_words"), F.min("word_count").alias("min_chunk_words"),
        F.count_if(F.col("chunk_method") == "semantic").alias("semantic_chunks"), F.count_if(F.col("chunk_method") == "rule_based").alias("rule_based_chunks"),
        F.count_if((F.col("chunk_index") == 0) & (F.col("chunk_total") == 1)).alias("single_chunk_articles"), F.count_if((F.col("chunk_index") == 0) & (F.col("chunk_total") > 1)).alias("multi_chunk_articles"),
    )
