"""Sources: registries, whole texts, native and recognised documents, JSON stage tables, caches and settings. Text never passes through the driver."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab

REGISTRY = (
    "law_id string, law_name_ar string, law_number string, year int, pdf_filename string, expected_article_count int, repealed_articles array<int>, "
    "expected_chapter_headings int, txt_filename string, notes string, manual_marker_exclusions array<string>"
)
ARTICLES = (
    "article_id string, law_id string, article_number int, article_number_raw string, article_type string, text string, is_repealed boolean, sequence_index int, "
    "marker_kind string, split_source string, word_count int, char_count int"
)

#: Characters of packed texts: before a mark that stands for itself, at the end of a record, before each field.
PACK_ESCAPE, PACK_RECORD, PACK_FIELD = "\x1b", "\x1e", "\x1f"


def registry(spark: SparkSession, path: str) -> DataFrame:
    """The laws of a JSON array file; lists that are missing are empty, counts that are missing 0."""
    rows = spark.read.schema(REGISTRY).json(path, multiLine=True)
    empty = lambda c, t: F.coalesce(c, F.array().cast(t)).alias(c)
    lists = {"repealed_articles": "array<int>", "manual_marker_exclusions": "array<string>"}
    numbers = ("expected_article_count", "expected_chapter_headings")
    return rows.select(*[empty(c, lists[c]) if c in lists else F.coalesce(c, F.lit(0)).alias(c) if c in numbers else F.col(c) for c in rows.columns])


def law(registry_rows: DataFrame, law_id: str) -> DataFrame:
    """One law, or KeyError naming some of those that there are."""
    found = registry_rows.filter(F.col("law_id") == law_id)
    if found.isEmpty():
        known = [r["law_id"] for r in registry_rows.select("law_id").orderBy("law_id").limit(20).collect()]  # for the message
        raise KeyError(f"no law {law_id!r}; there are {known}")
    return found


def source_name() -> Column:
    """A text file wins over a document to be extracted."""
    return F.coalesce("txt_filename", "pdf_filename")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, path, length) of the files of a folder, without their content."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length")


def with_sources(registry_rows: DataFrame, listing: DataFrame) -> DataFrame:
    """Laws with ``source`` and whether it exists."""
    names = listing.select(F.col("name").alias("source")).distinct().withColumn("source_exists", F.lit(True))
    out = registry_rows.withColumn("source", source_name()).join(names, "source", "left")
    return out.withColumn("source_exists", F.coalesce("source_exists", F.lit(False)))


def whole_texts(spark: SparkSession, path: str, strip: bool = True) -> DataFrame:
    """(name, raw_text, columns of the folders): one row a file, navigation and footers taken off."""
    rows = spark.read.text(path, wholetext=True)
    folders = [c for c in rows.columns if c != "value"]
    rows = rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), "value", *folders)
    return rows.select("name", (T.strip_boilerplate(F.col("value")) if strip else F.col("value")).alias("raw_text"), *folders)


def packed_texts(spark: SparkSession, path: str, strip: bool = True) -> DataFrame:
    """(law_id, raw_text): one row a law from files of ``sinks.packed_texts``, navigation and footers taken off. Large files are cut at records."""

    def field(c: Column) -> Column:
        bare = c
        for k, mark in reversed(list(enumerate((PACK_ESCAPE, PACK_RECORD, PACK_FIELD), 1))):
            bare = F.replace(bare, F.lit(f"{PACK_ESCAPE}{k}"), F.lit(mark))
        return F.when(c != f"{PACK_ESCAPE}0", bare)

    value = F.substring("value", 2, 2**31 - 1)
    rows = spark.read.text(path, lineSep=PACK_RECORD).select(F.substring_index(value, PACK_FIELD, 1).alias("i"), F.substring_index(value, PACK_FIELD, -1).alias("t"))
    text = field(F.col("t"))
    return rows.select(field(F.col("i")).alias("law_id"), (T.strip_boilerplate(text) if strip else text).alias("raw_text"))


Pages = Callable[[bytes], list[str]]


def pdf_pages(data: bytes) -> list[str]:
    """Texts of a document's pages, by an optional library."""
    try:
        import fitz
    except ImportError as missing:
        raise RuntimeError("native extraction needs PyMuPDF, which isn't installed; give another function from bytes to pages") from missing
    with fitz.open(stream=data, filetype="pdf") as doc:
        return [page.get_text("text") for page in doc]


def extracted(spark: SparkSession, path: str, pages: Pages = pdf_pages) -> DataFrame:
    """(name, raw_text, page_count): pages of each file, trimmed, empty ones left out, joined by an empty line."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [pages(bytes(b)) for b in frame["content"]]
            yield pd.DataFrame({"name": frame["name"], "raw_text": ["\n\n".join(p.strip() for p in x if p.strip()) for x in found], "page_count": [len(x) for x in found]})

    rows = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return rows.mapInPandas(run, "name string, raw_text string, page_count int")


def page_ranges(documents: DataFrame, size: int = vocab.OCR_PAGES) -> DataFrame:
    """(name, start, stop): windows of pages, end exclusive."""
    rows = documents.filter("page_count > 0")
    return rows.select("name", F.explode(F.sequence(F.lit(0), F.col("page_count") - 1, F.lit(size))).alias("start"), "page_count").select("name", "start", F.least(F.col("start") + size, F.col("page_count")).alias("stop"))


def recognised(ranges: DataFrame, client: Callable) -> DataFrame:
    """(name, raw_text) of page ranges read by a client (frames with name, start, stop to frames with text), in page order."""
    parts = ranges.mapInPandas(client, "name string, start int, text string")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda p: p["text"])
    return parts.groupBy("name").agg(F.array_join(ordered, "\n\n").alias("raw_text"))


def cached_first(work: DataFrame, cache: DataFrame, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows with cached text, rows still to extract) by law."""
    if force:
        return work.join(cache, "law_id").limit(0), work
    return work.join(cache, "law_id"), work.join(cache.select("law_id"), "law_id", "left_anti")


def clean_preferred(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(law_id, text): the cleaned text where there is one, else the raw one; a law with neither is an error."""
    out = raw.select("law_id", F.col("text").alias("_raw")).join(clean.select("law_id", F.col("text").alias("_clean")), "law_id", "full")
    text = F.coalesce("_clean", "_raw")
    return out.select("law_id", F.when(text.isNull(), F.raise_error(F.concat(F.lit("no text of law "), "law_id"))).otherwise(text).alias("text"))


def stage_table(spark: SparkSession, path: str, schema: str = ARTICLES, multiline: bool = True) -> DataFrame:
    """A stage's JSON arrays (or lines), read with a fixed schema: fields that are missing are null, others ignored."""
    return spark.read.schema(schema).json(path, multiLine=multiline)


def confidence_reports(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Reports, one a line (or one a file); one that can't be read is as if there were none."""
    rows = spark.read.schema("law_id string, confidence_score double").option("mode", "PERMISSIVE").json(path, multiLine=multiline)
    return rows.filter(F.col("law_id").isNotNull())


@dataclass(frozen=True)
class Settings:
    """Options with typed defaults, from the environment under a prefix."""

    confidence_threshold: float = vocab.CONFIDENCE
    batch_size: int = vocab.BATCH_SIZE
    chunk_words: int = vocab.CHUNK_WORDS
    overlap_words: int = vocab.OVERLAP_WORDS
    semantic_chunking: bool = False
    primary_model: str = "primary"
    fallback_model: str = "fallback"
    rpm_cooldown_s: float = 65.0

    @classmethod
    def from_env(cls, prefix: str = "TABULARIUM_", env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        read = {"float": float, "int": int, "str": str, "bool": lambda v: v.strip().lower() in {"1", "true", "yes", "on"}}
        return cls(**{f.name: read[str(f.type)](env[key]) for f in fields(cls) if (key := prefix + f.name.upper()) in env and env[key] != ""})

    def models(self) -> list[str]:
        """Models in the order in which they are tried, each once."""
        return list(dict.fromkeys(m for m in (self.primary_model, self.fallback_model) if m))


def generation_options(**options: object) -> dict[str, object]:
    """Only the options that are set; a thinking budget rules out a level."""
    kept = {k: v for k, v in options.items() if v is not None}
    if "thinking_budget" in kept:
        kept.pop("thinking_level", None)
    return kept


def vocabulary(spark: SparkSession, words: list[str]) -> DataFrame:
    """A sorted one-column table."""
    return spark.createDataFrame([(w,) for w in sorted(set(words))], "concept string")
