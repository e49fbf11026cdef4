"""Inputs of the queries, derived from the test tables by rules that SQL can state too: laws with markers, references, headings and
noise from ``documents``, and article, metadata, cache and ledger tables for the later stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..operators.places import ranked
from ..sources.stages import once

LATIN, ARABIC = "abcdefghijklmnopqrstuvwxyzéèêçóñ", "أبتثجحخدإرزسشصضطظعغفقكلىئهَـٌّآو"

_PIECE = f"""
case when (doc_id + i) % 25 = 0 and n > 3 then null else concat(
  case when doc_id % 3 = 0 and n > 3 and i = 1 then '(المادة الأولى)' when doc_id % 3 = 0 and n > 3 and i = 2 then '(المادة الثانية)'
       when i % 11 = 0 then concat('مادة ', i - sh - 1, ' مكرر')
       when doc_id % 2 = 0 then concat('مادة (', translate(cast(i - sh as string), '0123456789', '٠١٢٣٤٥٦٧٨٩'), ')')
       else concat('المادة ', i - sh) end,
  '\n', translate(l, '{LATIN}', '{ARABIC}'),
  case when i % 10 = 5 then concat(' طبقا المادة (', i - 3, ')') when i % 10 = 0 then concat(' وفق المادتين (', i - 3, ') و(', i, ')')
       when i % 7 = 0 then '\nالمادة 3 من هذا القانون' when i % 9 = 0 then '\nالباب الأول' when i % 13 = 0 then '\n(الفصل الثاني)' else '' end,
  case when doc_id % 17 = 0 and i % 4 = 0 then '�' else '' end, case when doc_id % 19 = 0 and i % 3 = 0 then '\x07' else '' end,
  case when doc_id % 13 = 0 and i % 2 = 0 then '  .\n\n\n\n' else '' end, case when doc_id % 41 = 0 and i % 3 = 0 then ' فقد قضت' else '' end) end"""


KEYS = {"documents": "doc_id", "pages": "page_id", "events": "event_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; one that is too small to occupy all cores is dealt out to them by its key."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores, KEYS[name]) if name in KEYS and df.rdd.getNumPartitions() < cores else df


def corpus_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, law_id, raw_text): one law a document, one article a line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("ls")).withColumn("n", F.size("ls"))
    docs = docs.withColumn("sh", F.expr("if(doc_id % 3 = 0 and n > 3, 2, 0)"))
    piece = _PIECE.replace("\n  ", " ").replace("{i}", "i")
    docs = docs.withColumn("b", F.expr(f"array_join(filter(transform(ls, (l, j) -> get(transform(array(j + 1), i -> {piece}), 0)), p -> p is not null), '\\n')"))
    body = F.col("b")
    head = F.expr("case when doc_id % 29 = 0 then 'menu نص القانون ' when doc_id % 7 = 0 then concat(repeat('تمهيد ', 200), '\n') when doc_id % 31 = 0 then 'ما5 و ما 6\n' else '' end")
    foot = F.expr("case when doc_id % 29 = 0 then '\nCreative Commons x' else '' end")
    text = F.concat(head, F.when(F.expr("doc_id % 37 = 0"), F.concat(body, F.lit("\n"), body)).otherwise(body), foot)
    return docs.select("doc_id", F.format_string("L%05d", "doc_id").alias("law_id"), text.alias("raw_text"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.size(F.split("text", "\n")).alias("n"))
    return docs.select(
        F.format_string("L%05d", "doc_id").alias("law_id"), F.expr("cast(n + doc_id % 5 - 2 as int)").alias("expected_article_count"),
        F.expr("if(doc_id % 4 = 0, filter(sequence(1, n), k -> k % 10 = 0), cast(array() as array<int>))").alias("repealed_articles"), F.expr("cast(doc_id % 4 as int)").alias("expected_chapter_headings"),
        F.expr("if(doc_id % 2 = 0, concat('L', doc_id, '.txt'), null)").alias("txt_filename"), F.expr("concat('L', doc_id, '.pdf')").alias("pdf_filename"), F.expr("if(doc_id % 41 = 0, array('فقد قضت'), cast(array() as array<string>))").alias("manual_marker_exclusions"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cheap article table: a source is a law, a document an article; numbers and ids repeat now and then. Texts are ranked, moved
    and stored once for an application and folder, as most queries read them."""
    return once(spark, f"articles of {sf_dir}", lambda: _articles(spark, sf_dir))


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranked(table(spark, sf_dir, "documents"), "rn", "source", "doc_id")
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return rows.select(
        "doc_id", F.col("source").alias("law_id"), F.expr("concat(source, '_', lpad(cast(if(doc_id % 50 = 3 and rn > 1, rn - 1, rn) as string), 6, '0'))").alias("article_id"), F.expr("if(doc_id % 20 = 7 and rn > 1, rn - 1, rn)").alias("article_number"),
        F.expr("concat('مادة ', rn)").alias("article_number_raw"), F.expr("if(rn <= 2, 'issuance', 'main')").alias("article_type"), "text", F.expr("case doc_id % 7 when 0 then 'bis' when 1 then 'paren_digit' else 'primary' end").alias("marker_kind"),
        F.expr("doc_id % 9 = 0").alias("is_repealed"), F.col("rn").alias("sequence_index"), F.col("doc_id").alias("ordinal"), words.alias("word_count"), F.length("text").alias("char_count"),
    )


def article_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    laws = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("law_id")).agg(F.count("*").cast("int").alias("n"))
    return laws.select("law_id", (F.col("n") + 3).alias("expected_article_count"), F.sequence(F.lit(10), F.lit(100), F.lit(10)).alias("repealed_articles"), F.when(F.length("law_id") % 2 == 0, F.col("law_id")).alias("txt_filename"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment of the documents that bear a label, as a client might have left it."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    rows = table(spark, sf_dir, "documents").join(labels, "doc_id")
    kinds = F.array(*[F.lit(c) for c in [*vocab.CATEGORIES, "غير"]])
    return rows.select(
        "doc_id", F.expr("if(doc_id % 11 = 0, '  ', left(text, 100))").alias("topic"), F.expr("if(doc_id % 13 = 0, cast(array() as array<string>), slice(split(text, ' '), 1, 3))").alias("keywords"), F.expr("left(text, 50)").alias("article_summary"),
        F.get(kinds, F.expr("cast(doc_id % 10 as int)")).alias("article_category"), F.expr("cast(array('x') as array<string>)").alias("legal_entities"), F.expr("if(toxic = 1, 'failed call', null)").alias("enrichment_error"),
        F.expr("case doc_id % 3 when 0 then 'completed' when 1 then 'failed' else '' end").alias("enrichment_status"), F.expr("case doc_id % 4 when 0 then null when 1 then 'm1' else 'm2' end").alias("enrichment_model"),
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles; those without metadata were never attempted."""
    known = metadata(spark, sf_dir).withColumn("_known", F.lit(True))
    out = articles(spark, sf_dir).join(known, "doc_id", "left")
    none = F.when(F.col("_known").isNull(), F.lit("not_reached")).otherwise(F.col("enrichment_error"))
    return out.withColumn("enrichment_error", none).drop("_known")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(F.col("event_type").alias("stage"), F.col("user_id").cast("string").alias("law_id"), F.expr("event_id % 5000").alias("input_tokens"), F.expr("cast(round(value * 100) as bigint)").alias("output_tokens"), F.expr("event_id % 3").alias("image_pages"), F.expr("concat('****', right(concat('key', user_id % 4), 3))").alias("api_key_suffix"))
