"""Rule checks of enriched articles: up to several issues a row, none after a failed enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab


def issues(enriched: DataFrame, registry: DataFrame) -> DataFrame:
    """(law_id, article_id, code, field, severity, message) from articles with metadata and the registry's repealed numbers."""
    rows = enriched.join(registry.select("law_id", "repealed_articles"), "law_id", "left")
    blank = lambda c: T.utrim(F.coalesce(F.col(c), F.lit(""))) == ""
    text = lambda code, *values: F.format_string(vocab.CORPUS_ISSUES[code], *values).alias("message")
    issue = lambda when, code, field, severity, *values: F.when(when, F.struct(F.lit(code).alias("code"), F.lit(field).alias("field"), F.lit(severity).alias("severity"), text(code, *values)))
    failed = F.coalesce(F.col("enrichment_error"), F.lit("")) != ""
    gone = F.coalesce(F.array_contains("repealed_articles", F.col("article_number")), F.lit(False))
    category = F.col("article_category")
    kinds = F.lit("['" + "', '".join(sorted(vocab.CATEGORIES)) + "']")
    flag = F.coalesce("is_repealed", F.lit(False))
    rest = [
        *[issue(blank(f), "V001", f, "error", F.lit(f)) for f in ("topic", "article_summary", "article_category")],
        issue(F.coalesce(F.size("keywords"), F.lit(0)) <= 0, "V005", "keywords", "warning"),
        issue((F.coalesce(category, F.lit("")) != "") & ~category.isin(vocab.CATEGORIES), "V002", "article_category", "warning", category, kinds),
        issue(F.col("article_number").isNotNull() & (gone != flag), "V004", "is_repealed", "warning", F.when(flag, "True").otherwise("False"), F.when(gone, "repealed").otherwise("active")),
    ]
    found = F.when(failed, F.array(issue(failed, "V003", "enrichment_error", "error", F.col("enrichment_error")))).otherwise(F.array_compact(F.array(*rest)))
    return rows.select("law_id", "article_id", F.explode(found).alias("i")).select("law_id", "article_id", "i.*")


def first(found: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` errors by law and article, for a log."""
    return found.filter("severity = 'error'").orderBy("law_id", "article_id", "code", "field").limit(n)


def summary(found: DataFrame) -> DataFrame:
    error, warning = F.col("severity") == "error", F.col("severity") == "warning"
    return found.groupBy("code").agg(F.count("*").alias("n"), F.count_if(error).alias("errors"), F.count_if(warning).alias("warnings"))


def gate(found: DataFrame, laws: DataFrame) -> DataFrame:
    n = found.groupBy("law_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    out = laws.select("law_id").distinct().join(n, "law_id", "left")
    return out.select("law_id", F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("warnings", F.lit(0)).alias("warnings"), (F.coalesce("errors", F.lit(0)) == 0).alias("passed"))
