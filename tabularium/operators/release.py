"""Release statistics and metadata, cost ledger, and the summary of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from .confidence import rounded


def statistics(found: DataFrame, chunks: DataFrame) -> DataFrame:
    a = found.groupBy("law_id").agg(
        F.count("*").alias("total_articles"), F.count_if((F.col("article_type") == "main") & ~F.col("is_repealed")).alias("active_articles"), F.count_if(F.col("article_type") == "issuance").alias("issuance_articles"),
        F.count_if("is_repealed").alias("repealed_articles"), F.sum(F.col("word_count").cast("long")).alias("total_article_words"),
    )
    c = chunks.groupBy("law_id").agg(F.count("*").alias("total_chunks"), F.sum(F.col("word_count").cast("long")).alias("total_chunk_words"))
    out = a.join(c, "law_id", "left").na.fill(0, ["total_chunks", "total_chunk_words"])
    mean = lambda s, n: F.when(F.col(n) > 0, F.round(F.col(s) / F.when(F.col(n) > 0, F.col(n)), 1)).otherwise(F.lit(0.0))
    return out.withColumn("avg_words_per_article", mean("total_article_words", "total_articles")).withColumn("avg_words_per_chunk", mean("total_chunk_words", "total_chunks"))


def histogram(found: DataFrame, column: str, missing: str) -> DataFrame:
    return found.groupBy("law_id", F.coalesce(F.col(column), F.lit(missing)).alias(column)).agg(F.count("*").alias("n"))


def metadata(stats: DataFrame, categories: DataFrame, models: DataFrame, registry: DataFrame, exported_at: Column | None = None) -> DataFrame:
    """One JSON document a law, with what the registry knows of it. The maps are as large as the vocabularies."""
    as_map = lambda df, c, name: df.groupBy("law_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n")))).alias(name))
    known = {"law_name_ar": "string", "law_number": "string", "year": "int"}
    about = registry.select("law_id", *[(F.col(c) if c in registry.columns else F.lit(None)).cast(t).alias(c) for c, t in known.items()])
    out = stats.join(as_map(categories, "article_category", "article_categories"), "law_id", "left").join(as_map(models, "enrichment_model", "models_used"), "law_id", "left").join(about, "law_id")
    numbers = F.struct(*[c for c in stats.columns if c != "law_id"], "article_categories")
    files = F.struct(*[F.lit(v).alias(k) for k, v in vocab.RELEASE_FILES.items()])
    at = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'") if exported_at is None else exported_at
    document = F.struct(F.lit(vocab.RELEASE_SCHEMA).alias("schema_version"), "law_id", *known, at.alias("exported_at"), F.lit(True).alias("is_current_version"), numbers.alias("statistics"), F.struct("models_used").alias("enrichment"), files.alias("output_files"))
    return out.select("law_id", F.to_json(document, {"ignoreNullFields": "false"}).alias("metadata"))


def call_cost(tokens_in: Column, tokens_out: Column, pages: Column) -> Column:
    return tokens_in / F.lit(1_000_000.0) * vocab.PRICE_IN + tokens_out / F.lit(1_000_000.0) * vocab.PRICE_OUT + pages * F.lit(vocab.PRICE_IMAGE)


def total_cost(tokens_in: Column, tokens_out: Column, pages: Column) -> Column:
    """The cost of summed counts to six digits, halves up. It is counted in whole units of 1e-8, so the order of the calls doesn't matter."""
    units = tokens_in * round(vocab.PRICE_IN * 100) + tokens_out * round(vocab.PRICE_OUT * 100) + pages * round(vocab.PRICE_IMAGE * 1e8) + 50
    return (units - units % 100) / 100 / F.lit(1_000_000.0)


def ledger_totals(ledger: DataFrame, *by: str) -> DataFrame:
    """Calls, tokens, pages and cost by stage, key, law or anything else; with no key, in total."""
    cost = call_cost(F.col("input_tokens"), F.col("output_tokens"), F.col("image_pages"))
    return ledger.groupBy(*by).agg(F.count("*").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("image_pages").alias("image_pages"), F.round(F.sum(cost), 6).alias("cost_usd"))


def ledger_report(ledger: DataFrame, failures: DataFrame, rotations: DataFrame) -> DataFrame:
    """(scope, name, calls, ..., cost_usd, failures, rotations): a row for each stage, for each key, and one in total. ``failures`` has a row for
    each failed call (api_key_suffix), ``rotations`` one for each change of keys (from_key, to_key, reason). Keys that only failed have no calls."""
    sums = [f"total_{c}" for c in ("calls", "input_tokens", "output_tokens", "image_pages")]
    cost = total_cost(F.sum("input_tokens"), F.sum("output_tokens"), F.sum("image_pages"))
    kinds = F.grouping_id()
    used = ledger.groupingSets([[F.col("stage")], [F.col("api_key_suffix")], []], "stage", "api_key_suffix").agg(
        kinds.alias("_kind"), F.count("*").alias(sums[0]), *[F.sum(c.removeprefix("total_")).alias(c) for c in sums[1:]], cost.alias("cost_usd"))
    scope = F.when(F.col("_kind") == 1, "stage").when(F.col("_kind") == 2, "key").otherwise("total")
    used = used.select(scope.alias("scope"), F.when(F.col("_kind") == 1, F.col("stage")).when(F.col("_kind") == 2, F.col("api_key_suffix")).otherwise("").alias("name"), *sums, "cost_usd")
    lost = failures.groupingSets([[F.col("api_key_suffix")], []], "api_key_suffix").agg(F.grouping_id().alias("_kind"), F.count("*").alias("failures"))
    lost = lost.select(F.when(F.col("_kind") == 0, "key").otherwise("total").alias("scope"), F.when(F.col("_kind") == 0, F.col("api_key_suffix")).otherwise("").alias("name"), "failures")
    turned = rotations.agg(F.count("*").alias("rotations")).select(F.lit("total").alias("scope"), F.lit("").alias("name"), "rotations")
    out = used.join(lost, ["scope", "name"], "full").join(turned, ["scope", "name"], "full")
    return out.na.fill(0, [*sums, "failures", "rotations"]).na.fill(0.0, ["cost_usd"])


def batch_summary(results: DataFrame) -> DataFrame:
    """A row for each law and one (law_id null) over all: articles and chunks of the laws that went well, the cost of all."""
    ok = F.col("status") == "ok"
    return results.rollup("law_id").agg(F.sum(F.when(ok, F.coalesce("articles_found", F.lit(0))).otherwise(0)).alias("articles"), F.sum(F.when(ok, F.coalesce("chunks", F.lit(0))).otherwise(0)).alias("chunks"), rounded(F.sum("cost_usd")).alias("cost_usd"), F.count_if(ok).alias("ok"), F.count("*").alias("laws"))


def gated(results: DataFrame) -> DataFrame:
    """The status of a law after all gates: the first that failed, or ok."""
    return results.withColumn("status", F.when(~F.col("extracted"), "missing_source").when(~F.col("confident"), "confidence").when(~F.col("split_passed"), "split").when(~F.col("corpus_passed"), "validation").otherwise("ok"))
