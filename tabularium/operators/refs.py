"""Cross references between articles: extraction, within a row, and resolution, by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.stages import run_dir, stored, temporary

_NUMBER = "[٠-٩۰-۹0-9]{1,4}"
_SPAN = rf"(?U)(?=الم)(?:المواد|المادتين|المادة)\s*(?:البند\s*\([^)]+\)\s*من\s*المادة\s*)?\(?(?:{_NUMBER})?\)?(?:\s*[،,و\s]+\(?(?:{_NUMBER})?\)?)*+"


def cross_refs(text: Column) -> Column:
    """array<struct<ref_text, article_numbers, same_law>>: each phrase with the numbers that no phrase before it names. A number is
    1 to 9999, four digits at most; a phrase without a new number is left out."""
    spans = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_SPAN), F.lit(0))
    numbers = lambda s: F.filter(F.transform(F.regexp_extract_all(s, F.lit(_NUMBER), F.lit(0)), T.to_int), lambda n: n.between(1, 9999))
    ref_type = "array<struct<ref_text:string,article_numbers:array<int>,same_law:boolean>>"

    def fold(a: Column, s: Column) -> Column:
        fresh = F.array_except(numbers(s), a["seen"])
        clean = T.utrim(F.regexp_replace(T.one_spaced(s), rf"(?U)[\s\x1c-\x1f،,وأ]+$", ""))
        ref = F.struct(clean.alias("ref_text"), fresh.alias("article_numbers"), F.lit(True).alias("same_law"))
        more = F.struct(F.concat(a["seen"], fresh).alias("seen"), F.concat(a["out"], F.array(ref)).alias("out"))
        return F.when(F.size(fresh) > 0, more).otherwise(a)

    start = F.struct(F.array().cast("array<int>").alias("seen"), F.array().cast(ref_type).alias("out"))
    return F.aggregate(F.filter(spans, lambda s: s.rlike(_NUMBER)), start, fold, lambda a: a["out"])


def number_index(assembled: DataFrame) -> DataFrame:
    """(law_id, number, article_id): the last article of a number in release order, so issuance over main and later over earlier."""
    order = F.struct((F.col("article_type") == "issuance").alias("i"), F.col("ordinal"))
    rows = assembled.filter("article_number is not null")
    return rows.groupBy("law_id", F.col("article_number").alias("number")).agg(F.max_by("article_id", order).alias("target"))


def dangling(assembled: DataFrame) -> DataFrame:
    """(law_id, article_id, number, repealed): numbers that an article refers to and that no article of its law has (``repealed`` false), or only a repealed one.
    Numbers of one article are told once; the index has a row for each law and number, so a number that all articles cite is joined by Spark's skew join."""
    cited = assembled.select("law_id", "article_id", F.explode("cross_refs").alias("ref")).select("law_id", "article_id", F.explode("ref.article_numbers").alias("number")).distinct()
    there = assembled.filter("article_number is not null").groupBy("law_id", F.col("article_number").alias("number")).agg(F.bool_and(F.coalesce("is_repealed", F.lit(False))).alias("repealed"))
    out = cited.join(there, ["law_id", "number"], "left").filter("repealed is null or repealed")
    return out.select("law_id", "article_id", "number", F.coalesce("repealed", F.lit(False)).alias("repealed"))


def edges(assembled: DataFrame) -> DataFrame:
    """(law_id, article_id, target): each article with every other one that it refers to, once."""
    cited = assembled.select("law_id", "article_id", F.explode("cross_refs").alias("ref")).select("law_id", "article_id", F.explode("ref.article_numbers").alias("number"))
    return cited.join(number_index(assembled), ["law_id", "number"]).filter("target <> article_id").select("law_id", "article_id", "target").distinct()


def reaching(links: DataFrame, goals: DataFrame) -> DataFrame:
    """(law_id, article_id, steps): the ``goals`` (law_id, article_id; steps 0) and all articles from which ``links`` lead to one, with the fewest links
    on the way. Semi-naive: each round joins only what the round before found, so every link is followed once, cycles end by themselves, and a
    round costs its frontier and one look at the articles found so far. As many rounds as the longest of these ways. Rows with a null are left out."""
    spark, place = links.sparkSession, run_dir(links.sparkSession, "reaching")
    temporary(spark, place)
    links = stored(links.select("law_id", "article_id", "target").na.drop(), "links")
    keys, fields, steps = ["law_id", "article_id"], "law_id string, article_id string", 0
    frontier = goals.select(*keys).na.drop().distinct()
    while True:
        frontier.write.parquet(f"{place}/steps={steps}")
        new = spark.read.schema(fields).parquet(f"{place}/steps={steps}")
        found = spark.read.schema(f"{fields}, steps int").option("basePath", place).parquet(place)
        if new.isEmpty():
            return found
        back = links.join(new.withColumnRenamed("article_id", "target"), ["law_id", "target"]).select(*keys).distinct()
        frontier, steps = back.join(found.select(*keys), keys, "left_anti"), steps + 1


def resolved(assembled: DataFrame) -> DataFrame:
    """(law_id, article_id, ref_no, ref_text, target_article_ids): targets in the order of the numbers, null if there is none."""
    refs = assembled.select("law_id", "article_id", F.posexplode("cross_refs").alias("ref_no", "ref"))
    numbers = refs.select("law_id", "article_id", "ref_no", F.col("ref.ref_text").alias("ref_text"), F.posexplode_outer("ref.article_numbers").alias("k", "number"))
    found = numbers.join(number_index(assembled), ["law_id", "number"], "left")
    hits = F.array_sort(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("k", "target"))))
    out = found.groupBy("law_id", "article_id", "ref_no", "ref_text").agg(F.transform(hits, lambda x: x["target"]).alias("t"))
    return out.select("law_id", "article_id", "ref_no", "ref_text", F.when(F.size("t") > 0, F.col("t")).alias("target_article_ids"))
