"""Checks of a split: gaps, duplicates, empty and oversized articles, preambles and counts. All laws at once; joins are equi-joins on the law."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab
from ..sources.stages import stored

ISSUE = ["law_id", "code", "severity", "article_number", "article_id", "name", "description"]


def _described(code: str, *values: Column) -> Column:
    """(code, name, description) of an issue; the values go into its text in order."""
    name, form = vocab.SPLIT_ISSUES[code]
    return F.struct(F.lit(code).alias("code"), F.lit(name).alias("name"), F.format_string(form, *values).alias("description"))


def _issues(df: DataFrame, issue: Column, severity: str, number: Column | None = None, article: Column | None = None) -> DataFrame:
    none = F.lit(None)
    rows = df.select("law_id", issue.alias("_i"), F.lit(severity).alias("severity"), (none if number is None else number).cast("long").alias("article_number"), (none if article is None else article).cast("string").alias("article_id"))
    return rows.select("law_id", "_i.code", "severity", "article_number", "article_id", "_i.name", "_i.description")


def _percent(part: Column, whole: Column) -> Column:
    """A share as a percentage with one digit, halves to even, by whole numbers only. No share of nothing."""
    whole = F.when(whole > 0, whole.cast("long"))
    scaled = part.cast("long") * 1000
    down, rest = F.floor(scaled / whole), (scaled % whole) * 2
    tenths = down + F.when((rest > whole) | ((rest == whole) & (down % 2 == 1)), 1).otherwise(0)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%"))


def duplicates(found: DataFrame) -> DataFrame:
    """Numbers that several main articles bear, bis articles apart, with their ids in order of their places. All articles of a law come from one row's text, so the
    ids of a number are bounded by it."""
    main = found.filter("article_type = 'main' and marker_kind <> 'bis'")
    ids = F.transform(F.array_sort(F.collect_list(F.struct(F.length("article_id").alias("n"), "article_id"))), lambda x: x["article_id"])
    again = main.groupBy("law_id", "article_number").agg(F.count("*").alias("n"), ids.alias("ids")).filter("n > 1")
    listed = F.concat(F.lit("['"), F.array_join("ids", "', '"), F.lit("']"))
    return _issues(again, _described("E002", F.col("article_number"), F.col("n"), listed), "error", F.col("article_number"))


def missing(found: DataFrame, registry: DataFrame) -> DataFrame:
    """Expected numbers that are neither found nor repealed: a gap (E003) if a neighbour is there, else missing (E001). Numbers meet within their law's row, as in
    ``duplicates``; the one join is of laws and merges, as a small file may hold too many rows to broadcast."""
    main = F.when(F.col("article_type") == "main", F.col("article_number"))
    numbers = found.groupBy("law_id").agg(F.count_if(F.col("article_type") == "issuance").alias("issuance"), F.max(main).alias("most"), F.collect_set(main).alias("there"))
    known = registry.select("law_id", "expected_article_count", F.coalesce("repealed_articles", F.array().cast("array<int>")).alias("repealed")).join(numbers.hint("merge"), "law_id")
    upto = F.greatest(F.col("expected_article_count") - F.col("issuance"), F.coalesce("most", F.lit(0))).cast("int")
    wanted = F.array_except(F.array_except(F.sequence(F.lit(1), F.col("upto")), "repealed"), "there")
    beside = F.array_union(F.transform("there", lambda n: n - 1), F.transform("there", lambda n: n + 1))
    gone = known.withColumn("upto", upto).filter("upto >= 1").select("law_id", wanted.alias("gone"), beside.alias("beside"))
    coded = lambda code, ns: F.transform(ns, lambda n: F.struct(n.alias("n"), F.lit(code).alias("code")))
    parted = F.concat(coded("E003", F.array_intersect("gone", "beside")), coded("E001", F.array_except("gone", "beside")))
    rows = gone.select("law_id", F.explode_outer(parted).alias("_m")).filter("_m is not null")  # outer as in split.articles
    number = F.col("_m.n")
    return _issues(rows, F.when(F.col("_m.code") == "E003", _described("E003", number)).otherwise(_described("E001", number)), "error", number)


def bodies(found: DataFrame) -> DataFrame:
    """Near-empty bodies (E004), and bodies of more words than five medians and 500 (E005). Three steps look at the articles; their sizes are measured once, as a stage
    table without texts, and only laws that have an article of more than 500 words need a median."""
    names = ["law_id", "article_number", "article_id", "word_count"]
    if "bare_chars" in found.columns:  # measured and stored before
        sizes = found.select(*names, F.col("char_count").alias("_chars"), F.col("bare_chars").alias("_bare"))
    else:
        sizes = stored(found.select(*names, F.length("text").alias("_chars"), F.length(T.utrim(F.col("text"))).alias("_bare")), "sizes")
    empty = _issues(sizes.filter("_bare < 5"), _described("E004", F.col("_chars")), "error", F.col("article_number"), F.col("article_id"))
    long = sizes.filter("word_count > 500")
    middle = sizes.filter("word_count > 0").join(long.select("law_id").distinct(), "law_id", "left_semi").groupBy("law_id").agg(F.median("word_count").alias("m"))
    most = F.greatest(F.col("m") * 5, F.lit(500.0))
    large = long.join(middle, "law_id").filter(F.col("word_count") > most)
    text = _described("E005", F.col("article_number"), F.col("word_count"), F.bround("m").cast("long"), F.bround(most).cast("long"))
    return empty.unionByName(_issues(large, text, "warning", F.col("article_number"), F.col("article_id")))


def counts(report: DataFrame) -> DataFrame:
    """Large preambles (E006), too many (W001) or too few (W002) articles, no issuance article in a large law (W003)."""
    found, expected = F.col("articles_found"), F.col("expected_article_count")
    ratio = found / F.when(expected > 0, expected)
    counted = (found, expected, _percent(found, expected))
    rules = [
        (F.col("orphan_text_chars") > 800, _described("E006", F.col("orphan_text_chars"))), (ratio > 1.10, _described("W001", *counted)), (ratio < 0.90, _described("W002", *counted)),
        ((F.col("issuance_count") == 0) & (expected >= 50), _described("W003", expected)),
    ]
    hit = F.array_compact(F.array(*[F.when(rule, issue) for rule, issue in rules]))
    return _issues(report.select("law_id", F.explode(hit).alias("i")), F.col("i"), "warning")


def all_issues(found: DataFrame, report: DataFrame, registry: DataFrame) -> DataFrame:
    return duplicates(found).unionByName(missing(found, registry)).unionByName(bodies(found)).unionByName(counts(report))


def gate(issues: DataFrame, laws: DataFrame) -> DataFrame:
    """Errors and warnings of each law, and whether it passes: no error."""
    n = issues.groupBy("law_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    out = laws.select("law_id").join(n, "law_id", "left")
    return out.select("law_id", F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("warnings", F.lit(0)).alias("warnings"), (F.coalesce("errors", F.lit(0)) == 0).alias("passed"))
