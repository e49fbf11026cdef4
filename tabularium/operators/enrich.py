"""Metadata from an external client: work lists, batches, prompts, replies, fallbacks, merge and report.

The client is any ``Callable[[Iterator[pandas.DataFrame]], Iterator[pandas.DataFrame]]`` given to ``called``; everything else is relational.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..functions import vocab
from ..sources.stages import stored
from . import release, replies
from .places import ranked

#: Bits of a node within a batch: 2 * ``size`` nodes at most.
_NODE_BITS = 24

#: Requests that a client sees at once.
PROMPTS = 16

METADATA = "article_id string, topic string, keywords array<string>, article_summary string, article_category string, legal_entities array<string>, concepts array<string>, applicable_to array<string>"


def trusted(cache: DataFrame) -> DataFrame:
    """Cached rows that count: completed, or from before the status was kept, with a model and without an error."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return cache.filter((F.col("enrichment_status") == "completed") | (blank("enrichment_status") & ~blank("enrichment_model") & blank("enrichment_error")))


def work_list(found: DataFrame, cache: DataFrame, force: bool = False) -> DataFrame:
    return found if force else found.join(trusted(cache).select("article_id").distinct(), "article_id", "left_anti")


def batched(work: DataFrame, size: int = vocab.BATCH_SIZE) -> DataFrame:
    """Work with ``batch``: consecutive articles of a law, ``size`` each."""
    at = ranked(work, "_at", "law_id", "sequence_index", "article_id")
    return at.withColumn("batch", F.floor((F.col("_at") - 1) / size).cast("long")).drop("_at")


def halves(failed: DataFrame) -> DataFrame:
    """What a failed batch is missing, in parts of half its size, two at least."""
    by = Window.partitionBy("law_id", "batch")
    n = F.count("*").over(by)
    at = F.row_number().over(by.orderBy("sequence_index")) - 1
    size = F.greatest(F.lit(2), F.floor(n / 2))
    return failed.select("*", n.alias("_n"), F.floor(at / size).cast("long").alias("part")).filter("_n > 1").drop("_n")


def prompts(batches: DataFrame, laws: DataFrame) -> DataFrame:
    """(law_id, batch, count, prompt): an element for each article, in order. A batch is bounded by its size."""
    text = T.utrim(F.coalesce("text", F.lit("")))
    block = F.concat(F.lit('  <article id="'), "article_id", F.lit('" type="'), F.coalesce("article_type", F.lit("main")), F.lit('" words="'), T.word_count(text).cast("string"), F.lit('">\n'), text, F.lit("\n  </article>"))
    rows = batches.select("law_id", "batch", F.struct("sequence_index", block.alias("block")).alias("b"))
    joined = rows.groupBy("law_id", "batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["block"]), "\n").alias("blocks"), F.count("*").alias("count"))
    head = F.concat(F.lit('<articles law="'), "law_id", F.lit('" count="'), F.col("count").cast("string"), F.lit('">\n'), "blocks", F.lit("\n</articles>"))
    return joined.join(laws.select("law_id"), "law_id").select("law_id", "batch", "count", head.alias("prompt"))


def stub_client(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stands in for a client, offline: metadata from the words of each article in the prompt."""
    import re

    for frame in frames:
        replies = []
        for prompt in frame["prompt"]:
            items = re.findall(r'<article id="([^"]*)"[^>]*>\n(.*?)\n *</article>', prompt, re.S)
            replies.append(json.dumps([{"article_id": i, "topic": t[:100], "keywords": t.split()[:3], "article_summary": t[:200], "article_category": vocab.OTHER, "legal_entities": [], "concepts": [], "applicable_to": []} for i, t in items], ensure_ascii=False))
        yield frame.assign(reply=replies, error=None)


def failing_client(most: int) -> Callable:
    """A client for trials: the offline one, which fails on prompts of more than ``most`` articles and leaves the first of several out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in stub_client(frames):
            large = frame["count"] > most
            partly = [json.dumps(json.loads(r)[1:], ensure_ascii=False) if n > 1 else r for r, n in zip(frame["reply"], frame["count"], strict=True)]
            yield frame.assign(reply=[None if x else r for x, r in zip(large, partly, strict=True)], error=["too many articles" if x else None for x in large])

    return run


def refusing_client(pattern: str) -> Callable:
    """A client for trials: the offline one, which refuses prompts that the pattern occurs in."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in stub_client(frames):
            bad = frame["prompt"].str.contains(pattern, regex=True)
            yield frame.assign(reply=frame["reply"].where(~bad, None), error=bad.map({True: "refused", False: None}))

    return run


def few(client: Callable, rows: int = PROMPTS) -> Callable:
    """``client`` on frames of ``rows`` requests at most, so that a worker holds few answers at once, however large the batches are that it is given."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return client(frame.iloc[at : at + rows] for frame in frames for at in range(0, len(frame), rows))

    return run


def called(requests: DataFrame, client: Callable = stub_client) -> DataFrame:
    """(law_id, batch, count, prompt, reply, error): the only step that may leave the cluster."""
    return requests.mapInPandas(few(client), StructType([*requests.schema.fields]).add("reply", "string").add("error", "string"))


def _asked(requests: DataFrame, client: Callable, log: str | None, model: str, keep: bool = True) -> DataFrame:
    """A level's answers as a stage table, prompts only where they are to be kept; with a ``log``, what it has answered readably is not asked again."""
    if log is None:
        answers = called(requests, client)
        return stored(answers if keep else answers.drop("prompt"), "replies")
    readable = F.from_json("reply", "array<struct<article_id:string>>").isNotNull()
    return replies.asked(requests, lambda r: called(r, client), log, model, readable)


def checked_concepts(given: Column, known: Column | None = None) -> Column:
    """(valid, unknown): concepts brought into form, and whether the vocabulary has them. Without one all are valid."""
    given = F.filter(F.coalesce(given, F.array().cast("array<string>")), lambda c: T.utrim(c) != "")
    named = F.transform(given, lambda c: F.replace(F.lower(T.utrim(c)), F.lit(" "), F.lit("_")))
    if known is None:
        return F.struct(named.alias("valid"), F.slice(named, F.lit(1), F.lit(0)).alias("unknown"))
    return F.struct(F.filter(named, lambda c: F.array_contains(known, c)).alias("valid"), F.filter(named, lambda c: ~F.array_contains(known, c)).alias("unknown"))


def coerced(items: DataFrame, concepts: Column | None = None) -> DataFrame:
    """Replies' items brought into form: unknown categories become other, lists are cut, concepts and domains filtered."""
    strings = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    cut = lambda c, n, k: F.transform(F.slice(strings(c), F.lit(1), F.lit(k)), lambda x: F.left(x, F.lit(n)))
    kinds = F.when(F.col("article_category").isin(vocab.CATEGORIES), F.col("article_category")).otherwise(F.lit(vocab.OTHER))
    valid = checked_concepts(F.col("concepts"), concepts)["valid"]
    domains = F.filter(F.transform(strings("applicable_to"), lambda a: F.lower(T.utrim(a))), lambda a: a.isin(vocab.DOMAINS))
    return items.filter("coalesce(article_id, '') <> ''").select(
        "article_id", F.left(F.coalesce("topic", F.lit("")), F.lit(100)).alias("topic"), cut("keywords", 80, 10).alias("keywords"), F.left(F.coalesce("article_summary", F.lit("")), F.lit(600)).alias("article_summary"),
        kinds.alias("article_category"), cut("legal_entities", 80, 15).alias("legal_entities"), F.slice(valid, F.lit(1), F.lit(10)).alias("concepts"), F.slice(domains, F.lit(1), F.lit(5)).alias("applicable_to"),
    )


def parsed(replies: DataFrame, concepts: Column | None = None) -> DataFrame:
    """Rows of all readable replies, in form."""
    items = F.explode(F.from_json("reply", f"array<struct<{METADATA.replace(' string', ':string').replace(' array', ':array')}>>"))
    return coerced(replies.select(items.alias("i")).select("i.*"), concepts)


def single_prompts(work: DataFrame) -> DataFrame:
    """(law_id, batch, count, prompt) with one article each, as the last resort."""
    text = T.utrim(F.coalesce("text", F.lit("")))
    prompt = F.concat(F.lit('<article id="'), "article_id", F.lit('" type="'), F.coalesce("article_type", F.lit("main")), F.lit('" law="'), "law_id", F.lit('">\n'), text, F.lit("\n  </article>"))
    return work.select("law_id", F.col("sequence_index").cast("long").alias("batch"), F.lit(1).cast("long").alias("count"), prompt.alias("prompt"))


def semantic_prompts(long: DataFrame, limit: int = vocab.CHUNK_WORDS) -> DataFrame:
    """(article_id, prompt) that ask a client to cut long articles into parts of ``limit`` words at most."""
    text = T.utrim(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit('<article id="'), "article_id", F.lit('" law="'), "law_id", F.lit('" words="'), T.word_count(text).cast("string"), F.lit('" limit="'), F.lit(str(limit)), F.lit('">\n'))
    return long.filter(T.word_count(text) > limit).select("article_id", F.concat(head, text, F.lit("\n</article>")).alias("prompt"))


def none(spark: SparkSession) -> DataFrame:
    """No metadata at all, in the form of ``cascade``."""
    return spark.createDataFrame([], METADATA + ", enrichment_model string, enrichment_status string, enrichment_error string")


def cascade(work: DataFrame, laws: DataFrame, client: Callable = stub_client, size: int = vocab.BATCH_SIZE, model: str = "primary", concepts: Column | None = None, log: str | None = None) -> DataFrame:
    """Metadata of all articles of a work list: whole batches, then halves of batches that failed altogether, then one by one; what is still
    missing is a row with an error. Each level's answers are a stage table, so no call is made twice; with a ``log`` (a folder) they also outlive a run that breaks.

    Of a batch that was answered in part, the rest goes one by one at once."""
    batches = batched(work, size)
    first = _asked(prompts(batches, laws), client, log, model)
    got = parsed(first, concepts)
    left = batches.join(got.select("article_id"), "article_id", "left_anti")
    broken = first.filter(F.col("error").isNotNull() | F.col("reply").isNull()).select("law_id", "batch")
    parts = halves(left.join(broken, ["law_id", "batch"], "left_semi"))
    second = _asked(prompts(parts.withColumn("batch", F.col("batch") * 1_000_000 + F.col("part")), laws), client, log, model)
    got = got.unionByName(parsed(second, concepts))
    rest = batches.join(got.select("article_id"), "article_id", "left_anti")
    third = _asked(single_prompts(rest), client, log, model)
    alone = parsed(third, concepts)
    done = got.unionByName(alone).withColumns({"enrichment_model": F.lit(model), "enrichment_status": F.lit("completed"), "enrichment_error": F.lit(None).cast("string")})
    # The id is in the prompt, so that equal places in a law can't be mixed up.
    asked = third.select(F.regexp_extract("prompt", '^<article id="([^"]*)"', 1).alias("article_id"), "error")
    lost = asked.join(alone.select("article_id"), "article_id", "left_anti").groupBy("article_id").agg(F.max("error").alias("error"))
    # An answer that can't be read leaves an error without the state; a call that failed is marked failed.
    status = F.when(F.col("error").isNull(), F.lit("")).otherwise(F.lit("failed"))
    empty = F.array().cast("array<string>")
    rows = lost.select(
        "article_id", F.lit("").alias("topic"), empty.alias("keywords"), F.lit("").alias("article_summary"), F.lit("").alias("article_category"), empty.alias("legal_entities"), empty.alias("concepts"),
        empty.alias("applicable_to"), F.lit(model).alias("enrichment_model"), status.alias("enrichment_status"), F.coalesce("error", F.lit("unreadable reply")).alias("enrichment_error"),
    )
    return done.unionByName(rows)


def bisected(work: DataFrame, laws: DataFrame, client: Callable = stub_client, size: int = vocab.BATCH_SIZE, concepts: Column | None = None, log: str | None = None, model: str = "primary") -> tuple[DataFrame, DataFrame]:
    """(metadata, calls) by halving what isn't answered, until nothing is left: one bad article of n costs some 2 * log2(n) calls, not n.

    The frontier is a table of articles with the node (root 1, halves 2k and 2k + 1) of the batch whose call they are in. All nodes of a level are asked at
    once; each level's answers are a stage table, so a lost executor repeats no call. What a call leaves out is halved, in order;
    a node of one article is asked by itself and, if it fails, stays without metadata. At most log2(``size``) + 1 levels. ``calls``: (law_id, batch, node,
    level, count, error)."""
    frontier = batched(work, size).withColumn("node", F.lit(1).cast("long"))
    level, got, calls = 0, None, None
    while True:
        alone = F.count("*").over(Window.partitionBy("law_id", "batch", "node")) == 1  # ``size`` rows at most
        frontier = stored(frontier.withColumn("_alone", alone), "frontier")
        if frontier.isEmpty():
            break
        many = frontier.filter("not _alone")
        packed = frontier.withColumn("batch", F.shiftleft("batch", _NODE_BITS) + F.col("node"))
        one = packed.filter("_alone").drop("sequence_index").withColumn("sequence_index", F.col("batch"))  # a single prompt's batch is its place
        asked = prompts(packed.filter("not _alone"), laws).unionByName(single_prompts(one))
        answers = _asked(asked, client, log, model, keep=False)
        fresh = parsed(answers, concepts).dropDuplicates(["article_id"])
        told = answers.select("law_id", F.shiftright("batch", _NODE_BITS).alias("batch"), F.col("batch").bitwiseAND(F.lit((1 << _NODE_BITS) - 1)).alias("node"), F.lit(level).alias("level"), "count", "error")
        got, calls = fresh if got is None else got.unionByName(fresh), told if calls is None else calls.unionByName(told)
        left = many.join(fresh.select("article_id"), "article_id", "left_anti").drop("_alone")
        by = Window.partitionBy("law_id", "batch", "node")
        second = F.row_number().over(by.orderBy("sequence_index", "article_id")) > F.floor(F.count("*").over(by) / 2)
        frontier, level = left.withColumn("node", F.col("node") * 2 + second.cast("long")), level + 1
    empty = work.sparkSession.createDataFrame([], METADATA), work.sparkSession.createDataFrame([], "law_id string, batch long, node long, level int, count long, error string")
    return (empty[0] if got is None else got), (empty[1] if calls is None else calls)


def merged(found: DataFrame, fresh: DataFrame, cache: DataFrame) -> DataFrame:
    """Articles with metadata: fresh before cached before none (error ``not_reached``)."""
    names = ["topic", "article_category", "enrichment_model", "enrichment_status", "enrichment_error"]
    new = fresh.select("article_id", F.struct(*names).alias("_f"))
    old = trusted(cache).select("article_id", F.struct(*names).alias("_c"))
    none = F.struct(F.lit("").alias("topic"), F.lit("").alias("article_category"), F.lit(None).cast("string").alias("enrichment_model"), F.lit("").alias("enrichment_status"), F.lit("not_reached").alias("enrichment_error"))
    out = found.join(new, "article_id", "left").join(old, "article_id", "left").withColumn("_m", F.coalesce("_f", "_c", none))
    source = F.when(F.col("_f").isNotNull(), "fresh").when(F.col("_c").isNotNull(), "cache").otherwise("none")
    return out.select(*found.columns, source.alias("metadata_source"), "_m.*")


def report(merged_rows: DataFrame) -> DataFrame:
    failed = F.col("enrichment_error").isNotNull() & (F.col("enrichment_error") != "")
    fresh = F.col("metadata_source") == "fresh"
    return merged_rows.groupBy("law_id").agg(F.count("*").alias("total_articles"), F.count_if(fresh & ~failed).alias("enriched"), F.count_if(F.col("metadata_source") == "cache").alias("skipped_cache"), F.count_if(fresh & failed).alias("failed"))


def run_report(merged_rows: DataFrame, ledger: DataFrame, model: str, size: int = vocab.BATCH_SIZE, stage: str = "stage_3") -> DataFrame:
    """The report of a run: with its calls and their cost from the ledger, the model and the batch size."""
    spent = ledger.filter(F.col("stage") == stage)
    cost = release.total_cost(F.sum("input_tokens"), F.sum("output_tokens"), F.sum("image_pages"))
    by_law = spent.groupBy("law_id").agg(F.count("*").alias("total_api_calls"), cost.alias("total_cost_usd"))
    out = report(merged_rows).join(by_law, "law_id", "left").na.fill(0, ["total_api_calls"]).na.fill(0.0, ["total_cost_usd"])
    return out.withColumns({"model": F.lit(model), "batch_size": F.lit(size)})
