"""Several versions of a law: the time each is in force, what was in force at a moment, and what changed from one version to the next.

Everything is places and equi-joins: no window or interval join over a law, which may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stages import stored
from .places import ranked


def intervals(versions: DataFrame) -> DataFrame:
    """``versions`` (law_id, version_id, valid_from) with ``version_no`` from 1, ``valid_to`` (when the next begins; null if there is none) and ``is_current``. Versions of a law that begin at
    one moment are in the order of their ids; all but the last of them are in force for no time. Rows without a law or a beginning are left out."""
    rows = stored(ranked(versions.filter("law_id is not null and valid_from is not null"), "version_no", "law_id", "valid_from", "version_id"), "versions")
    after = rows.select("law_id", (F.col("version_no") - 1).alias("version_no"), F.col("valid_from").alias("valid_to"), F.lit(True).alias("_more"))
    return rows.join(after, ["law_id", "version_no"], "left").withColumn("is_current", F.col("_more").isNull()).drop("_more")


def as_of(asks: DataFrame, versions: DataFrame) -> DataFrame:
    """``asks`` (ask_id, law_id, at; each of the three is looked at) with ``version_no`` and ``version_id`` of the version in force then: the last that began at or before that moment; null before the first and for a law
    without versions. ``versions`` as ``intervals`` gives them.

    An ask's place among the asks and versions of its law, less its place among the asks, is how many versions had begun. Equal asks are one; an ask without
    law or moment has no version."""
    whole = F.col("law_id").isNotNull() & F.col("at").isNotNull()
    mark = asks.filter(whole & F.col("ask_id").isNotNull()).distinct().select("law_id", "at", F.lit(1).alias("kind"), "ask_id")
    begun = versions.select("law_id", F.col("valid_from").alias("at"), F.lit(0).alias("kind"), F.col("version_id").alias("ask_id"))
    among = ranked(mark.unionByName(begun), "_all", "law_id", "at", "kind", "ask_id").filter("kind = 1").select("law_id", "at", "ask_id", "_all")
    alone = ranked(mark, "_own", "law_id", "at", "ask_id").select("law_id", "at", "ask_id", "_own")
    placed = among.join(alone, ["law_id", "at", "ask_id"]).select("ask_id", "law_id", "at", (F.col("_all") - F.col("_own")).alias("version_no"))
    found = placed.join(versions.select("law_id", "version_no", "version_id"), ["law_id", "version_no"], "left")
    found = found.select("ask_id", "law_id", "at", F.when(F.col("version_id").isNotNull(), F.col("version_no")).alias("version_no"), "version_id")
    lost = asks.filter(~whole | F.col("ask_id").isNull()).distinct()
    return found.unionByName(lost.select("ask_id", "law_id", "at"), allowMissingColumns=True)


def changes(articles: DataFrame) -> DataFrame:
    """(law_id, version_no, n_articles, n_unchanged, n_amended, n_added, n_removed) for each version of ``articles`` (law_id, version_no, number, text), against the version before it. Articles meet by number;
    texts are compared by hash, so none is moved. A number occurs once in a version."""
    rows = articles.select("law_id", "version_no", "number", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_now"))
    before = rows.select("law_id", (F.col("version_no") + 1).alias("version_no"), "number", F.col("_now").alias("_was"))
    here = articles.select("law_id", "version_no").distinct()
    both = rows.join(before, ["law_id", "version_no", "number"], "full").withColumns({"_new": F.col("_now").isNotNull(), "_old": F.col("_was").isNotNull()})
    count = lambda c: F.count(F.when(c, 1))
    new, old, same = F.col("_new"), F.col("_old"), F.col("_now") == F.col("_was")
    counted = both.groupBy("law_id", "version_no").agg(
        count(new).alias("n_articles"), count(new & old & same).alias("n_unchanged"), count(new & old & ~same).alias("n_amended"), count(new & ~old).alias("n_added"), count(old & ~new).alias("n_removed")
    )
    return counted.join(here, ["law_id", "version_no"], "left_semi")
