"""What the operators of this subpackage share: the cluster's shared folder and safe reads of input columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stages import run_dir, shared_dir, stored, temporary

__all__ = ["columns", "free", "hot_join", "run_dir", "shared_dir", "stored", "table", "temporary"]


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """A table; with a ``key``, one that is too small to occupy all cores is dealt out to them."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores, key) if key and df.rdd.getNumPartitions() < cores else df


def free(names: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, all behind the fewest further underscores that keep them apart from ``names``: what an operator that keeps
    all columns of its input calls the columns that it adds."""
    have, mark = {n.lower() for n in names}, ""
    while any((mark + w).lower() in have for w in wanted):
        mark += "_"
    return [mark + w for w in wanted]


def hot_join(rows: DataFrame, table: DataFrame, key: str, count: str, least: int = 1000, most: int = 4096) -> DataFrame:
    """``rows.join(table, key)`` where a key may hold any share of ``rows``. ``count`` of the table tells how many rows a key has: its ``most``
    commonest keys (of ``least`` rows or more) are broadcast, so their rows stay where they are; every other key, with less than a
    ``most``-th of the rows, is joined by a shuffle. Both inputs are read several times: they should be stored tables or cheap."""
    hot = table.filter(F.col(count) >= least).orderBy(F.desc(count), key).limit(most)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table, key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def columns(df: DataFrame, **types: str) -> DataFrame:
    """Exactly the named columns with the named types; columns that are missing read as null, others are left out."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
