"""Places in a total order, and ranks within groups, by distributed prefix sums: no window over a group and no group in one task.

Rows are range-partitioned and sorted by the order, written once, and bear their partition and their row in it. Counts by partition, one number each,
are added up on the driver and give each partition's first place. A rank within a group is a row's place less the first place of
the group. A group of any size is sorted by as many tasks as its rows need; rows that agree in the whole order get places of their own.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stages import stored

#: ``monotonically_increasing_id`` has the partition above these bits and the row in it below.
_BITS = 33
#: Groups whose first places are broadcast at most.
GROUPS = 1 << 16


def placed(rows: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """``rows`` with their place, from 0, in the order (nulls first, as ascending columns sort)."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    held = stored(sorted_.withColumn(name, F.monotonically_increasing_id()), "placed")
    part = F.shiftright(name, _BITS).cast("int")
    counts = sorted((r["part"], r["n"]) for r in held.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one row a partition
    first = accumulate([0, *(n for _, n in counts)])
    offsets = rows.sparkSession.createDataFrame([(p, at) for (p, _), at in zip(counts, first, strict=False)], "_placed_part int, _placed_first long")
    out = held.withColumn("_placed_part", part).join(F.broadcast(offsets), "_placed_part")  # one row a partition
    return out.withColumn(name, F.col("_placed_first") + F.col(name).bitwiseAND(F.lit((1 << _BITS) - 1))).select(*rows.columns, name)


def ranked(rows: DataFrame, name: str, group: str, *order: str) -> DataFrame:
    """``rows`` with their rank, from 1, in a group. First places, a row for each group, are counted and broadcast if there are ``GROUPS`` at most, so that no row
    moves again; else they are joined by a shuffle, where Spark's skew join splits a group that most rows belong to."""
    places = placed(rows, name, group, *order)
    first = places.groupBy(F.col(group).alias("_ranked_group")).agg(F.min(name).alias("_ranked_first"))
    first = stored(first, "first-places")
    out = places.join(F.broadcast(first) if first.count() <= GROUPS else first, F.col(group).eqNullSafe(F.col("_ranked_group")))
    return out.select(*rows.columns, (F.col(name) - F.col("_ranked_first") + 1).cast("int").alias(name))
