"""Consistent-hash sharding with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a 62-bit ring; a key belongs to the arc that ends in the next point clockwise.
A sweep visits the points clockwise, again and again: the shard of a point takes the keys that wait there, in order of
(ring position, key), until its capacity is reached, and the rest continue to the next point. With capacities that sum
to the number of keys the counts of all shards differ by one at most.

Only the key counts of the arcs (``shards * vnodes`` numbers, whatever the input) come to the driver. The sweep moves
whole runs of keys, so its plan has at most one entry for each arc and one more for each shard that fills up; that
bounded plan is joined back to the keys, each of which knows its rank within its arc. No text is shuffled.

Defined cases: a null key has one fixed ring position and sorts first; rows that repeat a key are ranked by size and
checksum; null and empty texts have 0 bytes; an empty table gives no rows; extra columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import free

RING = 1 << 62
#: Bytes that a row takes besides its text.
OVERHEAD = 16


@dataclass(frozen=True)
class Ring:
    shards: int
    vnodes: int = 96

    def points(self) -> list[tuple[int, int]]:
        """(position, shard) of all virtual nodes, clockwise."""
        at = lambda s, v: int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % RING
        return sorted((at(s, v), s) for s in range(self.shards) for v in range(self.vnodes))


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard may take. Without slack they sum to ``total`` and differ by one at most; with slack each is
    the mean times ``1 + slack``, rounded up, so fewer keys move when shards come or go."""
    if slack:
        return [-(-int(total * (1 + slack) * 1_000_000) // (shards * 1_000_000)) or 1] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def sweep(arcs: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, last rank + 1, shard, first slot) of all runs of keys; ``arcs[i]`` keys begin at point ``i``."""
    if sum(room) < sum(arcs):
        raise ValueError("the capacities of all shards together are below the number of keys")
    room, used = list(room), [0] * len(room)
    waiting = [deque([(i, 0, n)] if n else []) for i, n in enumerate(arcs)]
    left, plan, at = sum(arcs), [], 0
    while left:
        shard, queue = owners[at], waiting[at]
        while queue and room[shard]:
            arc, lo, hi = queue.popleft()
            taken = min(hi - lo, room[shard])
            plan.append((arc, lo, lo + taken, shard, used[shard]))
            room[shard] -= taken
            used[shard] += taken
            left -= taken
            if lo + taken < hi:
                queue.appendleft((arc, lo + taken, hi))
        following = (at + 1) % len(arcs)
        if following != at:
            waiting[following].extend(queue)
            waiting[at] = deque()
        at = following
    return plan


def ring_position(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key.cast("string")), 2)


def assign(keys: DataFrame, key: str, ring: Ring, tiebreak: list[str] = (), slack: float = 0.0) -> DataFrame:
    """``keys`` with ``shard`` and ``slot`` (gapless from 0 within a shard; see ``free`` where ``keys`` has such columns). ``keys`` needs no text column."""
    spark = keys.sparkSession
    points = ring.points()
    cells = spark.createDataFrame(_cells(points), "_cell int, _from int, _spots array<long>")
    names, shard, slot = keys.columns, *free(keys.columns, "shard", "slot")
    keys = keys.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))  # so that no column's name can clash
    placed = keys.withColumn("_position", ring_position(F.col("_row")[key])).withColumn("_cell", F.shiftrightunsigned("_position", 50).cast("int"))
    before = F.size(F.filter("_spots", lambda p: p < F.col("_position")))
    placed = placed.join(F.broadcast(cells), "_cell")  # 4,096 rows
    placed = placed.withColumn("_arc", ((F.col("_from") + before) % F.lit(len(points))).cast("int")).drop("_cell", "_from", "_spots")
    counts = {r["_arc"]: r["n"] for r in placed.groupBy("_arc").agg(F.count("*").alias("n")).collect()}  # at most one row an arc
    arcs = [counts.get(i, 0) for i in range(len(points))]
    plan = sweep(arcs, [s for _, s in points], capacities(sum(arcs), ring.shards, slack))
    runs = spark.createDataFrame(plan, "_arc int, _lo long, _hi long, shard int, _first long")
    order = Window.partitionBy("_arc").orderBy(F.col("_position"), *[F.col("_row")[c] for c in (key, *tiebreak)])
    ranked = placed.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    runs = runs.groupBy("_arc").agg(F.collect_list(F.struct("_lo", "_hi", "shard", "_first")).alias("_runs"))
    hit = F.filter("_runs", lambda r: (r["_lo"] <= F.col("_rank")) & (F.col("_rank") < r["_hi"]))[0]
    return (
        ranked.join(F.broadcast(runs), "_arc")  # one row for each arc at most
        .withColumn("_hit", hit)
        .select("_row.*", F.col("_hit.shard").alias(shard), (F.col("_hit._first") + F.col("_rank") - F.col("_hit._lo")).alias(slot))
    )


def _cells(points: list[tuple[int, int]], bits: int = 12) -> list[tuple[int, int, list[int]]]:
    """For each of ``2**bits`` equal cells of the ring: the first point at or after its start, and the positions within."""
    width, out, at = RING >> bits, [], 0
    for c in range(1 << bits):
        first = at
        while at < len(points) and points[at][0] < (c + 1) * width:
            at += 1
        out.append((c, first, [p for p, _ in points[first:at]]))
    return out
