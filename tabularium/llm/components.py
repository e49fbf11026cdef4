"""Connected components of an edge table by alternating large-star and small-star steps, all in DataFrames.

Every node ends with the smallest id that it can reach. Each step is one written table in the shared folder, so lineage
stays short and no step is lost with an executor. Hot nodes: both steps take the smallest neighbour by a partial
aggregate and a join that leaves the edges of hot nodes where they are, never a collected list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


#: A node with a 64th of all rows (and ``HOT`` or more) is hot; there are 64 of them at most.
HOT, SHARE = 1000, 64


def _with_least(both: DataFrame, least: DataFrame, rows: int) -> DataFrame:
    """``both.join(least, "u")``, where the rows of hot nodes stay where they are: what they need is a literal."""
    hot = {r["u"]: r["m"] for r in least.filter(F.col("n") >= max(HOT, rows // SHARE)).select("u", "m").limit(SHARE).collect()} if rows >= HOT else {}
    if not hot:
        return both.join(least.select("u", "m"), "u")
    known = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    here = both.filter(F.col("u").isin(list(hot))).select("u", "v", F.element_at(known, F.col("u")).alias("m"))
    return here.unionByName(both.filter(~F.col("u").isin(list(hot))).join(least.select("u", "m"), "u"))


def _star(edges: DataFrame, large: bool, rows: int = 0) -> DataFrame:
    """Edges u-v become v-m: m is the smallest of u and its (large: all, small: smaller) neighbours. Only the smaller end of an edge can be hot:
    a bucket's members all know its centre, and a node has few smaller ones."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    moved = _with_least(both, least, 2 * rows)
    if large:
        return moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own).filter("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes that have an edge to another node; null ends and loops are left out."""
    now = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a <> b")
    now = stored(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stored(_star(_star(now, large=True, rows=mark[0]), large=False), "edges")
        after = _mark(now)
        if after == mark:
            break
        mark = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """A digest of the whole edge set: equal marks of two rounds mean that nothing moved."""
    hashed = F.xxhash64("a", "b")
    row = edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.shiftright(hashed, 20))).first()
    return tuple(row)
