"""Dimension-sharded Lloyd: column blocks compute exact partial distances, blocks are added by key, each shard updates its own slice.

1. Vectors become whole numbers, ``floor(scale * x)``, and are written once as matrices: a chunk of at most ``CHUNK`` vectors gives one row
   for each block of ``WIDTH`` columns, ranged by block, so that a task holds one block of columns of many chunks.
2. A round: the tasks of a block get that block's slice of all centroids (a slice is ``k * WIDTH`` numbers, whatever the number of vectors)
   and send, for each chunk, its partial squared distances; the blocks of a chunk are added and give the nearest centroid.
3. Assignments go back to the blocks by chunk. Each block sums its own columns by cluster (partial sums, combined before the
   shuffle) and divides them, exactly: the new slice of the centroids. An empty cluster keeps its slice.
4. After the last round vectors are assigned once more.

All arithmetic is in whole numbers. A matrix product runs in binary floats only where every number in it stays below 2^53; partial distances
travel in the narrowest type that holds them. What travels in a round is ``k`` numbers a vector and block, and one assignment a vector and
block; no task holds more than a few chunks. Chunks are cut by count, so a vector that a third of all rows share is as cheap as any other.
A round leaves two tables in the shared folder (assignments, slices), so a lost executor costs one round at most.

Defined cases: vectors of another length, null, or with a null or non-finite component are left out; rows with equal ids are vectors of their own
(as starts they come in the order of their components); a null id reads as an empty one in the hash; with fewer vectors than ``k`` each is a start; equal
distances go to the smaller number; an empty table gives no rows; other columns are ignored. A component beyond ``LARGEST`` after scaling
is refused, since squared distances would no longer fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import columns, stored

#: Vectors of a chunk and columns of a block.
CHUNK, WIDTH = 1024, 16
#: Largest whole number of a component: 64 squares of twice that fit in 64 bits.
LARGEST = 1 << 27
#: Bytes of a block's slice of all centroids, which is broadcast.
SLICE_BYTES = 64 << 20

_SMALL = (np.int16, np.int32, np.int64)


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of 2, 4 and 8 bytes."""
    most = int(np.abs(x).max(initial=0))
    return np.ascontiguousarray(x, next(t for t in _SMALL if most <= np.iinfo(t).max)).tobytes()


def wide(raw: bytes, count: int) -> np.ndarray:
    """What ``narrow`` wrote of ``count`` numbers."""
    return np.frombuffer(raw, {2: np.int16, 4: np.int32, 8: np.int64}[len(raw) // count]).astype(np.int64) if count else np.zeros(0, np.int64)


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(rows of x, rows of c), exact for components up to ``LARGEST``."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    both = (x.astype(float) @ c.T.astype(float)).astype(np.int64) if most * most * x.shape[1] < 1 << 53 else x @ c.T
    return (x * x).sum(1)[:, None] - 2 * both + (c * c).sum(1)[None, :]


def whole_numbers(vectors: DataFrame, id_name: str, name: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v: array<long>) of the vectors that are kept."""
    v = F.transform(F.col("v"), lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    ok = (F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fits = F.forall("v", lambda x: F.abs(F.lit(float(scale)) * x) <= float(LARGEST))
    held = columns(vectors.select(F.col(f"`{id_name}`").alias("vec_id"), F.col(f"`{name}`").alias("v")), vec_id="long", v="array<double>").filter(ok)
    refused = F.raise_error(F.lit(f"a component is beyond {LARGEST} / {scale}")).cast("array<long>")
    return held.select("vec_id", F.when(fits, v).otherwise(refused).alias("v"))


def chunked(kept: DataFrame, dims: int, width: int, size: int) -> DataFrame:
    """(chunk, block, n, ids, data): of each chunk a row for each block of columns; the first also bears the ids."""
    schema = pa.schema([("chunk", pa.int64()), ("block", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int64())), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for k in range(0, len(batch), size):
                part = batch.slice(k, size)
                x = np.asarray(part.column("v").flatten()).reshape(len(part), dims)
                blocks = range(0, dims, width)
                ids = pa.array([part.column("vec_id").to_pylist(), *[None] * (len(blocks) - 1)], pa.list_(pa.int64()))
                data = pa.array([narrow(x[:, b : b + width]) for b in blocks], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(blocks)), pa.array(range(len(blocks)), pa.int32()), pa.array([len(part)] * len(blocks), pa.int32()), ids, data], schema=schema)
                chunk += 1

    found = kept.mapInArrow(run, "chunk long, block int, n int, ids array<long>, data binary")
    return found.repartitionByRange("block", "chunk")


def starts(kept: DataFrame, k: int, seed: int, width: int) -> DataFrame:
    """Slices (block, cluster, c: array<long>) of the ``k`` vectors with the smallest hashes of ``seed:vec_id``."""
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select(sha.alias("sha"), "v").orderBy("sha", "v").limit(k)
    listed = first.agg(F.sort_array(F.collect_list(F.struct("sha", "v"))).alias("l"))  # k rows
    numbered = listed.select(F.posexplode("l").alias("cluster", "x"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("x.v") - 1) / width).cast("int")), lambda b: F.struct(b.alias("block"), F.slice("x.v", b * width + 1, F.lit(width)).alias("c")))
    return numbered.select("cluster", F.explode(cut).alias("s")).select("s.block", "cluster", "s.c")


def assigned(blocks: DataFrame, slices: DataFrame, k: int, width_of: dict[int, int]) -> DataFrame:
    """(chunk, n, labels, distances): the nearest centroid of each vector of a chunk, from the sums of all blocks' partial distances."""
    by_block = slices.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("cluster", "c"))), lambda s: s["c"]).alias("slice"))
    partial_schema = pa.schema([("chunk", pa.int64()), ("n", pa.int32()), ("part", pa.binary())])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(len(batch)):
                block, n = batch.column("block")[row].as_py(), batch.column("n")[row].as_py()
                c = np.asarray(batch.column("slice")[row].values.flatten()).reshape(-1, width_of[block])
                out.append(narrow(squared_distances(wide(batch.column("data")[row].as_py(), n * width_of[block]).reshape(n, -1), c)))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("n"), pa.array(out, pa.binary())], schema=partial_schema)

    result_schema = pa.schema([("chunk", pa.int64()), ("n", pa.int32()), ("labels", pa.binary()), ("distances", pa.binary())])

    def nearest(parts: pa.Table) -> pa.Table:
        n, total = parts.column("n")[0].as_py(), None
        for raw in parts.column("part"):
            part = wide(raw.as_py(), n * k)
            total = part if total is None else total + part
        total = total.reshape(n, -1)
        label = total.argmin(1)
        return pa.table([[parts.column("chunk")[0].as_py()], [n], [label.astype(np.int32).tobytes()], [total[np.arange(n), label].tobytes()]], schema=result_schema)

    sent = blocks.join(F.broadcast(by_block), "block").select("chunk", "block", "n", "data", "slice")  # a slice of k * width numbers for each block
    return sent.mapInArrow(partial, "chunk long, n int, part binary").groupBy("chunk").applyInArrow(nearest, "chunk long, n int, labels binary, distances binary")


def updated(blocks: DataFrame, labels: DataFrame, slices: DataFrame, width: int, width_of: dict[int, int]) -> DataFrame:
    """New slices: of each block and cluster the exact floor of the mean, the old slice where the cluster is empty."""
    names = [f"s{j}" for j in range(width)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                block, n = batch.column("block")[row].as_py(), batch.column("n")[row].as_py()
                x = wide(batch.column("data")[row].as_py(), n * width_of[block]).reshape(n, -1)
                label = np.frombuffer(batch.column("labels")[row].as_py(), np.int32)
                order = np.argsort(label, kind="stable")
                found, first, count = np.unique(label[order], return_index=True, return_counts=True)
                total = np.zeros((len(found), width), np.int64)
                total[:, : x.shape[1]] = np.add.reduceat(x[order], first, axis=0)
                cols = [pa.array(np.full(len(found), block), pa.int32()), pa.array(found, pa.int32()), pa.array(count, pa.int64()), *[pa.array(total[:, j]) for j in range(width)]]
                yield pa.RecordBatch.from_arrays(cols, ["block", "cluster", "n", *names])

    joined = blocks.select("chunk", "block", "n", "data").join(labels.select("chunk", "labels"), "chunk").select("block", "n", "data", "labels")
    parts = joined.mapInArrow(sums, "block int, cluster int, n long, " + ", ".join(f"{s} long" for s in names))
    total = parts.groupBy("block", "cluster").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])  # map-side sums: k rows a task and block
    floor = [F.expr(f"({s} - pmod({s}, n)) div n") for s in names]
    new = total.select("block", "cluster", F.array(*floor).alias("new"))
    out = slices.join(new, ["block", "cluster"], "left")
    return out.select("block", "cluster", F.coalesce(F.slice("new", F.lit(1), F.size("c")), F.col("c")).alias("c"))


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2, id_name: str = "vec_id", name: str = "embedding", width: int = WIDTH, size: int = CHUNK) -> DataFrame:
    """One row for each kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of its centroid's
    components, joined by commas."""
    width = min(width, dims)
    if k * width * 8 > SLICE_BYTES:
        raise ValueError(f"a slice of {k} centroids and {width} columns is over SLICE_BYTES; take a smaller width")
    width_of = {b: min(width, dims - b * width) for b in range(-(-dims // width))}
    kept = stored(whole_numbers(vectors, id_name, name, dims, scale), "whole-vectors")
    blocks = stored(chunked(kept, dims, width, size), "column-blocks")
    slices = stored(starts(kept, k, seed, width), "slices")
    found = slices.filter("block = 0").count()  # k, or all vectors if they are fewer
    for _ in range(rounds):
        labels = stored(assigned(blocks, slices, found, width_of), "assignments")
        slices = stored(updated(blocks, labels, slices, width, width_of), "slices")
    labels = stored(assigned(blocks, slices, found, width_of), "assignments")
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                label, distance = (np.frombuffer(batch.column(c)[row].as_py(), t) for c, t in (("labels", np.int32), ("distances", np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("ids")[row].values, pa.array(label), pa.array(distance)], schema=schema)

    near = blocks.filter("block = 0").select("chunk", "ids").join(labels.select("chunk", "labels", "distances"), "chunk").select("ids", "labels", "distances")
    near = stored(near.mapInArrow(rows, "vec_id long, cluster int, distance long"), "nearest")
    words = F.transform(F.sort_array(F.collect_list(F.struct("block", "c"))), lambda s: F.array_join(F.transform(s["c"], lambda x: x.cast("string")), ","))
    centroids = slices.groupBy("cluster").agg(F.sha2(F.array_join(words, ","), 256).alias("centroid_sha256"))
    sums = near.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = sums.agg(F.collect_list(F.struct("cluster", "cluster_inertia")).alias("l"), F.sum("cluster_inertia").alias("inertia"))  # k rows
    of = whole.select(F.explode("l").alias("s"), "inertia").select("s.cluster", "s.cluster_inertia", "inertia").join(centroids, "cluster")
    return near.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
