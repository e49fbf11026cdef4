"""Nearest vectors: an index of inverted lists with product-quantised residuals, built and searched by Spark, and the exact search in blocks.

1. Equal vectors are one entry: of each vector the ``k + 1`` smallest ids are kept (a group limit within the tasks comes first), as no search
   can return more of them. So a vector that a third of all rows share is one entry and one query.
2. Centres and code books are fitted on the ``SAMPLE`` vectors whose ids have the smallest hashes (bounded, the only vectors the driver sees); there are about as many
   lists as the square root of the entries, ``LISTS`` at most.
3. Every entry goes to the list of its nearest centre as a code of one byte for each ``PART`` components of its residual. A list of more than ``ROWS`` entries is split by
   a hash of the id; a query visits all splits of its ``probes`` nearest lists, and a split keeps its best by the codes, some
   ``4 * keep`` for a query in all.
4. The best ``keep`` of all splits are compared with the query exactly.

Unless they are given, ``probes`` are chosen on the sample: as many lists as hold the share ``TARGET`` of the exact neighbours, within the sample, of some of its vectors.
Vectors without any clusters need about half of the lists for that, clustered ones few.

``exact`` compares the queries, in blocks of ``BLOCK`` that are broadcast, with all vectors; recall is measured against it. Distances are squared
Euclidean ones in binary floats; equal distances come in the order of ids.

Defined cases: null vectors, vectors of another length or with a null or non-finite component and rows without id are left out; of repeated ids each is a row; an
empty table gives no rows; fewer rows than ``k`` give fewer neighbours. A query is no neighbour of itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stages import stored

SAMPLE, LISTS, PART, ROWS, BLOCK = 20_000, 4096, 4, 1 << 16, 4096


#: Share of the sample's neighbours that the lists visited must hold, and the vectors that are tried.
TARGET, TRIED = 0.97, 512


@dataclass(frozen=True)
class Index:
    """Centres of the lists, and for each part of a residual its code book of at most 256 entries."""

    centres: np.ndarray
    books: list[np.ndarray]

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.split(x, np.cumsum([b.shape[1] for b in self.books])[:-1], axis=1)

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list of each vector and its code, a byte for each part."""
        at = nearest(x, self.centres)
        return at, np.stack([nearest(r, b) for r, b in zip(self.parts(x - self.centres[at]), self.books, strict=True)], axis=1).astype(np.uint8)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :]


def nearest(x: np.ndarray, c: np.ndarray, rows: int = 4096) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *[distances(x[k : k + rows], c).argmin(1) for k in range(0, len(x), rows)]])


def lloyd(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of a bounded sample; an empty one stays where it was."""
    c = x[np.random.default_rng(0).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def fit(sample: np.ndarray, entries: int, part: int = PART) -> Index:
    lists = max(1, min(LISTS, round(entries**0.5), len(sample)))
    centres = lloyd(sample, lists)
    residual = sample - centres[nearest(sample, centres)]
    books = [lloyd(r, min(256, len(sample))) for r in np.split(residual, range(part, residual.shape[1], part), axis=1)]
    return Index(centres, books)


def probes_for(index: Index, sample: np.ndarray, k: int, target: float = TARGET) -> int:
    """How many nearest lists of a vector hold the share ``target`` of its ``k`` nearest in the sample."""
    tried = sample[:TRIED]
    d = distances(tried, sample)
    d[np.arange(len(tried)), np.arange(len(tried))] = np.inf
    near = np.argsort(d, axis=1)[:, : max(1, min(k, len(sample) - 1))]
    at = nearest(sample, index.centres)[near]
    rank = np.argsort(np.argsort(distances(tried, index.centres), axis=1), axis=1)
    return int(np.quantile(np.take_along_axis(rank, at, axis=1), target, method="higher")) + 1


def kept(vectors: DataFrame, dims: int, id_name: str = "vec_id", name: str = "embedding") -> DataFrame:
    rows = vectors.select(F.col(id_name).cast("long").alias("id"), F.col(name).cast("array<double>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & (F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def best(rows: DataFrame, group: str, k: int) -> DataFrame:
    """The ``k`` rows of each group with the smallest (distance, id), with their ``rank``; tasks drop what can't be among them before the shuffle."""
    by = Window.partitionBy(group).orderBy("distance", "id")
    return rows.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def exact(vectors: DataFrame, queries: DataFrame, dims: int, k: int = 10, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, distance) by comparing all queries, a block at a time, with all vectors; both have columns ``id`` and ``v``."""
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("distance", pa.float64())])
    asked = stored(queries.withColumn("at", F.monotonically_increasing_id()), "queries")
    n, out = asked.count(), None
    blocks = -(-n // block)
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("at"), F.lit(blocks)) == b).select("id", "v").toArrow()  # about ``block`` vectors
        shared = vectors.sparkSession.sparkContext.broadcast((np.asarray(own["id"]), matrix(own["v"].combine_chunks())))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, q = shared.value
            for batch in batches:
                x, at = matrix(batch.column("v")), np.asarray(batch.column("id"))
                for j in range(0, len(q), 64):
                    d = np.square(q[j : j + 64, None, :] - x[None, :, :]).sum(-1)
                    d[ids[j : j + 64, None] == at[None, :]] = np.inf
                    top = np.lexsort((np.broadcast_to(at, d.shape), d))[:, : k]
                    row = np.arange(len(d))[:, None]
                    near = d[row, top]
                    keep = np.isfinite(near)
                    yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(ids[j : j + 64, None], top.shape)[keep]), pa.array(at[top][keep]), pa.array(near[keep])], schema=schema)

        part = best(vectors.select("id", "v").mapInArrow(run, "query_id long, id long, distance double"), "query_id", k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, id long, distance double, rank int")
    return out


def searched(vectors: DataFrame, queries: DataFrame, dims: int, k: int = 10, probes: int | None = None, keep: int = 256, rows: int = ROWS) -> DataFrame:
    """(query_id, rank, id, distance) of the queries' neighbours by the index; ``vectors`` and ``queries`` have columns ``id`` and ``v``."""
    spark = vectors.sparkSession
    copies = Window.partitionBy("v").orderBy("id")
    limited = stored(vectors.select("id", "v").withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1), "copies")
    entries = limited.filter("copy = 1").select("id", "v")
    n = entries.count()
    if not n:
        return spark.createDataFrame([], "query_id long, id long, distance double, rank int")
    sample = entries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    sample = matrix(sample["v"].combine_chunks())
    index = fit(sample, n)
    probes = probes or probes_for(index, sample, k)
    shared = spark.sparkContext.broadcast(index)  # LISTS centres and 256 entries a part at most

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, code = shared.value.codes(matrix(batch.column("v")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(at, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary())], ["id", "list", "code"])

    coded = stored(entries.mapInArrow(encode, "id long, list int, code binary"), "codes")
    splits = {r["list"]: -(-r["count"] // rows) for r in coded.groupBy("list").count().collect()}  # a row for each list
    of = spark.createDataFrame(list(splits.items()), "list int, splits int")
    coded = coded.join(F.broadcast(of), "list").withColumn("split", F.pmod(F.xxhash64("id"), "splits").cast("int")).select("list", "split", "id", "code")

    first = limited.filter("copy = 1").select(F.col("id").alias("entry"), "v")
    asked = stored(queries.select(F.col("id").alias("query_id"), "v").join(first, "v").select("query_id", "entry"), "asked")
    wanted = asked.select("entry").distinct().join(entries.withColumnRenamed("id", "entry"), "entry")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"))
            d = distances(v, shared.value.centres)
            near = np.argsort(d, axis=1, kind="stable")[:, :probes]
            rows_ = [(i, int(p), s) for i in range(len(v)) for p in near[i] for s in range(splits.get(int(p), 0))]
            at = np.array([r[0] for r in rows_], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("entry").take(pa.array(at)), pa.array([r[1] for r in rows_], pa.int32()), pa.array([r[2] for r in rows_], pa.int32()), batch.column("v").take(pa.array(at))], ["entry", "at_list", "at_split", "v"])

    visits = wanted.mapInArrow(visit, "entry long, at_list int, at_split int, v array<double>")
    schema = pa.schema([("entry", pa.int64()), ("id", pa.int64()), ("distance", pa.float64())])
    own = max(k, -(-4 * keep // probes))  # candidates of a visit: all ``k`` may be in one list, and all lists together give ``keep`` several times

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        if len(left) and len(right):
            ids, code = np.asarray(right["id"]), np.frombuffer(b"".join(right["code"].to_pylist()), np.uint8).reshape(len(right), -1)
            entry, v = np.asarray(left["entry"]), matrix(left["v"].combine_chunks())
            v = v - shared.value.centres[left["at_list"][0].as_py()]
            for j in range(0, len(v), 64):
                d = np.zeros((len(v[j : j + 64]), len(ids)))
                for m, (part, book) in enumerate(zip(shared.value.parts(v[j : j + 64]), shared.value.books, strict=True)):
                    d += distances(part, book)[:, code[:, m]]
                top = np.argpartition(d, min(own, d.shape[1]) - 1, axis=1)[:, :own]
                out[0].append(np.repeat(entry[j : j + 64], top.shape[1]))
                out[1].append(ids[top].ravel())
                out[2].append(d[np.arange(len(d))[:, None], top].ravel())
        return pa.table([np.concatenate(x) for x in out], schema=schema)

    rough = visits.groupBy("at_list", "at_split").cogroup(coded.groupBy("list", "split")).applyInArrow(compared, "entry long, id long, distance double")
    candidates = best(rough, "entry", keep).select("entry", "id")
    both = candidates.join(entries.select("id", F.col("v").alias("w")), "id").join(wanted.select("entry", "v"), "entry")
    square = F.aggregate(F.zip_with("v", "w", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)
    near = best(both.select("entry", "id", square.alias("distance")), "entry", k + 1).select("entry", F.col("id").alias("found"), "distance")
    member = limited.select("id", "v").join(first.withColumnRenamed("entry", "found"), "v").select("found", "id")  # k + 1 rows of an entry at most
    nearby = best(near.join(member, "found").select("entry", "id", "distance"), "entry", k + 1)
    listed = nearby.groupBy("entry").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("l"))  # k + 1 ids
    found = asked.join(listed, "entry").select("query_id", F.slice(F.filter("l", lambda x: x["id"] != F.col("query_id")), 1, k).alias("l"))
    return found.select("query_id", F.posexplode("l").alias("p", "x")).select("query_id", "x.id", "x.distance", (F.col("p") + 1).alias("rank"))
