"""Near-duplicate classes: one-permutation MinHash with optimal densification, banded buckets, star-shaped edges.

1. Each text becomes its set of distinct 5-word shingles (64-bit hashes) and, by one permutation, ``BINS`` bin minima;
   empty bins borrow from a non-empty bin that a 2-universal hash picks, again and again until one is found.
2. Equal sets form a class, represented by its smallest doc_id (a partial aggregate: copies cost nothing further).
3. Classes that share a bucket (all bins of a band equal) get an edge to the bucket's smallest member only, so a bucket of m
   members makes m - 1 edges. Components over these stars are candidate families: a superset of the true components.
4. A family is confirmed on full sets, exactly: it is cut in blocks of bounded bytes, and each pair of blocks is one
   task that finds links by prefix filtering (two sets with Jaccard of t or more share one of their rarest (1 - t) * size
   + 1 shingles) and returns a spanning forest, at most one edge a member. So no star loses a link between two members
   of which neither is the centre, no group of any size enters one task whole, and copies are never expanded into pairs.
5. Components over the confirmed links give each class the smallest doc_id that it can reach.

With 48 bands of 6 bins a pair misses every bucket with probability 5e-7 at 0.8 and 2e-10 at 0.85, and may then still meet in
its family. Spark sees rows only in proportion to documents, except for the block pairs of families over ``BLOCK_BYTES``.

Defined cases: a text without words (or null) has an empty set, no link and itself as component; rows with one doc_id
are one document; rows without doc_id take the smallest doc_id of their class and its component (null if there is none); extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import columns, hot_join, stored
from .wordhash import Words, gram_hashes, mix, slices, whole, word_hashes, words

SHINGLE, BANDS, ROWS = 5, 48, 6
BINS = BANDS * ROWS
#: Shingle bytes of one block of a family; a task holds two blocks.
BLOCK_BYTES = 8 << 20


def shingle_sets(w: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts end to end, sorted within each text, and where each text's begin."""
    h = word_hashes(w)
    grams, ok = gram_hashes(h, n), whole(w, n)
    doc = w.doc[: len(ok)][ok]
    grams = grams[ok]
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(short):
        extra = [gram_hashes(h[w.first[d] : w.first[d + 1]], int(w.counts[d]))[0] for d in short]
        doc, grams = np.concatenate([doc, short]), np.concatenate([grams, np.array(extra, np.uint64)])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    doc, grams = doc[new], grams[new]
    return grams, np.searchsorted(doc, np.arange(len(w.first)))


def band_keys(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, BANDS) bucket keys; rows of empty sets mean nothing."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    h = mix(grams + np.uint64(0x5851F42D4C957F2D))
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    bins = np.full(n * BINS, empty, np.uint64)
    np.minimum.at(bins, doc * BINS + (h % np.uint64(BINS)).astype(np.int64), h >> np.uint64(9))
    bins = bins.reshape(n, BINS)
    filled = bins != empty
    some = filled.any(axis=1)
    row, col = np.nonzero(~filled & some[:, None])
    attempt = np.uint64(1)
    while len(row):
        pick = (mix(col.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + attempt) % np.uint64(BINS)).astype(np.int64)
        got = filled[row, pick]
        bins[row[got], col[got]] = bins[row[got], pick[got]]
        row, col, attempt = row[~got], col[~got], attempt + np.uint64(1)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0xC2B2AE3D27D4EB4F) + np.zeros((n, 1), np.uint64)
    for r in range(ROWS):
        keys = mix(keys ^ bins[:, r::ROWS][:, :BANDS])
    return keys


def signatures(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """(doc_id, hash of the text, n_shingles, digest of the set, band keys) of each document."""
    schema = pa.schema([("doc_id", pa.int64()), ("body", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                grams, first = shingle_sets(words(part.column("text"), lower=True), n)
                keys, sizes = band_keys(grams, first).view(np.int64), np.diff(first)
                digests = [hashlib.blake2b(grams[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first[:-1], first[1:], strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("body"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists], schema=schema)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("body")).mapInArrow(run, "doc_id long, body long, n_shingles long, digest binary, bands array<long>")


def full_sets(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``docs`` with their whole sets as bytes instead of texts."""
    names = [c for c in docs.columns if c != "text"]
    types = ", ".join(f"{c} long" for c in names)
    schema = pa.schema([*[(c, pa.int64()) for c in names], ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                grams, first = shingle_sets(words(part.column("text"), lower=True), n)
                sets = [grams[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(sets, pa.binary())], schema=schema)

    return docs.mapInArrow(run, f"{types}, grams binary")


def forest(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links (100 * intersection >= percent * union) among ``sets``: (smallest id, other id)."""
    sizes = np.array([len(s) for s in sets])
    flat, token = np.unique(np.concatenate(sets), return_inverse=True)
    freq = np.bincount(token, minlength=len(flat))
    rank = np.empty(len(flat), np.int64)
    rank[np.argsort(freq, kind="stable")] = np.arange(len(flat))
    owner = np.repeat(np.arange(len(sets)), sizes)
    token = rank[token]
    order = np.lexsort((token, owner))
    token = token[order]  # rarest first within each set
    first = np.concatenate([[0], np.cumsum(sizes)])
    prefix = sizes - -(-sizes * percent // 100) + 1
    within = np.arange(len(token)) - first[owner] < prefix[owner]
    p_token, p_owner = token[within], owner[within]
    p_first = np.concatenate([[0], np.cumsum(np.minimum(prefix, sizes))])
    by = np.argsort(p_token, kind="stable")
    s_token, s_owner = p_token[by], p_owner[by]
    root = np.arange(len(sets))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    mark = np.zeros(len(flat) + 1, bool)
    for i in range(len(sets)):
        mine = p_token[p_first[i] : p_first[i + 1]]
        lo, hi = np.searchsorted(s_token, mine, "left"), np.searchsorted(s_token, mine, "right")
        counts = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        others = np.unique(s_owner[at])
        others = others[(others < i) & (100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i]))]
        if not len(others):
            continue
        here = find(i)
        while (root[others] != root[root[others]]).any():
            root[others] = root[root[others]]
        others = others[root[others] != here]
        if not len(others):
            continue
        mark[token[first[i] : first[i + 1]]] = True
        n = sizes[others]
        at = np.repeat(first[others] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.add.reduceat(mark[token[at]].astype(np.int64), np.concatenate([[0], np.cumsum(n)[:-1]]))
        mark[token[first[i] : first[i + 1]]] = False
        for j in others[100 * both >= percent * (sizes[i] + n - both)]:
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    least: dict[int, int] = {}
    for i in range(len(sets)):
        r = find(i)
        least[r] = min(least.get(r, ids[i]), ids[i])
    return [(least[find(i)], ids[i]) for i in range(len(sets)) if least[find(i)] != ids[i]]


def confirmed(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of a spanning forest of each pair of blocks; members: (key_a, key_b, key_c, doc_id, grams)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets = None, [], []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for a, b, c, doc, grams in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (a, b, c) != key:
                    if len(ids) > 1:
                        out += forest(ids, sets, percent)
                    key, ids, sets = (a, b, c), [], []
                ids.append(doc)
                sets.append(np.frombuffer(grams, np.uint64))
            if out:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], schema=schema)
        if len(ids) > 1 and (out := forest(ids, sets, percent)):
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], schema=schema)

    keys = ["family", "block_a", "block_b"]
    dealt = members.select(*keys, "doc_id", "grams").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(documents: DataFrame, percent: int = 85, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id, kept."""
    return _judged(documents, percent, block_bytes).drop("body")


def _judged(documents: DataFrame, percent: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    docs = columns(documents, doc_id="long", text="string")
    signed = stored(signatures(docs), "signatures")
    full = signed.filter("n_shingles > 0")
    classes = stored(
        full.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"), F.max("n_shingles").alias("n")), "classes"
    )
    buckets = classes.select("rep", "n", F.explode("bands").alias("key"))
    centres = buckets.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last"), F.count("*").alias("held")).filter("centre <> last")
    centres = stored(centres.select("key", "centre", "held"), "centres")
    stars = hot_join(buckets, centres, "key", "held").filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    families = components(stars)
    sized = families.join(classes.select(F.col("rep").alias("node"), "n"), "node")
    sized = stored(sized.groupBy("node", "component").agg(F.max("n").alias("n")), "sized")  # a doc_id on several rows is one node
    blocks = sized.groupBy("component").agg(F.ceil(F.sum("n") * 8 / F.lit(block_bytes)).cast("int").alias("blocks"), F.count("*").alias("held"))
    members = hot_join(sized, stored(blocks, "blocks"), "component", "held").select(
        F.col("component").alias("family"), F.col("node").alias("doc_id"), F.pmod(F.xxhash64("node"), "blocks").alias("block"), F.col("blocks").cast("long").alias("blocks")
    )
    sets = full_sets(docs.join(members, "doc_id"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    paired = sets.withColumn("other", other).select("family", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"), "doc_id", "grams")
    linked = components(confirmed(paired, percent))
    # A doc_id on several rows with different texts joins their classes.
    named = classes.select("digest", "rep").join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("digest", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "body", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "body", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def kept_documents(documents: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``documents`` that stay: one document of each component, all columns as they were. Of equal texts without doc_id that
    no document with an id holds, one row stays."""
    kept = stored(_judged(documents, percent).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("body").alias("kept_body")).distinct(), "kept")
    named, bare = kept.filter("kept_id is not null"), kept.filter("kept_id is null")
    body = F.xxhash64(documents["text"].cast("string"))
    rows = documents.join(named, (documents["doc_id"].cast("long") == named["kept_id"]) & (body == named["kept_body"]), "left_semi")
    if bare.isEmpty():
        return rows
    others = documents.filter(documents["doc_id"].cast("long").isNull())
    others = others.join(bare, F.xxhash64(others["text"].cast("string")) == bare["kept_body"], "left_semi").dropDuplicates(["text"])
    return rows.unionByName(others)
