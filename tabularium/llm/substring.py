"""Exact removal of repeated word windows, behind a count-min prefilter.

A window is ``WINDOW`` consecutive words of one document. A window is covered by its anchor: the word 8-gram of smallest
hash among the 8-grams inside it (equal windows have equal anchors, and neighbouring windows mostly share theirs, so
anchors are some 20 times fewer than windows).

1. The anchors of each document, each once, are written as a table; their number sizes the count-min sketch, which is cut in ranges of anchors.
   Each task adds its anchors to a sketch of its own; the sketches of all tasks are merged range by range, each in the memory of one range. A
   sketch overestimates: the count of an anchor is at least the number of documents that hold any of its windows. As cells follow anchors, so
   does the share of anchors that are overestimated: less than 2 % at any size.
2. Anchors are looked up in their range, where the merged sketch of it is. Those estimated in two documents or more go back to their documents.
3. Windows of these anchors are emitted, as maximal runs, and only those are grouped exactly, by a 128-bit hash: the smallest doc_id of each
   window sequence. No window that repeats is lost, whatever the sketch's size; a full sketch only sends more windows to the exact pass.
4. Each document gets the word ranges covered by windows that also start in a smaller doc_id. Steps 3 and 4 share one shuffle of the texts.

Windows are judged on the input texts. Ids are compared, never positions: a passage that repeats only within one
document stays. A hot passage costs one row a task and window: the smallest id is a partial aggregate, and what tasks hold of a hot
anchor is brought together in two steps, by anchor and hash of the id first, so that no task reads it whole. The cells of the commonest anchors
(``HEAVIEST``, of ``HEAVY`` documents or more) are broadcast, so such an anchor is looked up where it is.

Defined cases: null and empty texts have no words; a text of fewer words than a window loses none; an empty table gives one; rows with equal
doc_id are no smaller than each other; a row without doc_id counts as larger than all; a text of any length is one row; extra columns are kept.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free, stored
from .wordhash import Words, gram_hashes, mix, slices, whole, word_hashes, words

WINDOW, ANCHOR = 50, 8
#: Anchors in a range of the sketch, on average at most, and cells for each of them in either of its two rows: 32 MB of counters a range at most.
RANGE, ROOM = 1 << 19, 8
#: Anchors that a task gathers before it cuts them by range.
GATHERED = 1 << 20
#: Cells of so many documents or more are heavy; so many of the heaviest are known to all tasks.
HEAVY, HEAVIEST = 1000, 8192
#: An anchor that the sketch estimates in so many documents is hot: its windows are judged in two steps.
HOT = 64
#: What ``deduplicated`` works with and, but for the first, adds.
ADDED = ("_ranges", "_n_words", "_n_removed", "_kept_sha256")
_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_LARGEST = (1 << 63) - 1


def anchors(h: np.ndarray, w: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor hash of each window, and the first word of each window (windows within one text only)."""
    ok = whole(w, window)
    at = np.flatnonzero(ok)
    grams = gram_hashes(h, anchor)
    least, width, need = grams, 1, window - anchor + 1
    while width * 2 <= need:  # sliding minimum by doubling
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < need:
        least = np.minimum(least[: len(least) - (need - width)], least[need - width :])
    return least[at], at


def placed(keys: np.ndarray, ranges: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The range of each anchor and its cell in either row of that range; the second row's cells are numbered behind the first's."""
    one, two = mix(keys ^ _SEEDS[0]), mix(keys ^ _SEEDS[1])
    mask = np.uint64((1 << bits) - 1)
    at = ((one >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return at.astype(np.int64), (one & mask).astype(np.int64), (two & mask).astype(np.int64) + (1 << bits)


def _once_a_text(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their texts without repeats in one text."""
    for ordered in (False, True):  # neighbours mostly share theirs: what is left to sort is little
        if ordered:
            order = np.lexsort((keys, text))
            keys, text = keys[order], text[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
        keys, text = keys[new], text[new]
    return keys, text


def anchor_table(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(n, anchors, owners): the anchors of some documents of ``docs`` (key, text), each once a document, and the keys of these, as packed 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"))
                keys, at = anchors(word_hashes(w), w, window, anchor)
                keys, text = _once_a_text(keys, w.doc[at])
                owners = np.asarray(part.column("key"))[text]
                if len(keys):
                    yield pa.RecordBatch.from_arrays([pa.array([len(keys)], pa.int64()), pa.array([keys.tobytes()]), pa.array([owners.tobytes()])], ["n", "anchors", "owners"])

    return docs.mapInArrow(run, "n long, anchors binary, owners binary")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Anchors and owners of rows of the anchor table, many at once."""
    keys, owners, held = [], [], 0
    for batch in batches:
        for k, o in zip(batch.column("anchors"), batch.column("owners"), strict=True):
            keys.append(np.frombuffer(k.as_buffer(), np.uint64))
            owners.append(np.frombuffer(o.as_buffer(), np.int64))
            held += len(keys[-1])
            if held >= GATHERED:
                yield np.concatenate(keys), np.concatenate(owners)
                keys, owners, held = [], [], 0
    if held:
        yield np.concatenate(keys), np.concatenate(owners)


_PACKED = "place long, kind int, a binary, b binary"


def _packed(place: np.ndarray, kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Rows of ``_PACKED``, one for each run of equal places, with that run's members of ``a`` and ``b``."""
    cut = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    ends = np.append(cut, len(place))
    pack = lambda x: pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])
    return pa.RecordBatch.from_arrays([pa.array(place[cut], pa.int64()), pa.array(np.full(len(cut), kind, np.int32)), pack(a), pack(b)], ["place", "kind", "a", "b"])


def sketch(table: DataFrame, ranges: int, bits: int) -> DataFrame:
    """The merged sketch of an anchor table: for each range (place) the cells of two documents or more (a) and their counts (b), and
    those that are heavy as arrays."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _ in _gathered(batches):
            at, *rows = placed(keys, ranges, bits)
            cells, n = np.unique(np.concatenate([(at << (bits + 1)) | c for c in rows]), return_counts=True)
            yield _packed(cells >> (bits + 1), 0, (cells & ((2 << bits) - 1)).astype(np.int32), n.astype(np.uint32))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, here = np.zeros(2 << bits, np.uint32), None

        def done() -> pa.RecordBatch:
            some = np.flatnonzero(counts >= 2)
            heavy = some[counts[some] >= HEAVY]
            out = [pa.array([here], pa.int64()), pa.array([0], pa.int32()), pa.array([some.astype(np.int32).tobytes()]), pa.array([counts[some].tobytes()])]
            out += [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (heavy, counts[heavy])]
            counts.fill(0)
            return pa.RecordBatch.from_arrays(out, ["place", "kind", "a", "b", "heavy", "documents"])

        for batch in batches:
            for place, a, b in zip(batch.column("place").to_pylist(), batch.column("a"), batch.column("b"), strict=True):
                if here is not None and place != here:
                    yield done()
                here, cells = place, np.frombuffer(a.as_buffer(), np.int32)
                more = counts[cells].astype(np.int64) + np.frombuffer(b.as_buffer(), np.uint32)
                counts[cells] = np.minimum(more, (1 << 32) - 1)
        if here is not None:
            yield done()

    parts = table.mapInArrow(build, _PACKED).repartition("place").sortWithinPartitions("place")
    return parts.mapInArrow(merge, f"{_PACKED}, heavy array<long>, documents array<long>")


def estimated(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int | None = None) -> DataFrame:
    """(key, anchor, hot): the anchors of ``docs`` (key, text) that are estimated in two documents or more. ``bits``: of the cells of a range, instead
    of as many as its anchors need."""
    spark, table = docs.sparkSession, stored(anchor_table(docs, window, anchor), "anchors")
    total = table.agg(F.sum("n")).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE))
    if bits is None:
        bits = max(4, math.ceil(math.log2(max(1, ROOM * total / ranges))))
    merged = stored(sketch(table, ranges, bits), "sketch")
    top = merged.select("place", F.explode(F.arrays_zip("heavy", "documents")).alias("x")).select("place", "x.*").orderBy(F.desc("documents"), "place", "heavy").limit(HEAVIEST)
    heavy = np.sort(np.array([(r["place"] << (bits + 1)) | r["heavy"] for r in top.collect()], np.int64))  # HEAVIEST rows at most

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, owners in _gathered(batches):
            at, one, two = placed(keys, ranges, bits)
            known = np.isin((at << (bits + 1)) | one, heavy) & np.isin((at << (bits + 1)) | two, heavy)
            if known.any():  # answered here; places below 0 spread what only passes
                by = np.flatnonzero(known)
                by = by[np.argsort(owners[by], kind="stable")]
                yield _packed(-1 - (owners[by] & 0xFFFF), 2, keys[by], owners[by])
            by = np.flatnonzero(~known)
            by = by[np.argsort(at[by], kind="stable")]
            if len(by):
                yield _packed(at[by], 1, keys[by], owners[by])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, here = np.zeros(2 << bits, np.uint32), None
        for batch in batches:
            for place, kind, a, b in zip(batch.column("place").to_pylist(), batch.column("kind").to_pylist(), batch.column("a"), batch.column("b"), strict=True):
                if kind == 0:
                    counts.fill(0)
                    counts[np.frombuffer(a.as_buffer(), np.int32)] = np.frombuffer(b.as_buffer(), np.uint32)
                    here = place
                    continue
                keys, owners = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.int64)
                if kind == 1:
                    if place != here:
                        continue  # no cell of this range counts two
                    _, one, two = placed(keys, ranges, bits)
                    seen = np.minimum(counts[one], counts[two])
                    pick = np.flatnonzero(seen >= 2)
                    keys, owners, hot = keys[pick], owners[pick], seen[pick] >= HOT
                else:
                    hot = np.ones(len(keys), bool)
                yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(keys.view(np.int64)), pa.array(hot)], ["key", "anchor", "hot"])

    both = merged.select("place", "kind", "a", "b").unionByName(table.mapInArrow(ask, _PACKED))
    return both.repartition("place").sortWithinPartitions("place", "kind").mapInArrow(answer, "key long, anchor long, hot boolean")


def _runs(starts: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """Where a new run begins in sorted ``starts``: not the successor of the one before, or another value in ``same``."""
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] != starts[:-1] + 1
    for x in same:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _covered(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which windows also occur in a smaller doc."""
    order = np.lexsort((doc, h2, h1))
    a, b, d = h1[order], h2[order], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    out = np.empty(len(order), bool)
    out[order] = d > d[np.flatnonzero(new)][group] if len(order) else False
    return out


_PAIRS = pa.schema([("anchor", pa.int64()), ("salt", pa.int64()), ("id", pa.int64()), ("body", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("hashes", pa.binary())])
_CANDIDATES = "anchor long, salt long, id long, body long, start long, stop long, hashes binary"
_RANGES = pa.schema([("id", pa.int64()), ("body", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _of_text(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """A hash of each key and the text it belongs to. Two that are equal by chance send a window more to the exact pass."""
    return mix(keys ^ mix(text.astype(np.uint64) + np.uint64(1)))


def _candidates(rows: DataFrame, names: list[str], window: int, anchor: int, salts: int) -> DataFrame:
    """Windows estimated in two documents or more, as runs; those that a smaller document of the same batch holds need no
    grouping and come without hashes. ``names``: the columns of id, text hash, repeated anchors and hot anchors."""
    id_, body_, repeated_, hot_ = names

    def listed(column: pa.Array) -> np.ndarray:
        text = np.repeat(np.arange(len(column)), np.asarray(column.value_lengths()))
        return _of_text(np.asarray(column.flatten()).astype(np.int64).view(np.uint64), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"))
                h = word_hashes(w)
                keys, at = anchors(h, w, window, anchor)
                mine = _of_text(keys, w.doc[at])
                pick = np.flatnonzero(np.isin(mine, listed(part.column(repeated_))))
                if not len(pick):
                    continue
                keys, at, hot = keys[pick], at[pick], np.isin(mine[pick], listed(part.column(hot_)))
                h1, h2 = gram_hashes(h, window)[at], gram_hashes(mix(h ^ _SEEDS[1]), window)[at]
                text = w.doc[at]
                ids, bodies = np.asarray(part.column(id_))[text], np.asarray(part.column(body_))[text]
                start = at - w.first[text]
                salt = np.where(hot, (mix(ids.astype(np.uint64)) % np.uint64(salts)).astype(np.int64), -1)
                done = _covered(h1, h2, ids)
                for local in (True, False):
                    k = np.flatnonzero(done == local)
                    if not len(k):
                        continue
                    begin = _runs(start[k], text[k], *([] if local else [keys[k]]))
                    end = np.append(begin[1:], len(k))
                    first = k[begin]
                    if local:
                        grams = pa.nulls(len(begin), pa.binary())
                    else:
                        raw = np.stack([h1[k], h2[k]], axis=1).tobytes()
                        grams = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(k)).astype(np.int32) * 16), pa.py_buffer(raw)])
                    out = [pa.array(keys[first].view(np.int64)), pa.array(salt[first]), pa.array(ids[first]), pa.array(bodies[first]), pa.array(start[first]), pa.array(start[first] + (end - begin)), grams]
                    yield pa.RecordBatch.from_arrays(out, schema=_PAIRS)

    return rows.mapInArrow(run, _CANDIDATES)


def _resolved(candidates: DataFrame, window: int, last: bool, most: int = 1 << 20) -> DataFrame:
    """Covered windows, as ranges of starts without hashes; equal windows have equal anchors, so they meet in one task.

    Windows of hot anchors are first dealt out by (anchor, hash of the id): there all but those of the smallest id are found to be covered, and what
    is left, of equal windows those of one document for each salt, goes on to the ``last`` step, each window by its own hash, so that the many different
    windows around a common anchor meet in no one task."""

    def runs_of(rows: list[tuple], pair: np.ndarray, k: np.ndarray, row: np.ndarray, pos: np.ndarray, hashed: bool) -> pa.RecordBatch:
        begin = np.arange(len(k)) if hashed else _runs(pos[k], row[k])
        end = np.append(begin[1:], len(k))
        first = row[k[begin]]
        cols = [np.array([rows[i][c] for i in first], np.int64) for c in range(4)]
        hashes = [pair[k[x:y]].tobytes() for x, y in zip(begin, end, strict=True)] if hashed else pa.nulls(len(begin), pa.binary())
        start = pos[k[begin]]
        if hashed:  # each window by itself, placed by its own hash
            cols[0] = np.ascontiguousarray(pair[k, 0]).view(np.int64)
        return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(start), pa.array(start + (end - begin)), hashes if not hashed else pa.array(hashes, pa.binary())], schema=_PAIRS)

    def flush(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        n = np.array([len(r[5]) // 16 for r in rows])
        pair = np.frombuffer(b"".join(r[5] for r in rows), np.uint64).reshape(-1, 2)
        row = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.array([r[4] for r in rows])[row]
        gone = _covered(pair[:, 0], pair[:, 1], np.array([r[2] for r in rows])[row])
        if gone.any():
            yield runs_of(rows, pair, np.flatnonzero(gone), row, pos, False)
        left = np.flatnonzero(~gone & (np.array([r[1] for r in rows])[row] >= 0))
        if not last and len(left):
            yield runs_of(rows, pair, left, row, pos, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, before = [], 0, None
        for batch in batches:
            local = batch.filter(pa.compute.is_null(batch.column("hashes")))
            if len(local):
                yield local
            rest = batch.filter(pa.compute.is_valid(batch.column("hashes")))
            for anchor, salt, i, body, start, hashes in zip(*(rest.column(c).to_pylist() for c in ("anchor", "salt", "id", "body", "start", "hashes")), strict=True):
                key = anchor if last else (anchor, salt)
                if held >= most and key != before:
                    yield from flush(rows)
                    rows, held = [], 0
                rows.append((anchor, salt, i, body, start, hashes))
                held, before = held + len(hashes) // 16, key
        if rows:
            yield from flush(rows)

    place = F.when(F.col("hashes").isNull(), F.xxhash64("id", "body")).otherwise(F.col("anchor")).alias("place")  # what is decided only passes
    keys = ["place"] if last else ["place", "salt"]
    dealt = candidates.select("*", place).repartition(*keys).sortWithinPartitions(*keys).drop("place")
    return dealt.mapInArrow(run, _CANDIDATES)


def _id_and_body(documents: DataFrame) -> tuple[Column, Column]:
    """What tells a row: its id (rows without one: the largest) and a hash of its text."""
    return F.coalesce(documents["doc_id"].cast("long"), F.lit(_LARGEST)), F.xxhash64(F.coalesce(documents["text"].cast("string"), F.lit("")))


def _removed(w: Words, d: int, ranges: list[dict]) -> np.ndarray:
    """Which words of text ``d`` the ranges cover."""
    delta = np.zeros(int(w.counts[d]) + 1, np.int64)
    for r in ranges or ():
        delta[r["start"]] += 1
        delta[r["stop"]] -= 1
    return np.cumsum(delta)[:-1] > 0


def deduplicated(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int | None = None) -> DataFrame:
    """``documents``, all columns, with what is left as ``text`` (white space as it was; unchanged if nothing goes), and ``_n_words``,
    ``_n_removed`` and ``_kept_sha256`` (of the words left, joined by one space)."""
    names, added = documents.columns, free(documents.columns, *ADDED)
    id_, body_, key, repeated, hot = free([*names, *added], "_id", "_body", "_key", "_repeated", "_hot")
    rows = documents.select(*[documents[c].cast("string").alias(c) if c == "text" else documents[c] for c in names], *[c.alias(n) for c, n in zip(_id_and_body(documents), (id_, body_), strict=True)])
    rows = rows.withColumn(key, F.xxhash64(id_, body_))
    flags = estimated(rows.select(F.col(key).alias("key"), "text"), window, anchor, bits)
    flags = flags.groupBy(F.col("key").alias(key)).agg(F.collect_list("anchor").alias(repeated), F.collect_list(F.when(F.col("hot"), F.col("anchor"))).alias(hot))
    salts = max(16, math.isqrt(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1)
    # both joins read all columns of rows, placed by key: one exchange serves them
    found = _candidates(rows.join(flags, key), [id_, body_, repeated, hot], window, anchor, salts)
    found = _resolved(_resolved(found, window, last=False), window, last=True)
    span = F.struct("id", "body", "start", (F.col("stop") + window - 1).alias("stop"))
    ranges = found.groupBy(F.xxhash64("id", "body").alias(key)).agg(F.collect_list(span).alias(added[0]))
    own = F.filter(added[0], lambda r: (r["id"] == F.col(id_)) & (r["body"] == F.col(body_)))
    joined = rows.join(ranges, key, "left").select(*[F.col(f"`{c}`") for c in names], F.transform(own, lambda r: F.struct(r["start"].alias("start"), r["stop"].alias("stop"))).alias(added[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"))
                texts, counts, removed, digests = [], [], [], []
                for d, (text, found) in enumerate(zip(part.column("text").to_pylist(), part.column(added[0]).to_pylist(), strict=True)):
                    body = (text or "").encode()
                    pieces = body.split()
                    gone = _removed(w, d, found)
                    n = int(gone.sum())
                    if n:
                        pieces = [p for p, g in zip(pieces, gone, strict=True) if not g]
                        begin = w.start[w.first[d] : w.first[d + 1]] - w.offset[d]
                        after = np.append(begin[1:], len(body))
                        text = (body[: begin[0]] + b"".join(body[a:b] for a, b, g in zip(begin, after, gone, strict=True) if not g)).decode()
                    texts.append(text)
                    counts.append(len(gone))
                    removed.append(n)
                    digests.append(hashlib.sha256(b" ".join(pieces)).hexdigest())
                kept = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)], [*names, *added[1:]])

    schema = joined.drop(added[0]).schema.add(added[1], "long").add(added[2], "long").add(added[3], "string")
    return joined.mapInArrow(run, schema)
