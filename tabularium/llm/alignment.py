"""Cross-tokenizer alignment: divide and conquer at shared cuts, and how strongly pairs of ids are linked over the corpus.

Tokens of both vocabularies cover the same bytes of a document. An interval of tokens of both that covers the same bytes is cut where a token
of A and one of B end at the same byte: the token end of A nearest to the interval's middle that B shares is located by bisecting B's ends, and both
halves go on; an interval without such an end inside is a leaf, a group. All intervals of a level, of many documents, are
searched at once, so a document of n tokens takes log n steps of array operations.

1. A task tokenizes and aligns its documents. A chunk of documents (``LINKS`` distinct links together) keeps, besides a row for each document,
   a dictionary of its distinct id pairs with the number of its documents that hold each; documents refer to it by position.
2. Dictionaries, not links, are shuffled: documents that hold a pair are summed by pair, the best count of each id of A by id (one row
   for each id of the vocabulary at most, broadcast).
3. Counts go back to the chunks by pair, chunk by chunk to the documents. A pair that every document holds is one row a chunk.

Tokens come from the libraries unit by unit (see ``vocabularies``): the text is cut before a blank between two other characters, where neither
vocabulary joins anything (A's pattern puts one blank before a word; no piece of B holds a blank after another character, which is checked).

Defined cases: a null or empty text, or one that either vocabulary's bytes don't give back, has no tokens: zeros and ''; rows with equal ids
are documents of their own, also in counts; a null id stays null; an empty table gives no rows; equal counts are all best; other columns are ignored; a
text of any length is tokenized in stretches.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocabularies
from .shared import columns, stored
from .wordhash import slices

#: Distinct links of the documents of a chunk; bytes of text that are aligned at once; a group of more links is counted by distinct ids.
LINKS, SLICE, LARGE = 1 << 20, 1 << 20, 1 << 16
#: Ends on either side of the middle that are tried one by one before an interval's ends are all bisected.
NEAR = 8


def groups(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Leaf groups (from and to of A, from and to of B), in order. ``ends_*``: rising byte ends of all tokens; ``first_*``: where each document's
    tokens begin, and their number; documents end at common bytes."""
    now = np.stack([first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]])
    now, leaves = now[:, now[0] < now[1]], []
    while now.shape[1]:
        open_ = (now[1] - now[0] > 1) & (now[3] - now[2] > 1)
        leaves.append(now[:, ~open_])
        now = now[:, open_]
        a, b = _cuts(ends_a, ends_b, now)
        cut = a >= 0
        leaves.append(now[:, ~cut])
        (a0, a1, b0, b1), a, b = now[:, cut], a[cut], b[cut]
        now = np.concatenate([np.stack([a0, a, b0, b]), np.stack([a, a1, b, b1])], axis=1)
    found = np.concatenate(leaves, axis=1) if leaves else np.zeros((4, 0), np.int64)
    return tuple(found[:, np.argsort(found[0])])


def _cuts(ends_a: np.ndarray, ends_b: np.ndarray, intervals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the tokens of A and B that begin at the common end nearest to the middle of A, or -1."""
    a0, a1 = intervals[0], intervals[1]
    middle = (a0 + a1 - 2) // 2
    cut_a, cut_b = np.full(len(a0), -1), np.full(len(a0), -1)
    left = np.arange(len(a0))
    for step in range(2 * NEAR + 1):
        at = middle[left] + (step + 1) // 2 * (1 if step % 2 else -1)
        inside = (at >= a0[left]) & (at < a1[left] - 1)  # an interval's last end is no cut
        at, row = at[inside], left[inside]
        b = np.searchsorted(ends_b, ends_a[at])
        hit = ends_b[b] == ends_a[at]
        cut_a[row[hit]], cut_b[row[hit]] = at[hit] + 1, b[hit] + 1
        left = left[cut_a[left] < 0]
    for row in left[a1[left] - a0[left] > NEAR]:
        at = np.arange(a0[row], a1[row] - 1)
        b = np.searchsorted(ends_b, ends_a[at])
        hit = np.flatnonzero(ends_b[b] == ends_a[at])
        if len(hit):
            k = hit[np.abs(at[hit] - middle[row]).argmin()]
            cut_a[row], cut_b[row] = at[k] + 1, b[k] + 1
    return cut_a, cut_b


class Digits:
    """Decimal digits of ids, for joining them without a Python string each."""

    def __init__(self, ids: int) -> None:
        texts = [str(i).encode() for i in range(ids)]
        self.n = np.array([len(t) for t in texts], np.int64)
        self.width = int(self.n.max()) + 1
        self.table = np.frombuffer(b"".join(t.ljust(self.width) for t in texts), np.uint8).reshape(ids, self.width)
        self.used = np.arange(self.width)[None, :] <= self.n[:, None]  # the digits and what follows them

    def joined(self, ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, each with the byte ``after`` it, and the number of bytes of each."""
        cells = self.table[ids]
        cells[np.arange(len(ids)), self.n[ids]] = after
        return cells[self.used[ids]], self.n[ids] + 1


def links(ids_a: np.ndarray, ids_b: np.ndarray, found: tuple[np.ndarray, ...], doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, times) of all links, equal ones together; ``doc``: the document of each group; a pair is ``a * width + b``."""
    a0, a1, b0, b1 = found
    size = (a1 - a0) * (b1 - b0)
    keys, weights, docs = [], [], []
    small = size <= LARGE
    n = (a1 - a0)[small]  # one line for each token of A ...
    a = np.arange(int(n.sum())) + np.repeat(a0[small] - np.cumsum(n) + n, n)
    m = np.repeat((b1 - b0)[small], n)  # ... times the tokens of B in its group
    b = np.arange(int(m.sum())) + np.repeat(np.repeat(b0[small], n) - np.cumsum(m) + m, m)
    keys.append(np.repeat(ids_a[a], m) * width + ids_b[b])
    docs.append(np.repeat(np.repeat(doc[small], n), m))
    weights.append(np.ones(len(keys[0]), np.int64))
    for g in np.flatnonzero(~small):
        (ua, na), (ub, nb) = np.unique(ids_a[a0[g] : a1[g]], return_counts=True), np.unique(ids_b[b0[g] : b1[g]], return_counts=True)
        keys.append((ua[:, None] * width + ub[None, :]).ravel())
        weights.append((na[:, None] * nb[None, :]).ravel())
        docs.append(np.full(len(keys[-1]), doc[g]))
    key, weight, of = np.concatenate(keys), np.concatenate(weights), np.concatenate(docs)
    order = np.lexsort((key, of))
    key, weight, of = key[order], weight[order], of[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    return of[first], key[first], np.add.reduceat(weight, first) if len(first) else weight


class Aligner:
    """Both vocabularies on an executor: what becomes of a list of texts."""

    CUT = re.compile(r"(?<=\S) (?=\S)")
    #: Whether a unit may stand between two others.
    INNER = re.compile(r"\S(.*\S)?", re.DOTALL).fullmatch

    def __init__(self, a: bytes, b: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        own = Tokenizer.from_buffer(a)
        own.encode_special_tokens = True
        alphabet, chars = vocabularies.byte_characters(), ByteLevel.alphabet()
        if set(alphabet.values()) != set(chars):
            raise ValueError("A isn't a byte-level vocabulary")
        back = {c: bytes([x]) for x, c in alphabet.items()}
        size_a = max(own.get_vocab().values()) + 1
        self.bytes_a = [b""] * size_a
        for token, i in own.get_vocab().items():
            self.bytes_a[i] = b"".join(back.get(c, c.encode()) for c in token)
        other = sentencepiece.SentencePieceProcessor(model_proto=b)
        pieces = [other.id_to_piece(i) for i in range(other.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of B holds a blank after another character")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.len_a, self.len_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        self.width, self.digits = len(pieces), Digits(max(size_a, len(pieces)))

        def encode(new: list[str]) -> tuple[list[list[int]], ...]:
            one = lambda units: [e.ids for e in own.encode_batch_fast(units, add_special_tokens=False)]
            want = [b" " + u.encode() for u in new]
            ids_b, ends = other.encode(new, num_threads=1), np.cumsum([len(u) for u in want])
            ids_a = None
            if all(self.INNER(u) for u in new):  # one call for all units: cut where each ends
                ids = np.array(one([" " + " ".join(new)])[0], np.int64)
                at = np.cumsum(self.len_a[ids])
                cut = np.searchsorted(at, ends)
                if len(at) and at[-1] == ends[-1] and (at[cut] == ends).all():
                    ids, cut = ids.tolist(), [0, *(cut + 1).tolist()]
                    ids_a = [ids[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
            ids_a = one([" " + u for u in new]) if ids_a is None else ids_a
            good = [1] * len(new)
            for pieces, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)):
                if b"".join(map(pieces.__getitem__, chain.from_iterable(ids))) != b"".join(want):
                    good = [g & (b"".join([pieces[i] for i in x]) == w) for g, x, w in zip(good, ids, want, strict=True)]
            return ids_a, ids_b, [[int(g)] for g in good]

        self.units = vocabularies.Units(encode, kinds=3)

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of each text, none where a text has none."""
        split = lambda part, first: self.CUT.split(part if first else part[1:])  # noqa: E731  the blank of a cut is part of the unit behind it
        none = np.zeros(0, np.int64)
        return [(a, b) if text and same.all() else (none, none) for text, a, b, same in zip(texts, *self.units.texts(texts, split, self.CUT), strict=True)]

    def align(self, texts: list[str | None]) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray]:
        """A dict of counts and digest for each text, and (text, pair, times) of all links."""
        held = self.tokens([t or "" for t in texts])
        n_a, n_b = (np.array([len(h[k]) for h in held], np.int64) for k in (0, 1))
        ids_a, ids_b = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        first_a, first_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
        found = groups(np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b]), first_a, first_b)
        a0, a1, b0, b1 = found
        doc = np.searchsorted(first_a, a0, "right") - 1
        sizes = np.bincount(doc, (a1 - a0) * (b1 - b0), len(texts)).astype(np.int64)
        counts = np.bincount(doc, minlength=len(texts))
        # The text of all groups: A's ids of a group stand before B's.
        ids, after = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
        ids[np.arange(len(ids_a)) + np.repeat(b0, a1 - a0)] = ids_a
        ids[np.arange(len(ids_b)) + np.repeat(a1, b1 - b0)] = ids_b
        after[a1 + b0 - 1], after[a1 + b1 - 1] = ord("|"), ord(";")
        raw, n = self.digits.joined(ids, after)
        raw, at = raw.tobytes(), np.append(0, np.cumsum(n))[first_a + first_b]
        rows = []
        for d in range(len(texts)):
            sha = hashlib.sha256(raw[at[d] : at[d + 1] - 1]).hexdigest() if n_a[d] else ""
            rows.append({"n_a": int(n_a[d]), "n_b": int(n_b[d]), "n_groups": int(counts[d]), "n_links": int(sizes[d]), "groups_sha256": sha})
        return rows, *links(ids_a, ids_b, found, doc, self.width)


_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_TABLE = f"chunk long, {_DOC}, at array<int>, times array<int>, pairs array<long>, docs array<int>"
_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_TYPES = [pa.int64()] * 5 + [pa.string()]
_ARROW = pa.schema([("chunk", pa.int64()), *zip(_NAMES, _TYPES, strict=True), ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))])


def aligned(documents: DataFrame, a: bytes, b: bytes, links_a_chunk: int = LINKS) -> DataFrame:
    """Of each document a row (``chunk``, its counts and digest, and its distinct links: position ``at`` of a pair in the chunk's dictionary and how many
    ``times``), and of each chunk a row with its ``pairs`` and in how many of its ``docs`` each is linked."""
    docs = columns(documents, doc_id="long", text="string")
    shared = documents.sparkSession.sparkContext.broadcast((a, b))  # two vocabulary files

    def flush(chunk: int, rows: list[dict], doc: list[np.ndarray], pair: list[np.ndarray], times: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        doc_of, key, n = (np.concatenate(x) for x in (doc, pair, times))
        pairs, at, held = np.unique(key, return_inverse=True, return_counts=True)
        ends = np.searchsorted(doc_of, np.arange(len(rows) + 1)).astype(np.int32)
        lists = lambda x: pa.ListArray.from_arrays(pa.array(ends), pa.array(x, pa.int32()))
        nulls = [pa.nulls(len(rows), f.type) for f in list(_ARROW)[-2:]]
        cols = [pa.array([r[c] for r in rows], t) for c, t in zip(_NAMES, _TYPES, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(rows), pa.int64()), *cols, lists(at), lists(n), *nulls], schema=_ARROW)
        if len(pairs):
            cols = [pa.nulls(1, f.type) for f in list(_ARROW)[1:-2]]
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *cols, pa.array([pairs], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.int32()))], schema=_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = vocabularies.once(tuple(map(zlib.crc32, shared.value)), lambda: Aligner(*shared.value))
        chunk, rows, doc, pair, times, held = TaskContext.get().partitionId() << 32, [], [], [], [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                got, of, key, n = aligner.align(part.column("text").to_pylist())
                for row, doc_id in zip(got, part.column("doc_id").to_pylist(), strict=True):
                    row["doc_id"] = doc_id
                doc.append(of + len(rows))
                pair.append(key)
                times.append(n)
                rows += got
                held += len(of)
                if held >= links_a_chunk or len(rows) >= 1 << 16:
                    yield from flush(chunk, rows, doc, pair, times)
                    chunk, rows, doc, pair, times, held = chunk + 1, [], [], [], [], 0
        if rows:
            yield from flush(chunk, rows, doc, pair, times)

    return docs.mapInArrow(run, _TABLE)


def judged(documents: DataFrame, a: bytes, b: bytes, links_a_chunk: int = LINKS) -> DataFrame:
    """One row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_proto=b).get_piece_size()
    rows = stored(aligned(documents, a, b, links_a_chunk), "aligned")
    held = rows.filter("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "p")).select("chunk", "at", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = stored(held.groupBy("pair").agg(F.sum("docs").alias("count")), "pair-counts")
    a_id = F.expr(f"pair div {width}")
    best = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("most"))  # a row for each id of A at most
    counts = counts.withColumn("a", a_id).join(F.broadcast(best), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = held.select("chunk", "at", "pair").join(counts, "pair").select(F.col("chunk").alias("held_by"), "at", "count", "best")
    docs = rows.filter("pairs is null").select("chunk", *_NAMES, "at", "times")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = pa.schema([(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in names])

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        at = np.asarray(right.column("at").combine_chunks())
        count, best_ = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], best_[at] = np.asarray(right.column("count").combine_chunks()), np.asarray(right.column("best").combine_chunks().cast(pa.int64()))
        left = left.combine_chunks()
        lists = left.column("at").combine_chunks()
        where = np.asarray(lists.flatten()).astype(np.int64)
        times = np.asarray(left.column("times").combine_chunks().flatten()).astype(np.int64)
        of = np.repeat(np.arange(len(lists)), np.asarray(pa.compute.list_value_length(lists)).astype(np.int64))
        total, good = np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)
        np.add.at(total, of, times * count[where])
        np.add.at(good, of, times * best_[where])
        return pa.table([*[left.column(c) for c in names[:5]], pa.array(good), pa.array(total), left.column("groups_sha256")], schema=schema)

    kind = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names)
    return docs.groupBy("chunk").cogroup(back.groupBy("held_by")).applyInArrow(summed, kind)
