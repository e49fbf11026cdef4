"""Cost-balanced packing of token ids into sequences of bounded length.

A document's cost is ``linear * n + quadratic * n * n`` for ``n`` tokens: matrix products and attention within the document.

1. A task tokenizes its documents, each once, and keeps ids only of what isn't packed yet. Full stretches of ``capacity`` ids of a longer
   document are sequences of their own. What is left of the documents waits in a pool.
2. When the pool holds ``POOL`` ids (or ``DOCUMENTS`` documents), as many sequences as it can fill are packed: documents in descending order of cost
   go, whole, to the sequence of lowest cost that has room for them; those that find no room are then cut into the holes that
   are left. So sequences are full, and at most one document is cut for each hole.
3. What a task has left at its end, fewer than ``capacity`` ids, goes on with its ids, the only ids that are shuffled. These remainders are dealt
   out by count, packed the same way, and each of these few tasks puts its own last ids into sequences of 2048, 1024, ... ids, by the binary digits of
   their number. So no sequence is padded: each has ``capacity`` ids or a power of two.

Nothing is gathered: shuffled are at most ``capacity`` ids a task. The packed pieces are written before they are read again, so a lost
executor costs its tasks only. Sequence ids are made of the step, the task and a count.

Ids come from the vocabulary's own library, unit by unit (see ``vocabularies``): it drops white space, and a text may be cut at blanks, tabs and
line ends, since no token, no composition of characters and no special token spans one.

Defined cases: a null or empty text is the end id alone; rows with equal ids and equal texts are documents of their own, and a null id stays null; an
empty table gives no rows; a text of any length is tokenized in stretches; of equal costs the first sequence, and of equal documents the first in the
task, is taken; other columns are ignored. Special tokens' strings in a text are the library's special ids, as it encodes them by default.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocabularies
from .shared import columns, stored
from .wordhash import slices

#: Ids and documents that wait in a task's pool at most.
POOL, DOCUMENTS = 1 << 21, 1 << 15


@dataclass(frozen=True)
class Cost:
    """Work for a document of n tokens: ``linear * n + quadratic * n * n``."""

    linear: float = 1.0
    quadratic: float = 1 / 2048

    def of(self, n):
        return self.linear * n + self.quadratic * n * n


def assigned(lengths: np.ndarray, rooms: np.ndarray, cost: Cost) -> list[tuple[int, int, int, int]]:
    """(document, from, to, sequence): every sequence is filled; there must be enough ids."""
    room, load, out, waiting = rooms.copy(), np.zeros(len(rooms)), [], []
    for d in np.argsort(-cost.of(lengths.astype(float)), kind="stable").tolist():
        n = int(lengths[d])
        least = np.where(room >= n, load, np.inf)
        s = int(least.argmin()) if len(least) else 0
        if not len(least) or least[s] == np.inf:
            waiting.append(d)
            continue
        out.append((d, 0, n, s))
        room[s] -= n
        load[s] += cost.of(n)
    holes = [s for s in np.argsort(load, kind="stable").tolist() if room[s]]
    at = 0
    for d in waiting:
        begin, n = 0, int(lengths[d])
        while begin < n and at < len(holes):
            s = holes[at]
            part = min(n - begin, int(room[s]))
            out.append((d, begin, begin + part, s))
            begin, room[s] = begin + part, room[s] - part
            at += not room[s]
    return out


def binary_rooms(n: int) -> list[int]:
    """Powers of two that sum to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_SCHEMA = pa.schema([*[(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")], ("ids", pa.binary())])


class Pool:
    """What one task packs. Rows come out of ``take`` as pieces; ``rest`` gives what isn't packed, without a sequence."""

    def __init__(self, step: int, capacity: int, cost: Cost, ids: bool, most: int) -> None:
        self.capacity, self.cost, self.ids, self.most = capacity, cost, ids, most
        self.sequence = step << 61 | TaskContext.get().partitionId() << 30
        self.waiting: list[tuple[int | None, int, np.ndarray, int]] = []
        self.held, self.rows = 0, []

    def _piece(self, doc: tuple, begin: int, end: int, sequence: int, offset: int) -> None:
        raw = doc[2][begin:end].astype("<u4").tobytes()
        self.rows.append((doc[0], doc[1] + begin, end - begin, zlib.crc32(raw), doc[3], sequence, offset, raw if self.ids else None))

    def add(self, doc_id: int | None, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        doc, whole = (doc_id, start, ids, doc_tokens), len(ids) // self.capacity * self.capacity
        for k in range(0, whole, self.capacity):
            self._piece(doc, k, k + self.capacity, self.sequence, 0)
            self.sequence += 1
        if whole < len(ids):
            self.waiting.append((doc_id, start + whole, ids[whole:].copy(), doc_tokens))
            self.held += len(ids) - whole
            if self.held >= self.most or len(self.waiting) >= max(DOCUMENTS, self.capacity):
                self.pack()

    def pack(self, last: bool = False) -> None:
        """Fill as many sequences as the pool can; with ``last``, shorter ones too, until nothing waits."""
        rooms = [self.capacity] * (self.held // self.capacity) + (binary_rooms(self.held % self.capacity) if last else [])
        plan = assigned(np.array([len(d[2]) for d in self.waiting], np.int64), np.array(rooms, np.int64), self.cost)
        offset, done = np.zeros(len(rooms), np.int64), np.zeros(len(self.waiting), np.int64)
        for d, begin, end, s in plan:
            self._piece(self.waiting[d], begin, end, self.sequence + s, int(offset[s]))
            offset[s] += end - begin
            done[d] = end
        self.sequence += len(rooms)
        self.waiting = [(i, start + int(k), ids[k:].copy(), n) for (i, start, ids, n), k in zip(self.waiting, done, strict=True) if k < len(ids)]
        self.held = sum(len(d[2]) for d in self.waiting)

    def take(self) -> Iterator[pa.RecordBatch]:
        rows, self.rows = self.rows, []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    def rest(self) -> Iterator[pa.RecordBatch]:
        self.rows = [(i, start, len(ids), None, n, None, None, ids.astype("<u4").tobytes()) for i, start, ids, n in self.waiting]
        yield from self.take()


#: What a unit is made of whose words are known without the library: ASCII and the letters of Latin-1, whose lower case and composition depend on
#: nothing else. ``WORDS``: the vocabulary's own pattern for lower-case units of these characters.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
#: Byte that ends a word, as it can't occur in UTF-8.
END = b"\xff"


def plain_words(tokenizer: bytes):
    """A function from units to their ids, None for units that aren't ``PLAIN`` or may hold a special token. The merges of a word are those of the rank
    library's core: a word's last character and its end are merged first, then pairs by rank, as ids rise with the merges. A vocabulary that isn't of this
    kind gives None."""
    import tiktoken

    rule = json.loads(tokenizer)
    model, special = rule["model"], {t["content"] for t in rule["added_tokens"]}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocabulary.get(a + b, -1) for a, b in pairs]
    steps = [x.get("type") for k in ("normalizer", "pre_tokenizer") for x in (rule[k] or {}).get("normalizers", (rule[k] or {}).get("pretokenizers", []))]
    if steps != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] or model["end_of_word_suffix"] != "</w>" or ids != sorted(set(ids)) or ids[:1] != [512] or not all("<|" in x for x in special):
        return None
    byte_of = {c: bytes([b]) for b, c in vocabularies.byte_characters().items()}
    ranks = {b"".join(byte_of[c] for c in t.removesuffix("</w>")) + (END if t.endswith("</w>") else b""): i for t, i in vocabulary.items()}
    merged = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def encode(new: list[str]) -> list[list[int] | None]:
        return [[i for w in WORDS(u.lower()) for i in merged(w.encode() + END)] if not u or PLAIN(u) and "<|" not in u else None for u in new]

    return encode


#: Stands between units that are encoded in one call; units that hold it are encoded by themselves.
MARK = "\ue000"


def tokens(tokenizer: bytes):
    """A function from texts to their ids (an array for each)."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_buffer(tokenizer)
    one = lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    mark = np.array(one([MARK])[0])

    def encode(new: list[str]) -> tuple[list[list[int]]]:
        """One call for all units: the mark between blanks is a token run of its own, which no unit without it can hold."""
        if any(MARK in u for u in new):
            return (one(new),)
        ids = np.array(one([f" {MARK} ".join(new)])[0], np.int64)
        at = np.flatnonzero(np.all([ids[k : len(ids) - len(mark) + 1 + k] == mark[k] for k in range(len(mark))], axis=0)) if len(ids) >= len(mark) else np.zeros(0, np.int64)
        if len(at) != len(new) - 1:
            return (one(new),)
        ids, starts, ends = ids.tolist(), [0, *(at + len(mark)).tolist()], [*at.tolist(), len(ids)]
        return ([ids[a:b] for a, b in zip(starts, ends, strict=True)],)

    plain = plain_words(tokenizer)

    def both(new: list[str]) -> tuple[list[list[int]]]:
        found = plain(new) if plain else [None] * len(new)
        rest = [u for u, x in zip(new, found, strict=True) if x is None]
        others = iter(encode(rest)[0] if rest else [])
        return ([next(others) if x is None else x for x in found],)

    units = vocabularies.Units(both)
    split = lambda part, first: part.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
    blank = re.compile(r"[ \t\n\r]")
    return lambda texts: units.texts(texts, split, blank)[0]


def packed(documents: DataFrame, tokenizer: bytes, end: int = 2, capacity: int = 4096, cost: Cost = Cost(), ids: bool = False, pool: int = POOL) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with ``ids``, also ``ids`` (binary, four bytes an id,
    little-endian)."""
    docs = columns(documents, doc_id="long", text="string")
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer)  # one vocabulary file

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, own = vocabularies.once(zlib.crc32(shared.value), lambda: tokens(shared.value)), Pool(0, capacity, cost, ids, pool)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, found in zip(part.column("doc_id").to_pylist(), encode(texts), strict=True):
                    found = np.append(found, end)
                    own.add(doc_id, 0, found, len(found))
                yield from own.take()
        own.pack()
        yield from own.take()
        yield from own.rest()

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pool(1, capacity, cost, ids, pool)
        for batch in batches:
            for doc_id, start, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
                own.add(doc_id, start, np.frombuffer(raw, "<u4"), n)
        own.pack(last=True)
        yield from own.take()

    done = stored(docs.mapInArrow(first, PIECES), "packed")
    left = done.filter("sequence_id is null")
    size = left.agg(F.sum("length").alias("n")).first()["n"] or 0
    again = left.repartition(-(-size // pool) or 1).mapInArrow(second, PIECES)  # fewer than ``capacity`` ids from each task
    out = done.filter("sequence_id is not null").unionByName(again)
    return out if ids else out.drop("ids")
