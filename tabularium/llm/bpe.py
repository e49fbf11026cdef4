"""Byte-level BPE: higher-order functions fold ranked merges over the byte arrays of distinct words, with a literal rank map.

A text is cut by the tokenizer's pattern; each match ("word") is encoded by itself. The words of the whole corpus are counted, and
the distinct ones that occur most (``FOLDED`` at most) are folded by Spark: a word's ids and the rank of each neighbouring pair
are arrays, the pair of lowest rank, leftmost first, is merged until no pair has a rank. The rank map is a literal, a hash table in one
byte string whose size the rank file alone bounds.

The folded words travel to all executors (bounded), where texts are encoded; a word that is not among them gets the same merges
from a heap, kept in a bounded memory of the task. So no text and no occurrence of a word is shuffled, and which words
are folded where changes the time only. (Folding every distinct word by Spark costs some 120 microseconds a word, and a join back to
all occurrences; see the README.) Decoding concatenates the binary piece of each id.

Defined cases: null and empty texts have no tokens and decode to nothing; special tokens are ordinary text; repeated rows
and extra columns change nothing; a text of any length is encoded in stretches that end where no word can span.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free, stored

#: Distinct words folded by Spark at most; longest of them in bytes; words that a task remembers besides.
FOLDED, LONGEST, REMEMBERED, STRETCH = 1 << 16, 64, 1 << 18, 1 << 20


#: What ``encoded`` adds.
ADDED = ("_ids", "_n_tokens", "_ids_sha256", "_decoded_sha256")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: base64 and number on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def java_pattern(pattern: str) -> str:
    """The pattern with Unicode meanings of white space, as the tokenizer library has them."""
    return "(?U)" + pattern


def _h(key: bytes) -> int:
    """What ``xxhash64(binary)`` gives, unsigned."""
    return xxhash.xxh64_intdigest(key, 42)


def cuckoo(entries: dict[bytes, bytes], bits: int) -> bytes:
    """A hash table as one byte string: ``1 << bits`` slots of key and value; each key is in one of its two slots."""
    at: dict[int, bytes] = {}
    mask = (1 << bits) - 1
    for key in entries:
        slot = _h(key) & mask
        for _ in range(500):
            key, before = at.get(slot), key
            at[slot] = before
            if key is None:
                break
            h = _h(key)
            slot = (h >> 24 & mask) if slot == h & mask else h & mask
        else:
            raise ValueError("the table is too full")
    width = len(next(iter(at.values()))) + len(next(iter(entries.values())))
    out = bytearray(width << bits)
    for slot, key in at.items():
        out[slot * width : (slot + 1) * width] = key + entries[key]
    return bytes(out)


def _let(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


class Ranks:
    """The rank map as literals of a Spark expression. An id is its two bytes, high byte first, so that ids compare as numbers do
    and a pair is four bytes."""

    BITS = 18

    def __init__(self, ranks: dict[bytes, int]) -> None:
        if max(ranks.values()) >= 0xFFFF or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the rank map needs all single bytes and ids below 65,535")
        self.ranks = ranks
        two = lambda i: i.to_bytes(2, "big")
        table = {}
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                left, right = ranks.get(piece[:k]), ranks.get(piece[k:])
                if left is not None and right is not None:
                    table[two(left) + two(right)] = two(rank)
        self.table = cuckoo(table, self.BITS)
        signed = [h - (1 << 64) if (h := _h(bytes([b]))) >> 63 else h for b in range(256)]
        self.mod = next(m for m in range(4096, 1 << 20) if len({h % m for h in signed}) == 256)
        single = bytearray(2 * self.mod)
        for b, h in enumerate(signed):
            single[2 * (h % self.mod) : 2 * (h % self.mod) + 2] = two(ranks[bytes([b])])
        self.single = bytes(single)

    def rank(self, pair: str) -> str:
        mask, cut = (1 << self.BITS) - 1, "substring(T, cast({} as int) * 6 + 1, 6)"
        first, second = cut.format(f"(h & {mask}L)"), cut.format(f"(shiftright(h, 24) & {mask}L)")
        inner = _let("e", first, f"if(substring(e, 1, 4) = k, substring(e, 5, 2), {_let('e', second, 'if(substring(e, 1, 4) = k, substring(e, 5, 2), X\'FFFF\')')})")
        return _let("k", pair, _let("h", "xxhash64(k)", inner))

    def fold(self, word: str) -> str:
        """SQL: the ids of ``word`` as hexadecimal digits, four an id. T and S are the literals (see ``bound``)."""
        none = "cast(array() as array<binary>)"
        bytes_ = _let("b", f"cast({word} as binary)", f"transform(sequence(1, octet_length(b)), j -> substring(S, cast(pmod(xxhash64(substring(b, j, 1)), {self.mod}L) as int) * 2 + 1, 2))")
        ranks = f"if(size(i) < 2, {none}, transform(sequence(1, size(i) - 1), j -> {self.rank('concat(get(i, j - 1), get(i, j))')}))"
        ids = "concat(slice(a.i, 1, p - 1), array(m), slice(a.i, p + 2, size(a.i)))"
        before = f"if(p > 1, array({self.rank('concat(get(a.i, p - 2), m)')}), {none})"
        after = f"if(p + 1 < size(a.i), array({self.rank('concat(m, get(a.i, p + 1))')}), {none})"
        around = f"concat(slice(a.r, 1, greatest(p - 2, 0)), {before}, {after}, slice(a.r, p + 2, size(a.r)))"
        step = _let("m", "coalesce(array_min(a.r), X'FFFF')", f"if(m = X'FFFF', a, {_let('p', 'cast(array_position(a.r, m) as int)', f'named_struct(\'i\', {ids}, \'r\', {around})')})")
        start = _let("i", bytes_, f"named_struct('i', i, 'r', {ranks})")
        return f"array_join(transform(aggregate(sequence(1, octet_length({word})), {start}, (a, x) -> {step}, a -> a.i), x -> hex(x)), '')"

    def folded(self, word: str) -> Column:
        """``fold`` of a column, its literals bound once."""
        table, single = self.table.hex(), self.single.hex()
        return F.expr(_let("T", f"X'{table}'", _let("S", f"X'{single}'", self.fold(word))))


def fold_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one word with a heap: n log n for a word of n bytes."""
    n = len(word)
    ids: list[int | None] = [ranks[word[k : k + 1]] for k in range(n)]
    span = [k + 1 for k in range(n)]  # where the part that begins here ends
    back = list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(at: int) -> None:
        mid = span[at]
        if mid < n and (rank := ranks.get(word[at : span[mid]])) is not None:
            heapq.heappush(heap, (rank, at, mid, span[mid]))

    for k in range(n - 1):
        offer(k)
    while heap:
        rank, at, mid, end = heapq.heappop(heap)
        if ids[at] is None or span[at] != mid or ids[mid] is None or span[mid] != end:
            continue
        ids[at], ids[mid], span[at] = rank, None, end
        if end < n:
            back[end] = at
            offer(at)
        if at:
            offer(back[at])
    return [i for i in ids if i is not None]


def frequent_words(texts: DataFrame, pattern: str, most: int = FOLDED) -> DataFrame:
    """(word, n): as many of the commonest distinct words as fit in ``most``, counted over all texts. Words that occur once aren't."""
    cut = F.regexp_extract_all("text", F.lit(java_pattern(pattern)), F.lit(0))
    words = texts.filter("text is not null").select(F.explode(cut).alias("word"))
    counts = stored(words.groupBy("word").agg(F.count("*").alias("n")).filter((F.col("n") > 1) & (F.octet_length("word") <= LONGEST)), "words")
    total, least = 0, None
    for row in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        total += row["words"]
        if total > most:
            break
        least = row["n"]
    return counts.filter(F.col("n") >= least) if least is not None else counts.limit(0)


def fold_words(words: DataFrame, ranks: dict[bytes, int]) -> dict[str, list[int]]:
    """Ids of each word of a bounded table, by Spark's higher-order functions."""
    rows = words.repartition(32, "word").select("word", Ranks(ranks).folded("word").alias("ids")).collect()  # FOLDED rows at most
    return {r["word"]: [int(r["ids"][k : k + 4], 16) for k in range(0, len(r["ids"]), 4)] for r in rows}


def stretches(text: str, most: int = STRETCH) -> Iterator[str]:
    """The text in parts; each ends before a single space between two other characters, which no word spans."""
    at = 0
    while len(text) - at > most:
        to = at + most
        while to < len(text) - 1 and not (text[to] == " " and not text[to - 1].isspace() and not text[to + 1].isspace()):
            to += 1
        if to >= len(text) - 1:
            break
        yield text[at:to]
        at = to
    yield text[at:]


class Encoder:
    """Encodes texts on an executor: known words by look-up, all others by ranked merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, known: dict[str, list[int]]) -> None:
        import regex

        self.ranks, self.find, self.pieces = ranks, regex.compile(pattern).findall, [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.by_id = {str(i): p for i, p in enumerate(self.pieces)}
        self.known = {w: " ".join(map(str, ids)) for w, ids in known.items()}
        self.memory: dict[str, str] = {}

    def _other(self, word: str) -> str:
        ids = self.memory.get(word)
        if ids is None:
            ids = " ".join(map(str, fold_bytes(word.encode(), self.ranks)))
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            if len(word) <= LONGEST:
                self.memory[word] = ids
        return ids

    def encode(self, text: str) -> str:
        """Decimal ids joined by one space."""
        known, other = self.known.get, self._other
        return " ".join([" ".join([known(w) or other(w) for w in self.find(part)]) for part in stretches(text)]) if text else ""

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.by_id.__getitem__, ids.split(" "))) if ids else b""


def encoded(documents: DataFrame, ranks: dict[bytes, int], pattern: str, ids: bool = True) -> DataFrame:
    """``documents``, all columns, with ``_ids`` (decimal, joined by one space; null unless ``ids``), ``_n_tokens``, ``_ids_sha256`` and, decoded from the ids, ``_decoded_sha256``."""
    names, added = documents.columns, free(documents.columns, *ADDED)
    texts = documents.select(F.col("text").cast("string").alias("text"))
    known = fold_words(frequent_words(texts, pattern), ranks)
    shared = documents.sparkSession.sparkContext.broadcast((ranks, pattern, known))  # the rank file and FOLDED words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                found = [encoder.encode(text or "") for text in part.column("text").to_pylist()]
                tokens = [x.count(" ") + 1 if x else 0 for x in found]
                sha, back = [hashlib.sha256(x.encode()).hexdigest() for x in found], [hashlib.sha256(encoder.decode(x)).hexdigest() for x in found]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found if ids else [None] * len(found), pa.string()), pa.array(tokens, pa.int64()), pa.array(sha), pa.array(back)], [*names, *added])

    schema = documents.schema
    schema = type(schema)(list(schema.fields)).add(added[0], "string").add(added[1], "long").add(added[2], "string").add(added[3], "string")
    return documents.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)
