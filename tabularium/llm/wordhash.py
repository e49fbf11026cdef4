"""Vectorised words and word n-grams of many texts at once, on Arrow string buffers.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D`` in the UTF-8 text, so words equal the matches of
``[^\\x20\\x09-\\x0D]+``. No n-gram crosses a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Odd multipliers of 64-bit polynomial hashes and of the finaliser (splitmix64).
_BYTE_MUL, _GRAM_MUL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Words of more bytes are hashed one by one.
_LONG = 48

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Another meaning of words: runs of ASCII letters and digits and of all bytes above ASCII.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``most`` bytes of text each (a longer text makes a slice of its own)."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    ends, at = np.cumsum(lengths), 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


@dataclass
class Words:
    """``buf``: bytes of all texts end to end; word ``i`` is ``buf[start[i]:end[i]]`` of text ``doc[i]``; ``first[d]:first[d+1]`` are the words of text ``d``, whose bytes begin at ``offset[d]``."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    offset: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts have no bytes."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return buf, (offsets - offsets[0]) if len(column) else np.zeros(1, np.int64)


def words(column: pa.Array, lower: bool = False, separators: np.ndarray = _SPACE) -> Words:
    buf, offsets = buffers(column)
    space = separators[buf]
    begins = np.zeros(len(buf) + 1, bool)
    begins[offsets] = True  # a text's first byte begins a word, whatever ends the text before
    open_ = ~space
    start = open_.copy()
    if len(buf) > 1:
        start[1:] &= space[:-1] | begins[1:-1]
    last = open_.copy()
    if len(buf) > 1:
        last[:-1] &= space[1:] | begins[1:-1]
    at, to = np.flatnonzero(start), np.flatnonzero(last) + 1
    first = np.searchsorted(at, offsets, "left")
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(_LOWER[buf] if lower else buf, at, to, doc, first, offsets)


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    h, n = np.zeros(len(w.start), np.uint64), w.end - w.start
    if not len(h):
        return h
    h += n.astype(np.uint64)
    alive = np.flatnonzero(n <= _LONG)
    for k in range(_LONG):
        alive = alive[n[alive] > k]
        if not len(alive):
            break
        h[alive] = h[alive] * _BYTE_MUL + w.buf[w.start[alive] + k] + np.uint64(1)
    for i in np.flatnonzero(n > _LONG):
        h[i] = int.from_bytes(hashlib.blake2b(w.buf[w.start[i] : w.end[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(h)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries of ``h`` (also over text ends: mask those with ``whole``)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    built, length = h.copy(), 1
    plan = bin(n)[3:]
    for bit in plan:  # doubling: a run of 2k is a run of k followed by one of k
        power = np.uint64(pow(int(_GRAM_MUL), length, 1 << 64))
        built = built[: len(built) - length] * power + built[length:]
        length *= 2
        if bit == "1":
            built = built[:-1] * _GRAM_MUL + h[length:]
            length += 1
    return mix(built ^ np.uint64(n))


def whole(w: Words, n: int) -> np.ndarray:
    """Which runs of ``n`` words, by their first word, lie within one text."""
    if len(w.doc) < n:
        return np.zeros(0, bool)
    return w.doc[: len(w.doc) - n + 1] == w.doc[n - 1 :]
