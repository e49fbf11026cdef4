"""Ids of texts by the public tokenizers, looked up by unit: distinct units of a text are encoded once, all others are array look-ups.

A unit is a stretch of a text that a tokenizer encodes by itself, whatever stands before and after it (which cuts are such is for the caller to
know and to state). The memory of units is bounded and lasts as long as the Python worker. Tokenizer files are read by the driver and
travel as bytes, so no task needs a path.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count, islice

import numpy as np

#: Units that a worker remembers and their characters together; characters of a text that are handled at once.
REMEMBERED, CHARACTERS, STRETCH = 1 << 18, 1 << 24, 1 << 20

_KEPT: dict = {}


def once(key, make: Callable):
    """What ``make`` gives, once for each Python worker and key."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class Flat:
    """Integer lists end to end in one growing array."""

    def __init__(self) -> None:
        self.flat, self.first, self.n, self.used, self.rows = np.zeros(1 << 12, np.int64), np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64), 0, 0

    def add(self, lists: list[list[int]]) -> None:
        counts = np.array([len(x) for x in lists], np.int64)
        more = int(counts.sum())
        while self.used + more > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(lists) > len(self.first):
            self.first, self.n = np.concatenate([self.first, np.zeros_like(self.first)]), np.concatenate([self.n, np.zeros_like(self.n)])
        self.flat[self.used : self.used + more] = np.fromiter(chain.from_iterable(lists), np.int64, more)
        self.first[self.rows : self.rows + len(lists)] = self.used + np.cumsum(counts) - counts
        self.n[self.rows : self.rows + len(lists)] = counts
        self.used, self.rows = self.used + more, self.rows + len(lists)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of these rows end to end, and how long each is."""
        n = self.n[rows]
        at = np.arange(int(n.sum())) + np.repeat(self.first[rows] - np.cumsum(n) + n, n)
        return self.flat[at], n


class Units:
    """Rows of units, in order of appearance. ``encode`` gives ``kinds`` lists of numbers for each unit (ids, say): first those of one kind for all units,
    then of the next; ``found`` has them by row."""

    def __init__(self, encode: Callable[[list[str]], tuple[list[list[int]], ...]], kinds: int = 1, most: int = REMEMBERED) -> None:
        self.encode, self.kinds, self.most = encode, kinds, most
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = defaultdict(count().__next__)
        self.characters = 0
        self.found = [Flat() for _ in range(self.kinds)]

    def rows(self, units: list[str]) -> np.ndarray:
        """A row for each unit; valid until the next call."""
        if len(self.at) > self.most or self.characters > CHARACTERS:
            self._clear()
        known = len(self.at)
        rows = np.fromiter(map(self.at.__getitem__, units), np.int64, len(units))
        new = list(islice(reversed(self.at), len(self.at) - known))[::-1]
        for k in range(0, len(new), 4096):
            for flat, lists in zip(self.found, self.encode(new[k : k + 4096]), strict=True):
                flat.add(lists)
        self.characters += sum(map(len, new))
        return rows

    def texts(self, texts: list[str], split: Callable[[str, bool], list[str]], cut: re.Pattern) -> list[list[np.ndarray]]:
        """Of each kind the numbers of each text, whose units are what ``split`` gives for its stretches (true: the text's first)."""
        out: list[list[list[np.ndarray]]] = [[[] for _ in texts] for _ in range(self.kinds)]
        for run in _runs(texts, cut):
            lists = [split(part, first) for _, part, first in run]
            rows, ends = self.rows([u for x in lists for u in x]), np.cumsum([len(x) for x in lists])[:-1]
            for flat, own in zip(self.found, out, strict=True):
                numbers, n = flat.take(rows)
                for (k, *_), part in zip(run, np.split(numbers, np.append(0, np.cumsum(n))[ends]), strict=True):
                    own[k].append(part)
        return [[x[0] if len(x) == 1 else np.concatenate(x) for x in own] for own in out]


def stretches(text: str, cut: re.Pattern, most: int | None = None) -> Iterator[str]:
    """A text in parts of about ``most`` characters (``STRETCH``), cut before the matches of ``cut``."""
    at, most = 0, most or STRETCH
    while len(text) - at > most:
        hit = cut.search(text, at + most)
        if not hit:
            break
        yield text[at : hit.start()]
        at = hit.start()
    yield text[at:]


def _runs(texts: list[str], cut: re.Pattern) -> Iterator[list[tuple[int, str, bool]]]:
    """Stretches of texts, with the text's number and whether it is its first, in runs of about ``STRETCH`` characters."""
    run, held = [], 0
    for k, text in enumerate(texts):
        for j, part in enumerate(stretches(text, cut)):
            run.append((k, part, j == 0))
            held += len(part)
            if held >= STRETCH:
                yield run
                run, held = [], 0
    if run:
        yield run
