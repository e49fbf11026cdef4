"""Benchmark decontamination: a BM25 inverted index of the test items, queried by every training passage with block-max WAND.

Items are indexed by length class (up to 16, 64, 256 .. words). The passages of a class are overlapping windows of a document, twice the class's
length and one length apart, so that an item that a document holds lies within one of them. The score of an item for a passage is the BM25 sum over the passage's
distinct words, divided by what the item's own text would get (so 1 is the whole item, whatever its length). All items of a
score of ``SCORE`` or more are retrieved:

* a vectorised bound first adds up, for each item, the impacts of the passage's rare words, and all the item's common words;
  passages without an item at the threshold can't retrieve anything;
* the others run block-max WAND over postings in item order: the pivot is where the summed list maxima reach the threshold, its blocks'
  maxima decide whether it is scored or skipped.

A retrieved item is verified on the document around the passage: its question (all sentences but the last) and its answer (the last
one; halves of a single sentence) must both recur, at ``OVERLAP`` of their 3-word shingles or more.

Document frequencies, the number of items and their mean length are counted by Spark over all items, so an item's score depends on no other choice.
The index is broadcast in parts of about ``BLOCK_BYTES`` of item text: a larger benchmark takes one pass over the documents for each
part, written between passes, so that a task holds one part only; none of its items is left out, and the result is that of a single part.

Defined cases: null and empty texts hold nothing; items without words never match, repeated items match all alike; an empty
benchmark leaves every document clean; repeated rows are judged alike; extra columns are kept by ``clean``, whatever their names, and ignored otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import columns, free, stored
from .wordhash import PUNCTUATION, Words, gram_hashes, slices, whole, word_hashes, words

K1, B, SCORE, OVERLAP, SHINGLE = 1.2, 0.75, 0.5, 0.6, 3
BLOCK, BLOCK_BYTES = 16, 8 << 20
#: What ``search`` adds, and its type.
FOUND = "_found"
_KIND = "array<struct<item_id:bigint,score:double,question_overlap:double,answer_overlap:double>>"

_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def question_answer(text: str) -> tuple[str, str]:
    parts = [p for p in _SENTENCE.split(text.strip()) if p]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    tokens = text.split()
    return " ".join(tokens[: (len(tokens) + 1) // 2]), " ".join(tokens[(len(tokens) + 1) // 2 :])


def _tokens(texts: list[str | None]) -> tuple[Words, np.ndarray]:
    w = words(pa.array(texts, pa.string()), lower=True, separators=PUNCTUATION)
    return w, word_hashes(w)


def _shingles(texts: list[str]) -> list[np.ndarray]:
    """Distinct shingles of each text; of texts shorter than a shingle, the whole."""
    w, h = _tokens(texts)
    out = []
    for d in range(len(texts)):
        own = h[w.first[d] : w.first[d + 1]]
        out.append(np.unique(gram_hashes(own, min(SHINGLE, len(own)))) if len(own) else np.zeros(0, np.uint64))
    return out


@dataclass
class Index:
    """Postings of the items by term: ``items[start[t]:start[t + 1]]`` in order, with normalised impacts and their block maxima."""

    ids: list[int | None]
    terms: np.ndarray
    start: np.ndarray
    items: np.ndarray
    impacts: np.ndarray
    most: np.ndarray
    passage: int
    rare: np.ndarray
    common: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]
    block_max: list[np.ndarray] = field(default_factory=list)

    def search(self, query: list[int], least: float) -> list[tuple[int, float]]:
        """(item, score) of all items that reach ``least`` for the distinct terms of ``query``: block-max WAND."""
        at = [int(self.start[t]) for t in query]
        end = [int(self.start[t + 1]) for t in query]
        base = list(at)
        found: list[tuple[int, float]] = []
        floor = least - 1e-12
        live = list(range(len(query)))
        items, most, block_max, impacts = self.items, self.most, self.block_max, self.impacts
        while live:
            live.sort(key=lambda q: items[at[q]])
            bound, pivot = 0.0, -1
            for k, q in enumerate(live):
                bound += most[query[q]]
                if bound >= floor:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = items[at[live[pivot]]]
            while pivot + 1 < len(live) and items[at[live[pivot + 1]]] == item:
                pivot += 1
            lists = live[: pivot + 1]
            shallow, stops = 0.0, []
            for q in lists:  # the block that would hold the pivot, without decoding up to it
                k = (at[q] - base[q]) // BLOCK
                last = (end[q] - base[q] - 1) // BLOCK
                while k < last and items[min(base[q] + (k + 1) * BLOCK, end[q]) - 1] < item:
                    k += 1
                stop = min(base[q] + (k + 1) * BLOCK, end[q])
                if items[stop - 1] >= item:
                    shallow += block_max[query[q]][k]
                    stops.append(int(items[stop - 1]))
            if shallow >= floor:
                score = 0.0
                for q in lists:
                    while at[q] < end[q] and items[at[q]] < item:
                        at[q] += 1
                    if at[q] < end[q] and items[at[q]] == item:
                        score += float(impacts[at[q]])
                        at[q] += 1
                if score >= floor:
                    found.append((int(item), score))
            else:  # no item up to the nearest block end, or before the next list begins, can reach the threshold
                beyond = min(stops, default=int(item)) + 1
                if pivot + 1 < len(live):
                    beyond = min(beyond, int(items[at[live[pivot + 1]]]))
                beyond = max(beyond, int(item) + 1)
                for q in lists:
                    at[q] += int(np.searchsorted(items[at[q] : end[q]], beyond))
            live = [q for q in live if at[q] < end[q]]
        return found


@dataclass
class Counts:
    """What all items together give: how many have words, their mean length, and in how many each term occurs (sorted terms)."""

    items: int
    mean: float
    terms: np.ndarray
    df: np.ndarray


def length_class(n: int) -> int:
    """The passage length of items of ``n`` words: 16, 64, 256 .. words."""
    length = 16
    while length < n:
        length *= 4
    return length


def profile(items: DataFrame) -> DataFrame:
    """(item_id, text, words, length, terms): number of words, length class and distinct term hashes of each item."""
    schema = pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("words", pa.int64()), ("length", pa.int64()), ("terms", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, h = _tokens(batch.column("text").to_pylist())
            terms = [np.unique(h[a:b]).view(np.int64) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
            n = w.counts
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("text"), pa.array(n, pa.int64()), pa.array([length_class(x) for x in n], pa.int64()), pa.array(terms, pa.list_(pa.int64()))], schema=schema)

    return items.mapInArrow(run, "item_id long, text string, words long, length long, terms array<long>")


def build(ids: list[int | None], texts: list[str | None], counts: Counts, passage: int) -> Index:
    """The index of some items, with the counts of all."""
    w, h = _tokens(texts)
    terms, term = np.unique(h, return_inverse=True)
    pair, tf = np.unique(term.astype(np.int64) * len(texts) + w.doc, return_counts=True)
    t, d = pair // max(1, len(texts)), pair % max(1, len(texts))
    df = counts.df[np.searchsorted(counts.terms, terms)]
    idf = np.log(1 + (counts.items - df + 0.5) / (df + 0.5))
    impact = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * w.counts[d] / counts.mean))
    impact = impact / np.bincount(d, impact, len(texts))[d]
    start = np.searchsorted(t, np.arange(len(terms) + 1))
    most = np.maximum.reduceat(impact, start[:-1]) if len(impact) else np.zeros(0)
    blocks = [np.maximum.reduceat(impact[a:b], np.arange(0, b - a, BLOCK)) for a, b in zip(start[:-1], start[1:], strict=True)]
    parts = [question_answer(x or "") for x in texts]
    rare = df <= max(8, counts.items // 20)
    common = np.bincount(d[~rare[t]], impact[~rare[t]], len(texts))
    return Index(list(ids), terms, start, d, impact, most, passage, rare, common, _shingles([q for q, _ in parts]), _shingles([a for _, a in parts]), blocks)


def indexes(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[Index]]:
    """The indexes of each pass: of length classes, or of parts of one, of about ``block_bytes`` of text together."""
    items = stored(profile(columns(benchmark, item_id="long", text="string").filter("text is not null")), "items").filter("words > 0")
    total = items.agg(F.count("*").alias("n"), F.avg("words").alias("mean")).first()
    frequencies = stored(items.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")), "terms")
    pieces = []
    for row in items.groupBy("length").agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")).orderBy("length").collect():  # a row for each power of 4
        parts = -(-row["bytes"] // block_bytes)
        pieces += [(row["length"], k, parts, row["bytes"] / parts) for k in range(parts)]
    held, size = [], 0
    for length, k, parts, n in pieces:
        if held and size + n > block_bytes:
            yield held
            held, size = [], 0
        own = items.filter((F.col("length") == length) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k))
        rows = own.select("item_id", "text").orderBy("item_id", "text").collect()  # about block_bytes of text
        if not rows:
            continue
        known = own.select(F.explode("terms").alias("term")).distinct().join(frequencies, "term").toArrow()  # the terms of these rows
        terms, df = known.column("term").to_numpy().astype(np.int64).view(np.uint64), known.column("df").to_numpy()
        order = np.argsort(terms)
        held.append(build([r["item_id"] for r in rows], [r["text"] for r in rows], Counts(total["n"], total["mean"], terms[order], df[order]), length))
        size += n
    if held:
        yield held


def _overlap(part: np.ndarray, text: np.ndarray) -> float:
    return float(np.isin(part, text).mean()) if len(part) else 1.0


def _passages(index: Index, w: Words, h: np.ndarray, least: float) -> Iterator[tuple[int, int, int, list[int]]]:
    """(document, first word, last word + 1, distinct terms) of the passages that may hold an item.

    The bound of an item for a passage: what the passage's rare words add to it, exactly, plus all common words of the item,
    there or not. Passages without an item at the threshold can't retrieve anything."""
    if not len(h) or not len(index.terms):
        return
    bits = np.zeros(1 << 18, bool)
    bits[(index.terms >> np.uint64(46)).astype(np.int64)] = True
    at = np.flatnonzero(bits[(h >> np.uint64(46)).astype(np.int64)])
    term = np.minimum(np.searchsorted(index.terms, h[at]), len(index.terms) - 1)
    good = index.terms[term] == h[at]
    at, term = at[good], term[good]
    step, n = index.passage, len(index.ids)
    per_doc = w.counts // step + 1
    base = np.cumsum(per_doc) - per_doc
    rare = index.rare[term]
    spot, t = at[rare], term[rare]
    within = spot - w.first[w.doc[spot]]
    own = base[w.doc[spot]] + within // step  # a passage covers the steps of its number and of the next
    late = within >= step
    pairs = np.unique(np.concatenate([own * len(index.terms) + t, (own[late] - 1) * len(index.terms) + t[late]]))
    passage, t = pairs // len(index.terms), pairs % len(index.terms)
    length = index.start[t + 1] - index.start[t]
    posting = np.repeat(index.start[t] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    cells, cell = np.unique(np.repeat(passage, length) * n + index.items[posting], return_inverse=True)
    bound = np.bincount(cell, index.impacts[posting], len(cells)) + index.common[cells % n]
    hot = np.unique(cells[bound >= least - 1e-9] // n)
    if (index.common >= least - 1e-9).any():  # items of common words alone
        hot = np.arange(int(per_doc.sum()))
    doc_of = np.repeat(np.arange(len(per_doc)), per_doc)
    for p in hot:
        d = int(doc_of[p])
        a = int(w.first[d] + (p - base[d]) * step)
        b = int(min(a + 2 * step, w.first[d + 1]))
        lo, hi = np.searchsorted(at, [a, b])
        if lo < hi:
            yield d, a, b, np.unique(term[lo:hi]).tolist()


def _matches(index: Index, w: Words, h: np.ndarray, least: float, overlap: float) -> list[dict[int, tuple]]:
    """For each text its verified items: item -> (score, question overlap, answer overlap), the best passage of each."""
    out: list[dict[int, tuple]] = [{} for _ in range(len(w.first) - 1)]
    for d, a, b, terms in _passages(index, w, h, least):
        for item, score in index.search(terms, least):
            lo, hi = max(int(w.first[d]), a - index.passage), min(int(w.first[d + 1]), b + index.passage)
            near = h[lo:hi]
            grams = np.concatenate([gram_hashes(near, n) for n in {SHINGLE, *(k for k in (1, 2) if len(near) >= k)}])
            q, r = _overlap(index.question[item], grams), _overlap(index.answer[item], grams)
            if q >= overlap and r >= overlap and len(index.question[item]) + len(index.answer[item]):
                out[d][item] = max(out[d].get(item, (0.0, 0.0, 0.0)), (score, q, r))
    return out


def search(documents: DataFrame, benchmark: DataFrame, least: float = SCORE, overlap: float = OVERLAP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``documents``, all columns, with ``_found`` (see ``free``): the benchmark items that each holds, best first."""
    name = free(documents.columns, FOUND)[0]
    kept = documents.withColumn("text", F.col("text").cast("string")).withColumn(name, F.array().cast(_KIND))
    for k, some in enumerate(indexes(benchmark, block_bytes)):
        kept = _searched(stored(kept, "searched") if k else kept, name, some, least, overlap)
    return kept


def _searched(documents: DataFrame, name: str, some: list[Index], least: float, overlap: float) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast([vars(index) for index in some])  # about BLOCK_BYTES of item text
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Index(**x) for x in shared.value]
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                w = words(part.column("text"), lower=True, separators=PUNCTUATION)
                h, found = word_hashes(w), part.column(name).to_pylist()
                for index in own:
                    for row, new in zip(found, _matches(index, w, h, least, overlap), strict=True):
                        row += [{"item_id": index.ids[i], "score": s, "question_overlap": q, "answer_overlap": a} for i, (s, q, a) in new.items()]
                found = [sorted(x, key=lambda x: (-x["score"], x["item_id"] is None, x["item_id"] or 0)) for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(found, kind) if c == name else part.column(c) for c in part.schema.names], part.schema.names)

    return documents.mapInArrow(run, documents.schema)


def judged(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document: whether it holds benchmark items, which, and how surely."""
    found = search(columns(documents, doc_id="long", text="string"), benchmark)
    best = F.try_element_at(FOUND, F.lit(1))
    return found.select(
        "doc_id", (F.size(FOUND) > 0).alias("contaminated"), F.size(FOUND).cast("long").alias("n_items"), F.transform(FOUND, lambda x: x["item_id"]).alias("item_ids"),
        best["score"].alias("score"), best["question_overlap"].alias("question_overlap"), best["answer_overlap"].alias("answer_overlap"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item."""
    name = free(documents.columns, FOUND)[0]
    return search(documents, benchmark).filter(F.size(name) == 0).drop(name)
