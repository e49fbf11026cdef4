"""Language ID: averaged hashed subword embeddings with a linear softmax, fitted by stochastic gradient descent in numpy.

Subwords are the character n-grams (1 to 4 code points) of lower-cased words, with a mark at each word end, hashed into
``BUCKETS`` rows of an embedding; a text is the mean of its rows, a linear layer and a softmax give its languages. For
prediction embedding and layer are multiplied once, so a text costs one look-up of ``languages`` numbers a subword.

The fit uses a bounded sample: at most about ``FIT_ROWS`` labelled rows a language, picked by a hash of doc_id and text, each as
counts of its buckets (so at most ``BUCKETS`` numbers a row, however long the text). A fifth of the sample is kept from the
fit and calibrates it: a temperature, 1 or more, that minimises its log loss, and the rejection threshold. What is rejected is not a matter
of the score, which only compares the learned languages: a text's familiarity is the mean log likelihood of its subwords in its likeliest
language over that of evenly spread ones, and the threshold is ``SHARE`` of the ``REJECT`` quantile of the check rows' familiarity. It means the same
for one language or many, and no label of a check row enters it. A text below the threshold, or without letters, is rejected.

Prediction reads whole texts and nothing else. Defined cases: null texts and texts without a letter are ``und`` with
score 0; rows without lang are not learned from; with no labelled row at all every text is ``und``; more than ``LANGUAGES`` values of lang
are refused; repeated rows and extra columns, whatever their names, change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import columns, free

BUCKETS, DIM, ORDERS = 1 << 15, 16, (1, 2, 3, 4)
#: Most values of lang; a column with more is no label.
LANGUAGES = 4096
#: What ``predict`` adds.
ADDED = ("_lang", "_score", "_rejected")
FIT_ROWS, EPOCHS, RATE, BATCH, REJECT, SHARE, SPREAD = 300, 12, 8.0, 16, 0.05, 0.6, 0.1
#: Least number of steps, so that a small sample is passed over more often.
STEPS = 900
#: Neutral subwords that every text is taken to have besides its own: a text of a few letters gets no certain score.
PRIOR = 12
UNKNOWN = "und"


def subwords(texts: list[str | None], most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """(index of a text, bucket of each subword in a stretch of it): whole texts, in stretches of bounded size. A stretch
    ends at a space, where there is one, so that no word is cut."""
    for i, text in enumerate(texts):
        text = (text or "").lower()
        at = 0
        while at < len(text):
            to = min(at + most, len(text))
            if to < len(text) and (cut := text.rfind(" ", at, to)) > at:
                to = cut + 1
            yield i, _buckets(text[at:to])
            at = to


def _letters() -> np.ndarray:
    """Whether a code point, of any plane, is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


_TABLE: list[np.ndarray] = []


def is_letter(code: np.ndarray) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_letters())
    return _TABLE[0][code]


def _buckets(text: str) -> np.ndarray:
    code = np.frombuffer((" " + text + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = is_letter(code)
    code = np.where(letter, code, 0)
    keep = np.ones(len(code), bool)
    keep[1:] = letter[1:] | letter[:-1]  # one mark between words
    code, letter = code[keep], letter[keep]
    out, h = [], np.zeros(len(code), np.uint32)
    good = np.ones(len(code), bool)
    for n in range(1, max(ORDERS) + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint32(0x01000193) + (code[n - 1 :] + np.uint32(1)) * np.uint32(0x9E3779B1)
        good = good[:m] & letter[n - 2 : m + n - 2] if n > 2 else good[:m]  # marks only at the ends
        x = (h ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
        x = (x ^ (x >> np.uint32(15))) % np.uint32(BUCKETS)
        out.append(x[(letter[:m] if n == 1 else good)])
    return np.concatenate(out).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (BUCKETS, langs): embedding times layer
    bias: np.ndarray
    temperature: float
    threshold: float
    familiar: np.ndarray  # (BUCKETS, langs): log likelihood of a subword over that of evenly spread ones

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of all languages, which texts have letters, and the familiarity of each in its likeliest language."""
        k, both, n = max(1, len(self.langs)), np.hstack([self.table, self.familiar]).astype(np.float64), np.zeros(len(texts))
        sums = np.zeros((len(texts), 2 * k))
        for i, b in subwords(texts):
            if len(b) and self.langs:
                sums[i] += np.bincount(b, minlength=BUCKETS) @ both if len(b) > BUCKETS else np.ones(len(b)) @ both[b]
            n[i] += len(b)
        total, near = sums[:, :k], sums[:, k:]
        z = (total / (n + PRIOR)[:, None] + (self.bias if self.langs else 0)) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), n > 0, near[np.arange(len(texts)), p.argmax(axis=1)] / np.maximum(n, 1)


def _fit(rows: list[tuple[int, np.ndarray, np.ndarray]], langs: list[str], seed: int = 7) -> Model:
    """rows: (language, buckets, counts)."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = max(1, len(rows) // 5) if len(rows) >= 5 else 0
    check, train = order[:held], order[held:]
    k = len(langs)
    emb, layer, bias = rng.normal(0, 0.1, (BUCKETS, DIM)), np.zeros((DIM, k)), np.zeros(k)

    def gather(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids = np.concatenate([rows[i][1] for i in part])
        wts = np.concatenate([rows[i][2] / (rows[i][2].sum() + PRIOR) for i in part])
        sizes = np.array([len(rows[i][1]) for i in part])
        return ids, wts, np.repeat(np.arange(len(part)), sizes), np.array([rows[i][0] for i in part])

    def hidden(ids: np.ndarray, wts: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(owner, wts * emb[ids, d], n) for d in range(DIM)], axis=1)

    def softmax(z: np.ndarray) -> np.ndarray:
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    epochs = max(EPOCHS, -(-STEPS * BATCH // max(1, len(train))))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        shuffled = rng.permutation(train)
        for at in range(0, len(shuffled), BATCH):
            part = shuffled[at : at + BATCH]
            ids, wts, owner, y = gather(part)
            h = hidden(ids, wts, owner, len(part))
            error = softmax(h @ layer + bias)
            error[np.arange(len(part)), y] -= 1
            error /= len(part)
            back = error @ layer.T
            layer -= rate * (h.T @ error)
            bias -= rate * 0.1 * error.sum(axis=0)
            step = back[owner] * wts[:, None]
            np.add.at(emb, ids, -rate * step)
    table = (emb @ layer).astype(np.float32)
    seen = np.zeros((BUCKETS, k))
    for i in train:
        y, ids, wts = rows[i]
        seen[ids, y] += wts / wts.sum()
    seen /= np.maximum(seen.sum(axis=0), 1e-12)
    familiar = np.log((1 - SPREAD) * seen * BUCKETS + SPREAD).astype(np.float32)
    if not held:
        return Model(langs, table, bias, 1.0, -np.inf, familiar)
    ids, wts, owner, y = gather(check)
    z = np.stack([np.bincount(owner, wts * table[ids, c], held) for c in range(k)], axis=1) + bias
    losses = [(-np.log(np.maximum(softmax(z / t)[np.arange(held), y], 1e-12)).mean(), t) for t in np.geomspace(1, 8, 40)]
    temperature = min(losses)[1]
    near = [float(rows[i][2] @ familiar[rows[i][1], best] / rows[i][2].sum()) for i, best in zip(check, z.argmax(axis=1), strict=True)]
    return Model(langs, table, bias, float(temperature), float(SHARE * np.quantile(near, REJECT)), familiar)


def train(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """labelled: text, lang and doc_id (which only spreads the sample)."""
    rows = columns(labelled, doc_id="long", text="string", lang="string").filter("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} values of lang")
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((BUCKETS, 1), np.float32), np.zeros(1), 1.0, 0.0, np.zeros((BUCKETS, 1), np.float32))
    shares = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(int(min(1.0, fit_rows / counts[lang]) * (1 << 30))))])
    spread = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(1 << 30))
    sample = rows.filter(spread < F.element_at(shares, F.col("lang"))).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                total = np.zeros(BUCKETS, np.int64)
                for _, b in subwords([text]):
                    total += np.bincount(b, minlength=BUCKETS)
                some = np.flatnonzero(total)
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([some.astype(np.int32).tobytes()]), pa.array([total[some].astype(np.int32).tobytes()])], ["lang", "buckets", "counts"])

    got = sample.mapInArrow(run, "lang string, buckets binary, counts binary").collect()  # at most about fit_rows rows a language, of bounded size
    fitted = sorted((langs.index(r["lang"]), bytes(r["buckets"]), bytes(r["counts"])) for r in got)
    return _fit([(y, np.frombuffer(b, np.int32), np.frombuffer(c, np.int32).astype(float)) for y, b, c in fitted], langs)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with _lang (the likeliest, or ``und``), _score and _rejected (see ``free`` for clashing names); nothing but ``text`` is looked at."""
    names, added = documents.columns, free(documents.columns, *ADDED)
    shared = documents.sparkSession.sparkContext.broadcast((model.langs, model.table, model.bias, model.temperature, model.threshold, model.familiar))  # twice BUCKETS x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            p, some, near = own.scores(batch.column("text").to_pylist())
            some &= bool(own.langs)
            best, score = p.argmax(axis=1), np.where(some, p.max(axis=1), 0.0)
            langs = [own.langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
            rejected = ~some | (near < own.threshold)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)], [*names, *added])

    schema = documents.schema
    return documents.mapInArrow(run, type(schema)(list(schema.fields)).add(added[0], "string").add(added[1], "double").add(added[2], "boolean"))


def held_out(doc_id: str = "doc_id"):
    """Documents that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
