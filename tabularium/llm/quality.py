"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text, and perplexity thresholds by language.

The tokens are characters: every code point is a symbol of its own, capitals are a shift mark and their small form. No character is merged
with another, whatever its script or how rare it is. Every whole trusted text is counted; each task counts what occurs, and the
counts are added up by n-gram, sharded by key.

The model is built by Spark from these counts, in tables sharded by n-gram: continuation counts of the lower orders are counts of the distinct
longer n-grams, three discounts an order come from the counts of counts, contexts are summed, and each order's probability is
joined to that of the order below, down to the uniform distribution over all symbols. A row of the finished table is what an n-gram adds to the
log probability of its last symbol beyond the order below; a row without a symbol is what its context adds to symbols that never followed it.
So the log probability of a symbol is a plain sum over the orders of what the table holds, and any shard of contexts gives a part of that sum.

Documents are joined to the count table shard by shard: a shard of ``SHARD_ROWS`` rows at most, whatever the corpus, is broadcast, every task looks
up the distinct n-grams of its texts in it, and the partial sums of all shards are added up by document. No text is moved for that, and
no more than a shard passes through the driver. (A shuffle of the documents' own n-grams to the shards and back moves them twice; the README has the figures.)

A document is kept if its perplexity is at most the threshold of its language: a quantile of the trusted documents' scores, each by a
model that was fitted without its fold (``FOLDS``, dealt by text, so that exact copies share one). Of the quantiles ``KEEPS`` it is the one that drops
the most documents labelled quality 0 beyond the trusted ones that it drops too, the highest if several do; ``KEEP`` where none is labelled so.
A language without trusted documents takes the threshold over all of them.

Defined cases: null and empty texts have no perplexity and aren't kept; documents without lang form a language of their own;
without any trusted text all scores are those of the uniform distribution, and nothing but empty texts is dropped; a label that
repeats or contradicts another makes a document trusted if any of its labels does; repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import columns, stored
from .wordhash import slices

ORDER, STRETCH, FOLDS = 4, 1 << 20, 4
KEEP, KEEPS = 0.99, (0.95, 0.98, 0.985, 0.99, 0.995, 0.9975)
#: Rows of the model that are broadcast at once; more make more passes over the documents.
SHARD_ROWS = 1 << 21
#: A symbol is a code point, the shift mark or the begin mark: 21 bits, so that a context of three is one key of 63.
BITS, SHIFT, BEGIN = 21, 0x110000, 0x110001
UNIFORM = 1 / 0x110001
#: Discounts where the counts of counts give none: there are too few of them, or one would be 0 and leave no weight to the order below.
FALLBACK = (0.5, 1.0, 1.5)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _plane() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point of the basic plane is a capital with a one-character small form, and that form."""
    upper, lower = np.zeros(1 << 16, bool), np.arange(1 << 16, dtype=np.uint32)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000 and chr(c).isupper() and len(small := chr(c).lower()) == 1 and ord(small) < 1 << 16:
            upper[c], lower[c] = True, ord(small)
    return upper, lower


class Grams:
    """Cuts texts into n-grams, many texts at once."""

    def __init__(self) -> None:
        self.upper, self.lower = _plane()

    def of(self, texts: list[str | None], stretch: int = STRETCH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(index of a text, context, symbol) of all n-grams of whole texts, in parts of about ``stretch`` symbols; the context of a
        symbol is the ORDER - 1 symbols before it, and a text begins with begin marks."""
        held, size = [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text or ""), stretch):
                body = text[at : at + stretch]
                held.append((i, at, text[max(0, at - ORDER + 1) : at].rjust(ORDER - 1, "\0") + body))
                size += len(body)
                if size >= stretch:
                    yield self._cut(held)
                    held, size = [], 0
        if held:
            yield self._cut(held)

    def _cut(self, pieces: list[tuple[int, int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code = np.frombuffer("".join(p for *_, p in pieces).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        size = np.array([len(p) for *_, p in pieces])
        first = np.cumsum(size) - size
        before = (first[:, None] + np.arange(ORDER - 1)[None, :]).ravel()
        owner = np.repeat(np.array([i for i, *_ in pieces]), size)
        owner[before] = -1  # only a context here
        fresh = np.repeat(np.array([at == 0 for _, at, _ in pieces]), ORDER - 1)
        code[before[fresh]] = BEGIN
        capital = self.upper[np.minimum(code, 0xFFFF)] & (code < 1 << 16)
        symbol = np.where(capital, self.lower[np.minimum(code, 0xFFFF)], code).astype(np.int64)
        if capital.any():
            spot = np.cumsum(1 + capital) - 1
            wide = np.full(int(spot[-1]) + 1, SHIFT, np.int64)
            wide[spot] = symbol
            symbol, owner = wide, np.repeat(owner, 1 + capital)
        context = symbol[: len(symbol) - ORDER + 1]
        for k in range(1, ORDER - 1):
            context = context << BITS | symbol[k : len(symbol) - ORDER + 1 + k]
        keep = owner[ORDER - 1 :] >= 0
        return owner[ORDER - 1 :][keep], context[keep], symbol[ORDER - 1 :][keep]


def distinct(context: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each n-gram the number of its kind, and where each kind occurs first. Kinds are told apart by 64-bit hashes."""
    kind, _ = pd.factorize((context.astype(np.uint64) * _M1) ^ (symbol.astype(np.uint64) * _M2))
    first = np.empty(int(kind.max()) + 1 if len(kind) else 0, np.int64)
    first[kind[::-1]] = np.arange(len(kind) - 1, -1, -1)
    return kind, first


def gram_counts(trusted: DataFrame) -> DataFrame:
    """(context, symbol, n0, n1 ..) over all trusted texts, a count for each fold, sharded by n-gram."""
    schema = pa.schema([(c, pa.int64()) for c in ("context", "symbol", "n", "fold")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grams()
        for batch in batches:
            for part in slices(batch, "text", STRETCH):
                folds = np.asarray(part.column("fold"))
                for owner, context, symbol in own.of(part.column("text").to_pylist()):
                    for fold in range(FOLDS):
                        mine = np.flatnonzero(folds[owner] == fold)
                        kind, first = distinct(context[mine], symbol[mine])
                        at, n = mine[first], np.bincount(kind, minlength=len(first))
                        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (context[at], symbol[at], n, np.full(len(n), fold))], schema=schema)

    rows = trusted.select("text", "fold").mapInArrow(run, "context long, symbol long, n long, fold long")
    return rows.groupBy("context", "symbol").agg(*[F.sum(F.when(F.col("fold") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(FOLDS)])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """D1, D2 and D3+ from the counts of counts."""
    if not min(n1, n2, n3, n4):
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return found if all(0 < d <= k for k, d in zip((1, 2, 3), found, strict=True)) else FALLBACK


def _shorter(length: int) -> Column:
    """The last ``length`` symbols of a context."""
    return F.col("context").bitwiseAND(F.lit((1 << BITS * length) - 1))


def model_table(counts: DataFrame) -> DataFrame:
    """(model, length, context, symbol, value): log2 of what each n-gram adds to the probability by the order below; with a null symbol, log2 of
    the weight that its context leaves to that order. Model k lacks the texts of fold k, model ``FOLDS`` lacks none."""
    total = sum((F.col(f"n{k}") for k in range(FOLDS)), F.lit(0).cast("long"))
    models = [F.struct(F.lit(k).alias("model"), (total - F.col(f"n{k}") if k < FOLDS else total).alias("n")) for k in range(FOLDS + 1)]
    level = counts.select("context", "symbol", F.inline(F.array(*models))).filter("n > 0").select("model", "context", "symbol", "n")
    levels = [level.withColumn("length", F.lit(ORDER))]
    for k in range(ORDER - 1, 0, -1):  # continuation counts: in how many contexts a shorter gram follows something
        level = level.select("model", _shorter(k - 1).alias("context"), "symbol").groupBy("model", "context", "symbol").agg(F.count("*").alias("n"))
        levels.append(level.withColumn("length", F.lit(k)))
    grams = stored(reduce(DataFrame.unionByName, levels), "grams")
    spark, ones = grams.sparkSession, [F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]
    found = [(r[0], r[1], *discounts(*r[2:])) for r in grams.groupBy("model", "length").agg(*ones).collect()]  # (FOLDS + 1) * ORDER rows
    table = spark.createDataFrame(found, "model int, length int, d1 double, d2 double, d3 double")
    cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    cutted = grams.join(F.broadcast(table), ["model", "length"]).select("model", "length", "context", "symbol", "n", cut.alias("cut"))
    contexts = cutted.groupBy("model", "length", "context").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight"))
    contexts = stored(contexts, "contexts")
    joined = cutted.join(contexts, ["model", "length", "context"])
    joined = stored(joined.select("model", "length", "context", "symbol", (F.greatest(F.col("n") - F.col("cut"), F.lit(0.0)) / F.col("total")).alias("own"), "weight"), "weights")
    done, below = [], None
    for k in range(1, ORDER + 1):
        here = joined.filter(F.col("length") == k)
        if below is None:
            here = here.withColumn("lower", F.lit(UNIFORM))
        else:
            keyed = here.withColumn("suffix", _shorter(k - 2))
            here = keyed.join(below, (keyed["model"] == below["m"]) & (keyed["suffix"] == below["c"]) & (keyed["symbol"] == below["s"])).drop("m", "c", "s", "suffix")
        here = here.withColumn("p", F.col("own") + F.col("weight") * F.col("lower"))
        below = here.select(F.col("model").alias("m"), F.col("context").alias("c"), F.col("symbol").alias("s"), F.col("p").alias("lower"))
        done.append(here.select("model", "length", "context", "symbol", F.log2(F.col("p") / F.col("lower")).alias("value")))
    defaults = contexts.select("model", "length", "context", F.lit(None).cast("long").alias("symbol"), F.log2("weight").alias("value"))
    return reduce(DataFrame.unionByName, [*done, defaults])


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is, and whether it is there at all."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class Shard:
    """Some contexts of a model with all that follows them: for each length sorted contexts with their weights, and sorted n-grams, by rank of the
    context, with what they add."""

    def __init__(self, rows: pa.Table) -> None:
        length, context, value = (rows.column(c).to_numpy() for c in ("length", "context", "value"))
        symbol = rows.column("symbol").fill_null(-1).to_numpy()
        self.levels = []
        for k in range(1, ORDER + 1):
            bare, full = np.flatnonzero((length == k) & (symbol < 0)), np.flatnonzero((length == k) & (symbol >= 0))
            bare = bare[np.argsort(context[bare])]
            key = _find(context[bare], context[full])[0] << BITS | symbol[full]
            order = np.argsort(key)
            self.levels.append((context[bare], value[bare], key[order], value[full[order]]))

    def logs(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """What this shard adds to log2 P(symbol | context)."""
        out = np.zeros(len(symbol))
        for k, (contexts, weights, keys, values) in enumerate(self.levels):
            rank, here = _find(contexts, context & (1 << BITS * k) - 1)
            at, known = _find(keys, np.where(here, rank << BITS | symbol, -1))
            if known.any():
                out[known] += values[at[known]]
            rest = here & ~known
            if rest.any():
                out[rest] += weights[rank[rest]]
        return out


_SCORED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("body", pa.int64()), ("n_symbols", pa.int64()), ("logs", pa.float64())])


def _partial(documents: DataFrame, shard: Shard) -> DataFrame:
    """(doc_id, lang, body, n_symbols, logs): what a shard adds to the log probability of each whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(shard)  # SHARD_ROWS rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, mine = Grams(), shared.value
        for batch in batches:
            for part in slices(batch, "text", STRETCH):
                n, logs = np.zeros(len(part), np.int64), np.zeros(len(part))
                for owner, context, symbol in own.of(part.column("text").to_pylist()):
                    kind, first = distinct(context, symbol)
                    value = mine.logs(context[first], symbol[first])[kind]
                    n += np.bincount(owner, minlength=len(part))
                    logs += np.bincount(owner, value, len(part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), part.column("body"), pa.array(n), pa.array(logs)], schema=_SCORED)

    rows = documents.select("doc_id", "lang", "text", F.xxhash64("text").alias("body"))
    return rows.mapInArrow(run, "doc_id long, lang string, body long, n_symbols long, logs double")


def perplexities(documents: DataFrame, table: DataFrame, model: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, lang, n_symbols, perplexity) of each document, from its whole text, by one model of a stored ``model_table``."""
    rows = table.filter(F.col("model") == model).select("length", "context", "symbol", "value")
    shards = max(1, -(-rows.count() * 5 // (shard_rows * 4)))  # a shard may hold a quarter more than its share
    of = F.pmod(F.xxhash64("length", "context"), F.lit(shards))
    if shards == 1:
        found = _partial(documents, Shard(rows.toArrow()))
    else:
        parts = [stored(_partial(documents, Shard(rows.filter(of == k).toArrow())), "partial") for k in range(shards)]
        sums = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "lang", "body", "n_symbols").agg((F.sum("logs") * shards / F.count("*")).alias("logs"), (F.count("*") / shards).cast("int").alias("copies"))
        found = sums.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    mean = F.lit(float(np.log2(UNIFORM))) + F.col("logs") / F.col("n_symbols")
    return found.select("doc_id", "lang", "n_symbols", F.when(F.col("n_symbols") > 0, F.pow(F.lit(2.0), -mean)).alias("perplexity"))


def likely(documents: DataFrame, ids: DataFrame, bits: int = 24) -> DataFrame:
    """The documents that may be among ``ids``: all that are, and few others. A bitmap of hashed ids, ``2 ** bits`` bits in 512 rows
    whatever the table, is broadcast, so that a join by id moves the texts of these documents only."""
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits))
    maps = ids.select(hashed.alias("h")).groupBy(F.expr("cast(h div 32768 as int)").alias("_part")).agg(F.bitmap_construct_agg(F.col("h") % 32768).alias("_map"))
    rows = documents.withColumn("_h", hashed).withColumn("_part", F.expr("cast(_h div 32768 as int)")).join(F.broadcast(maps), "_part")
    byte = F.conv(F.hex(F.expr("substring(_map, cast((_h % 32768) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("cast(_h % 8 as int)")
    return rows.filter(F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1).select(documents.columns)


def threshold(trusted: list[float], bad: list[tuple[float, float]], keep: float | None = None) -> float | None:
    """From the scores of trusted documents at ``KEEPS`` and, for each of them, the share of documents labelled quality 0 that it drops and the
    share of trusted ones."""
    if not trusted:
        return None
    if keep is None and bad:
        return max(zip(bad, trusted, strict=True), key=lambda x: (round(x[0][0] - x[0][1], 9), x[1]))[1]
    return trusted[0] if keep is not None else trusted[KEEPS.index(KEEP)]


def classified(documents: DataFrame, labels: DataFrame, keep: float | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each document: perplexity, the threshold of its language, and whether it is kept. A quantile ``keep`` holds for all languages."""
    docs = columns(documents, doc_id="long", text="string", lang="string")
    marks = columns(labels, doc_id="long", quality="int", toxic="int").filter("doc_id is not null")
    good = marks.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct()
    poor = marks.filter("quality = 0").select("doc_id").distinct().join(good, "doc_id", "left_anti")
    texts = likely(docs.filter("text is not null"), good).join(good.hint("merge"), "doc_id")  # a semi join would be moved below the bitmap
    trusted = stored(texts.select("doc_id", "text", "lang", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).alias("fold")), "trusted")
    table = stored(model_table(stored(gram_counts(trusted), "gram-counts")), "model")
    scored = stored(perplexities(docs, table, FOLDS, shard_rows), "perplexities")
    ours = [perplexities(trusted.filter(F.col("fold") == k), table, k, shard_rows) for k in range(FOLDS)]
    ours = stored(reduce(DataFrame.unionByName, ours), "held-out").filter("perplexity is not null")
    theirs = scored.join(poor, "doc_id", "left_semi").filter("perplexity is not null")
    quantiles = KEEPS if keep is None else (keep,)

    def limits(by: list[str]) -> dict[str | None, float | None]:
        at = {r["lang"] if by else None: r["q"] for r in ours.groupBy(*by).agg(F.percentile_approx("perplexity", list(quantiles), 100_000).alias("q")).collect()}  # one row a language
        table = ours.sparkSession.createDataFrame([(k, q) for k, q in at.items() if q], "known string, q array<double>")
        over = [F.avg((F.col("perplexity") > F.get("q", F.lit(i))).cast("double")).alias(f"a{i}") for i in range(len(quantiles))]

        def dropped(rows: DataFrame) -> dict[str | None, list[float]]:
            match = F.col("lang").eqNullSafe(F.col("known")) if by else F.lit(True)
            return {r["known"]: list(r)[1:] for r in rows.join(F.broadcast(table), match).groupBy("known").agg(*over).collect()}

        mine, others = dropped(ours), dropped(theirs)
        return {k: threshold(q or [], list(zip(others[k], mine[k], strict=True)) if k in others else [], keep) for k, q in at.items()}

    by_lang, overall = limits(["lang"]), limits([])[None]
    table = scored.sparkSession.createDataFrame([*by_lang.items(), ("", None)], "known string, threshold double").filter("threshold is not null")
    out = scored.join(F.broadcast(table), F.col("lang").eqNullSafe(F.col("known")), "left")
    limit = F.coalesce(F.col("threshold"), F.lit(overall).cast("double"), F.lit(float("inf")))
    return out.select("doc_id", "lang", "n_symbols", "perplexity", limit.alias("threshold"), F.coalesce(F.col("perplexity") <= limit, F.lit(False)).alias("kept"))
