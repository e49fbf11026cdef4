"""SpotSigs fingerprints in DataFrame functions only: chains of content words that follow common-word anchors.

A text is lower-cased and reduced to words (runs of letters and digits). Each occurrence of an anchor, a common word, makes
one signature: the anchor and the next ``CHAIN`` content words, anchors between them left out. The fingerprint is the
set of signatures (40-bit hashes, sorted). Sets are compared by Jaccard; sets whose lengths differ so much that
the threshold is out of reach are never intersected, and length classes (``length_class``) tell which sets can be
near at all: those of one class or of the next. ``near_pairs`` compares a whole corpus so, ``compared`` each document with two texts.

Defined cases: a text with words but no complete chain has one signature, of its whole word sequence; a null text and one
without words have the empty set, which is like another empty set (1) and unlike all others (0); equal texts have equal
fingerprints; documents follow one another by descending doc_id (null last), repeated ids by a hash of the text; a single
document follows itself; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import columns, hot_join, stored

#: Common function words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or that the they this to was were which with you "
    "au aux avec ce ces dans de des du elle en est et il la le les leur mais ne nous ou par pas pour que qui sa se son sur un une "
    "auf aus bei das dem den der die ein eine er es für ich im ist mit nicht sich sie sind und von zu zum "
    "al como con del el ella las lo los más no para pero por sin su sus una y"
).split()
CHAIN, LEAST = 2, 0.8
#: Text bytes of one bucket of neighbouring documents, and most quantiles of ids (literals of the plan; larger tables cut each cell further).
BUCKET_BYTES, CELLS = 8 << 20, 2048
#: Most ranges of a cell: 2 ** 20 buckets in all, whose heads (16 bytes each) are broadcast. Beyond 8 TB of text buckets grow with it: 100 MB at 100 TB.
PARTS = 512

_MARK = "\u0001"


def normalised(text: Column) -> Column:
    """Lower-case words, each with one space before and behind."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted set of signatures of a text. Linear in its length: a run of anchors is matched once, by possessive loops, with the
    content words that follow it, and then gives one signature for each anchor in it."""
    words = normalised(text)
    marked = F.regexp_replace(words, f"(?<= )(?:{'|'.join(sorted(set(ANCHORS)))})(?= )", f"{_MARK}$0")
    anchor, content = f"{_MARK}[^ ]+ ", f"[^{_MARK} ]+ "
    spots = F.regexp_extract_all(marked, F.lit(f"(?=((?:{anchor})++{f'(?:{anchor})*+'.join([content] * chain)}))(?:{anchor})++"), F.lit(1))

    def of_run(s: Column) -> Column:
        run = F.split(F.regexp_extract(s, f"^{_MARK}((?:[^ ]+ {_MARK})*+[^ ]+) (?!{_MARK})", 1), f" {_MARK}")
        words_after = F.regexp_replace(s, anchor, "")
        return F.transform(F.array_distinct(run), lambda a: F.shiftrightunsigned(F.xxhash64(a, words_after), 24))

    hashed = F.flatten(F.transform(spots, of_run))
    whole = F.when(F.length(F.trim(words)) > 0, F.array(F.shiftrightunsigned(F.xxhash64(words), 24))).otherwise(F.array().cast("array<bigint>"))
    return F.get(F.transform(F.array(hashed), lambda h: F.when(F.size(h) > 0, F.sort_array(F.array_distinct(h))).otherwise(whole)), F.lit(0))


def fingerprint(sigs: Column) -> Column:
    """A set of signatures as one string: hexadecimal, in order, separated by spaces."""
    return F.array_join(F.transform(sigs, lambda x: F.hex(x)), " ")


def length_class(sigs: Column, least: float = LEAST) -> Column:
    """Sets with a Jaccard of ``least`` or more are in one class or in neighbouring ones."""
    return F.when(F.size(sigs) > 0, F.floor(F.log(F.size(sigs).cast("double")) / F.lit(-math.log(least)) + 1e-9)).otherwise(F.lit(-1)).cast("int")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two sets, or null if their lengths alone keep it below ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = F.get(F.transform(F.array(both), lambda n: n / (small + large - n)), F.lit(0))
    return F.when(large == 0, F.lit(1.0)).when(small == 0, F.lit(0.0)).when(small >= large * F.lit(least), exact)


def _search(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted literal bounds are below ``value``, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    middle = lambda a: F.shiftright(a["lo"] + a["hi"], 1)
    step = lambda a, _: (
        F.when(a["lo"] >= a["hi"], a)
        .when(F.get(table, middle(a)) < value, F.struct((middle(a) + 1).alias("lo"), a["hi"].alias("hi")))
        .otherwise(F.struct(a["lo"].alias("lo"), middle(a).alias("hi")))
    )
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1)), start, step)["lo"]


def _bucket(docs: DataFrame) -> Column:
    """The bucket of a doc_id, in order of ids: cells between approximate quantiles, ``CELLS`` at most, each cut in as many equal ranges of ids
    as keep a bucket near ``BUCKET_BYTES``, however large the table."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    cells = min(CELLS, max(1, -(-size // BUCKET_BYTES)))
    if cells == 1:
        return F.lit(0).cast("long")
    parts = min(PARTS, -(-size // (cells * BUCKET_BYTES)))
    shares = [k / cells for k in range(cells + 1)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 100 * cells).alias("p")).first()["p"]
    if found is None:
        return F.lit(0).cast("long")
    bounds = sorted(set(found))
    cell = _search(F.col("doc_id"), bounds)  # ids of cell k are above bound k - 1 and up to bound k
    if parts == 1:
        return F.coalesce(cell.cast("long"), F.lit(0).cast("long"))
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    low, high = F.get(table, F.greatest(cell - 1, F.lit(0))), F.get(table, F.least(cell, F.lit(len(bounds) - 1)))
    part = F.floor((F.col("doc_id") - low).cast("double") / (high - low + 1).cast("double") * parts)
    return F.coalesce(cell * F.lit(parts).cast("long") + F.least(F.greatest(part, F.lit(0)), F.lit(parts - 1)), F.lit(0).cast("long"))


def with_next(documents: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): each document and the next by descending doc_id; after the last comes the first.

    Buckets of neighbouring ids are sorted each by itself; the first document of the next bucket is added to the end of each, so one
    shuffle of the texts serves all and no task sorts more than a bucket. The next bucket is found among one row a bucket."""
    docs = columns(documents, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    placed = docs.withColumn("bucket", _bucket(docs))
    heads = placed.groupBy("bucket").agg(F.max("doc_id").alias("head"))
    order = Window.orderBy(F.desc("bucket"))  # a row a bucket
    around = F.coalesce(F.lead(F.struct("head")).over(order), F.first(F.struct("head")).over(order))["head"]
    tails = heads.select(F.col("bucket").alias("tail_of"), around.alias("head"))
    tails = docs.join(F.broadcast(tails), F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", F.col("tail_of").alias("bucket"), F.lit(1).alias("tail"))
    rows = placed.select("doc_id", "text", "bucket", F.lit(0).alias("tail")).unionByName(tails)
    order = Window.partitionBy("bucket").orderBy("tail", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    return rows.select("*", F.lead("text").over(order).alias("next_text")).filter("tail = 0").select("doc_id", "text", "next_text")


def compared(documents: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and likenesses to the edited and the next text."""
    pairs = with_next(documents)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    found = pairs.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), signatures(F.col("text")).alias("sigs"), signatures(F.col("next_text")).alias("next_sigs"))
    found = found.select("doc_id", "n_chars", "sigs", "next_sigs", F.sha2("edited", 256).alias("edited_sha256"), signatures(F.col("edited")).alias("edited_sigs"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"), length_class(F.col("sigs")).alias("length_class"),
    )


def near_pairs(documents: DataFrame, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """All pairs of different fingerprints in the corpus with a likeness of ``least`` or more, exactly: (a, b, likeness), and the membership
    (doc_id, rep) of all documents, whose equal fingerprints share a representative.

    1. Equal fingerprints are one set, represented by its smallest doc_id (a partial aggregate: copies cost nothing further).
    2. Sets are partitioned by length class: two sets as like as that are of one class or of neighbouring ones.
    3. Within a partition only sets that share one of their rarest signatures meet: of a set of n, the n - ceil(least * n) + 1 rarest over the
       corpus. A pair meets in the partition of its smaller class, in each signature that both prefixes hold.
    4. A pair whose lengths alone keep it below ``least`` goes no further; the others are compared by their whole sets.

    Rows grow with the pairs that share a rare signature: a family of m different texts that are all alike makes m * (m - 1) / 2 true pairs."""
    docs = columns(documents, doc_id="long", text="string").filter("doc_id is not null")
    signed = docs.select("doc_id", signatures(F.col("text")).alias("sigs")).filter(F.size("sigs") > 0)
    keyed = stored(signed.select("doc_id", "sigs", F.sha2(fingerprint(F.col("sigs")), 256).alias("digest")), "spots")
    sets = keyed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("sigs").alias("sigs"))
    members = keyed.select("doc_id", "digest").join(sets.select("digest", "rep"), "digest").select("doc_id", "rep")
    sets = stored(sets.select("digest", "rep", "sigs", F.size("sigs").alias("n"), length_class(F.col("sigs"), least).alias("class")), "sets")
    each = sets.select("rep", "n", "class", F.explode("sigs").alias("sig"))
    counts = each.groupBy("sig").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = hot_join(each, counts, "sig", "df")
    alone = F.col("n") - F.col("shared")  # signatures that no other set holds are the rarest, and meet nothing
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1
    held = ranked.groupBy("rep", "n", "class").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("own"), F.count("*").alias("shared"))
    rare = held.select("rep", "n", "class", F.explode(F.slice("own", F.lit(1), F.greatest(prefix - alone, F.lit(0)).cast("int"))["sig"]).alias("sig"))
    here = rare.select("sig", F.col("class").alias("meet"), F.col("rep").alias("a"), F.col("n").alias("n_a"), F.lit(True).alias("own"))
    there = rare.select("sig", F.explode(F.array(F.col("class"), F.col("class") - 1)).alias("meet"), F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("class").alias("class_b"))
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    ordered = (F.col("class_b") > F.col("meet")) | (F.col("a") < F.col("b"))
    met = here.join(there, ["sig", "meet"]).filter(ordered & (small >= large * F.lit(least) - 1e-9)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    whole = met.join(sets.select(F.col("rep").alias("a"), F.col("sigs").alias("sigs_a")), "a").join(sets.select(F.col("rep").alias("b"), F.col("sigs").alias("sigs_b")), "b")
    found = whole.select("a", "b", likeness(F.col("sigs_a"), F.col("sigs_b"), least).alias("likeness"))
    return found.filter(F.col("likeness") >= F.lit(least) - 1e-12), members
