"""Operators against brute-force versions, on small rows with nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import base64
import gzip
import hashlib
import io
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularium.llm import bpe, chat, components, decontaminate, langid, minhash, quality, sharding, spotsigs, substring, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bands string, family int, _id string"


def frame(spark, texts, ids=None):
    rows = [(i, t, "en", "s", len(t or ""), "x", 1, "y") for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, words=("alpha", "beta", "gamma", "delta", "of", "the", "a", "and", "é", "日本")):
    return " ".join(rng.choice(words) + rng.choice(["", "x", "y", ".", "z1"]) for _ in range(n))


ODD = [None, "", " ", "\n\t", "one", "a b c d e", "Ünïcödé wörds", "\x00 zero", "x" * 5000, "the " * 3000]


# sharding


def placed_one_by_one(keys, ring, room):
    """Brute force: keys walk from point to point."""
    points = ring.points()
    waiting = [[] for _ in points]
    for pos, key in sorted(keys):
        waiting[next((i for i, (p, _) in enumerate(points) if p >= pos), 0)].append(key)
    out, used, room, at = {}, Counter(), list(room), 0
    while len(out) < len(keys):
        shard = points[at][1]
        queue, waiting[at] = waiting[at], []
        for key in queue:
            if room[shard]:
                out[key] = (shard, used[shard])
                used[shard] += 1
                room[shard] -= 1
            else:
                waiting[(at + 1) % len(points)].append(key)
        at = (at + 1) % len(points)
    return out


@pytest.mark.parametrize("n", [0, 1, 37, 500])
def test_sharding_equals_the_sequential_walk(spark, n):
    ring = sharding.Ring(7, 5)
    keys = spark.createDataFrame([(i * 17 - 5, "x", None, 1) for i in range(n)], "k long, shard string, _arc int, _row int")
    rows = sharding.assign(keys, "k", ring).collect()
    assert all((r["shard"], r["_arc"], r["_row"]) == ("x", None, 1) for r in rows)
    got = {r["k"]: (r["_shard"], r["_slot"]) for r in rows}
    positions = [(r["p"], r["k"]) for r in keys.select("k", sharding.ring_position(F.col("k")).alias("p")).collect()]
    assert got == placed_one_by_one(positions, ring, sharding.capacities(n, 7))
    counts = Counter(s for s, _ in got.values())
    assert n == 0 or max(counts.values()) - min(counts.get(s, 0) for s in range(7)) <= 1


def test_sharding_takes_null_and_repeated_keys(spark):
    keys = spark.createDataFrame([(None, 1), (None, 1), (5, 1), (5, 2), (5, 2)], "k long, size long")
    rows = sharding.assign(keys, "k", sharding.Ring(2, 3), tiebreak=["size"]).collect()
    assert sorted(Counter(r["shard"] for r in rows).values()) == [2, 3]
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in Counter(r["shard"] for r in rows).items())


def test_sharding_with_slack_moves_few_keys(spark):
    keys = spark.range(3000).withColumnRenamed("id", "k")
    a, b = ({r["k"]: r["shard"] for r in sharding.assign(keys, "k", sharding.Ring(n, 64), slack=0.25).collect()} for n in (10, 11))
    assert sum(a[k] != b[k] for k in a) < 0.35 * len(a)
    assert max(Counter(a.values()).values()) <= 1.25 * 300 + 1


# language ID


def test_language_id_learns_and_rejects(spark):
    rng = random.Random(1)
    rows = []
    for i in range(240):
        lang = ("aa", "bb", "cc")[i % 3]
        rows.append((i, " ".join("".join(rng.choice({"aa": "abcd", "bb": "efgh", "cc": "йклм"}[lang]) for _ in range(5)) for _ in range(30)), lang))
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "123 !!", "aa"), (902, "abcd", None)], "doc_id long, text string, lang string")
    model = langid.train(docs.filter(~langid.held_out()), fit_rows=60)
    got = {r["doc_id"]: r for r in langid.predict(docs.withColumn("source", F.lit("s")), model).collect()}
    assert all(got[i]["_lang"] == lang for i, _, lang in rows) and not any(got[i]["_rejected"] for i, *_ in rows)
    assert got[900]["_lang"] == got[901]["_lang"] == "und" and got[900]["_score"] == 0 and got[901]["_rejected"]
    assert all(0 <= r["_score"] <= 1 for r in got.values())


@pytest.mark.parametrize("n", [1, 2, 4])
def test_language_id_rejects_unlearned_languages(n):
    rng = random.Random(n)
    letters = ("abcde", "efghi", "йклмн", "opqrs", "tuvwx", "αβγδε")
    text = lambda k: " ".join("".join(rng.choice(letters[k]) for _ in range(5)) for _ in range(30))

    def row(y, k):
        ids, counts = np.unique(np.concatenate([b for _, b in langid.subwords([text(k)])]), return_counts=True)
        return y, ids, counts.astype(float)

    wrong = [row(0, n - 1) for _ in range(2)]  # a few labels are wrong
    model = langid._fit([row(k, k) for k in range(n) for _ in range(60)] + wrong, [f"l{k}" for k in range(n)])
    rejected = lambda k: float((model.scores([text(k) for _ in range(40)])[2] < model.threshold).mean())
    assert all(rejected(k) == 0 for k in range(n)) and all(rejected(k) == 1 for k in range(n, 6))


def test_language_id_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.train(docs)).collect()
    assert [(r["_lang"], r["_score"]) for r in got] == [("und", 0.0)]
    assert langid.predict(docs.limit(0), langid.train(docs.limit(0))).count() == 0


def test_subwords_of_a_long_text_are_those_of_the_whole():
    rng = random.Random(2)
    text = prose(rng, 5000)
    one, many = (np.concatenate([b for _, b in langid.subwords([text], most)]) for most in (1 << 30, 997))
    assert sorted(one.tolist()) == sorted(many.tolist())


# WARC


def test_warc_round_trip_with_revisits(spark, tmp_path):
    pages = spark.createDataFrame([(3, "http://a/ b", "same"), (1, None, "same"), (2, "u", None), (4, "u", ""), (5, "é", "x" * 100_000), (None, "n", "same"), (7, "v", "é\r\n\r\nü")], "page_id long, url string, html string")
    manifest = warc.write_archives(pages.withColumn("refers_to", F.lit("clash")), str(tmp_path / "w"), rotate=400)
    assert manifest.count() > 1
    rows = warc.read_archives(manifest, str(tmp_path / "w"), payloads=True).collect()
    got = {r["page_id"]: r for r in rows}
    assert len(rows) == 7 and all(r["verified"] for r in rows)
    assert [(k, got[k]["record_type"], got[k]["refers_to"], got[k]["payload_bytes"]) for k in (1, 2, 3, 4, None)] == [
        (1, "response", None, 4), (2, "response", None, 0), (3, "revisit", 1, 4), (4, "revisit", 2, 0), (None, "revisit", 1, 4)]
    assert got[7]["payload"].decode() == "é\r\n\r\nü" and len(got[5]["payload"]) == 100_000
    assert got[3]["payload_digest"] == base64.b32encode(hashlib.sha1(b"same").digest()).decode()


def test_warc_small_payloads_are_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    rows = warc.read_archives(warc.write_archives(pages, str(tmp_path / "w"), min_bytes=3), str(tmp_path / "w")).collect()
    assert {r["page_id"]: r["record_type"] for r in rows} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_warc_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(pages, str(tmp_path / "w")), str(tmp_path / "w")).count() == 0


def test_warc_reader_finds_damage():
    good = warc.record(1, "u", b"payload", warc.digest(b"payload"), None)
    assert [r["verified"] for r in warc.read_records(io.BytesIO(good + good))] == [True, True]
    bad = warc.record(1, "u", b"payload", warc.digest(b"other"), None)
    assert [r["verified"] for r in warc.read_records(io.BytesIO(bad))] == [False]
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(good[:-9])))


def test_warc_reader_takes_foreign_records():
    def member(head, block):
        raw = b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
        return gzip.compress(raw)

    uid = ("WARC-Record-ID", "<urn:uuid:11111111-2222-3333-4444-555555555555>")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>"
    stream = b"".join([
        member([("WARC-Type", "warcinfo"), uid, ("Content-Type", "application/warc-fields")], b"software: x\r\n"),
        member([("WARC-Type", "request"), uid, ("Content-Type", "application/http; msgtype=request")], b"GET / HTTP/1.1\r\n\r\n"),
        member([("WARC-Type", "response"), uid, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha256:abc"), ("WARC-Block-Digest", f"sha1:{warc.digest(http)}")], http),
        member([("WARC-Type", "metadata"), ("WARC-Block-Digest", f"sha1:{warc.digest(b'other')}")], b"k: v"),
        warc.record(9, "u", b"own", warc.digest(b"own"), None),
    ])
    got = list(warc.read_records(io.BytesIO(stream)))
    assert [(r["record_type"], r["page_id"], r["payload"], r["verified"]) for r in got] == [
        ("warcinfo", None, b"software: x\r\n", None), ("request", None, b"", None), ("response", None, b"<p>", True), ("metadata", None, b"k: v", False), ("response", 9, b"own", True)]
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\n\r\n\r\n"))))


def test_warc_archives_are_named_by_attempt(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", f"p{k}") for k in range(50)], "page_id long, url string, html string")
    first = warc.write_archives(pages, str(tmp_path / "w"), rotate=300)
    names = {r["archive"] for r in first.collect()}
    for name in ("part-000000-0000-other.warc.gz", "part-000000-0000.warc.gz"):  # what an attempt that Spark didn't commit left behind
        (tmp_path / "w" / "archives" / name).write_bytes(b"broken")
    assert len(names) > 1 and warc.read_archives(first, str(tmp_path / "w")).count() == 50


# BPE


def test_bpe_equals_the_library(spark):
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    texts = [*ODD, "<|endoftext|> it's  we'll\r\n\r\n x", "  wide  \u0085next", "🙂🙃" * 50, "a" * 3000, *(prose(rng, 80) for _ in range(20)), "tie tie tie tie"]
    got = {r["doc_id"]: r for r in bpe.encoded(frame(spark, texts), ranks, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert got[i]["_ids"] == " ".join(map(str, ids)) and got[i]["_n_tokens"] == len(ids), text
        assert got[i]["_decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encoded(frame(spark, []), ranks, public_tokenizers.PATTERN).count() == 0


def test_bpe_stretches_cut_between_words():
    import public_tokenizers
    import regex

    text = prose(random.Random(4), 4000) + "   \n " + "y" * 300
    find = regex.compile(public_tokenizers.PATTERN).findall
    assert [w for part in bpe.stretches(text, 500) for w in find(part)] == find(text)


# SpotSigs


def spots(text):
    found = re.findall(r"[^\W_]+", text.lower())
    anchors, out = set(spotsigs.ANCHORS), set()
    for i, a in enumerate(found):
        rest = [w for w in found[i + 1 :] if w not in anchors][: spotsigs.CHAIN]
        if a in anchors and len(rest) == spotsigs.CHAIN:
            out.add((a, *rest))
    return out or ({tuple(found)} if found else set())


@pytest.mark.parametrize("cells", [2048, 3])
def test_spotsigs_equal_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(spotsigs, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(spotsigs, "CELLS", cells)
    rng = random.Random(5)
    texts = [*ODD, *(prose(rng, rng.randint(1, 60)) for _ in range(60))]
    ids = [3 * i - 20 for i in range(len(texts))]
    got = {r["doc_id"]: r for r in spotsigs.compared(frame(spark, texts, ids)).collect()}
    order = sorted(zip(ids, [t or "" for t in texts], strict=True), reverse=True)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = spots(text), spots(edited), spots(following)
        likeness = lambda x, y: 1.0 if not x and not y else len(x & y) / len(x | y)
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["near_edited"] == pytest.approx(likeness(a, b)) and got[i]["near_next"] == pytest.approx(likeness(a, c))
        assert len(got[i]["fingerprint"].split()) == len(a)


def test_spotsigs_single_empty_and_repeated(spark):
    assert spotsigs.compared(frame(spark, [])).count() == 0
    row = spotsigs.compared(frame(spark, ["the cat sat on a mat here"])).first()
    assert row["near_next"] == 1.0
    assert spotsigs.compared(frame(spark, ["a b c", "a b c", None], [1, 1, None])).count() == 3


def test_spotsigs_corpus_join_equals_brute_force(spark):
    rng = random.Random(21)
    texts = [*ODD, *(prose(rng, rng.randint(1, 90)) for _ in range(30))]
    for _ in range(60):
        words = texts[rng.randrange(10, 40)].split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(["the", "new", "of", f"w{rng.random()}"])
        texts.append(" ".join(words[rng.randint(0, 3) :]))
    texts += texts[-9:]
    for least in (0.8, 0.5):
        found, members = spotsigs.near_pairs(frame(spark, texts), least)
        sets = {i: frozenset(spots(t or "")) for i, t in enumerate(texts)}
        rep = {}
        for i, x in sets.items():
            rep.setdefault(x, i)
        assert {(r["doc_id"], r["rep"]) for r in members.collect()} == {(i, rep[x]) for i, x in sets.items() if x}
        some = sorted(i for x, i in rep.items() if x)
        want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in some for b in some if a < b}
        want = {k: v for k, v in want.items() if v >= least}
        got = {(r["a"], r["b"]): r["likeness"] for r in found.collect()}
        assert len(want) > 10 and got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    found, members = spotsigs.near_pairs(frame(spark, []))
    assert found.count() == members.count() == 0


def test_spotsigs_pruning(spark):
    a, b = F.array(*[F.lit(k) for k in range(10)]), F.array(*[F.lit(k) for k in range(5)])
    assert spark.range(1).select(spotsigs.likeness(a, b, 0.8), spotsigs.likeness(a, b)).first()[:] == (None, 0.5)


# windows


def removed(texts, ids, n):
    first, words = {}, [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    key = [i if i is not None else 1 << 63 for i in ids]
    for i, w in zip(key, words, strict=True):
        for k in range(len(w) - n + 1):
            first[tuple(w[k : k + n])] = min(first.get(tuple(w[k : k + n]), i), i)
    out = []
    for i, w in zip(key, words, strict=True):
        gone = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < i:
                gone |= set(range(k, k + n))
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return out


def test_substring_equals_brute_force(spark):
    rng = random.Random(6)
    shared = [prose(rng, 25) for _ in range(4)]
    texts = [*ODD, *(" ".join([prose(rng, rng.randint(0, 30)), rng.choice(shared), prose(rng, rng.randint(0, 9)), rng.choice(shared)]) for _ in range(40))]
    texts += [texts[-1], texts[-1], shared[0] + "\n\n" + shared[0]]
    ids = [*range(len(texts) - 2), len(texts) - 3, None]
    got = substring.deduplicated(frame(spark, texts, ids), window=12, anchor=4, bits=16).select("doc_id", "_n_words", "_n_removed", "_kept_sha256", "text", "source").collect()
    want = removed(texts, ids, 12)
    assert Counter((r["doc_id"], r["_n_words"], r["_n_removed"], r["_kept_sha256"]) for r in got) == Counter((i, *w) for i, w in zip(ids, want, strict=True))
    assert all(len((r["text"] or "").split()) == len(re.findall(r"[^\x20\x09-\x0D\x1c-\x1f\x85\xa0]+", r["text"] or "")) for r in got)
    assert substring.deduplicated(frame(spark, [])).count() == 0


def test_substring_is_exact_with_a_full_sketch(spark):
    rng = random.Random(7)
    texts = [prose(rng, 60) for _ in range(10)] + [prose(rng, 5)] * 3
    a, b = (sorted(map(tuple, substring.deduplicated(frame(spark, texts), 6, 3, bits).select("doc_id", "_n_removed", "_kept_sha256").collect())) for bits in (16, 22))
    assert a == b and [(n, k) for _, n, k in a] == [x[1:] for x in removed(texts, range(13), 6)]


def test_the_sketch_grows_with_its_anchors(spark, monkeypatch):
    """Of texts that share nothing, few anchors are estimated in two documents whatever their number; of a sketch that is too small, all are."""
    monkeypatch.setattr(substring, "RANGE", 256)
    monkeypatch.setattr(substring, "HEAVY", 6)
    monkeypatch.setattr(substring, "GATHERED", 1000)
    rng = random.Random(71)
    for n in (40, 400, 2000):
        texts = [" ".join(f"{rng.randrange(1 << 40):x}" for _ in range(60)) for _ in range(n)]
        docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "key long, text string").repartition(5)
        total = substring.anchor_table(docs, 12, 4).agg(F.sum("n")).first()[0]
        assert substring.estimated(docs, 12, 4).count() < 0.05 * total
        assert substring.estimated(docs, 12, 4, bits=1).count() > 0.9 * total
        # what does repeat is found, by the broadcast cells (20 documents) and in its range (3 documents) alike, and told hot by HOT
        often, twice = prose(rng, 12), prose(rng, 12)
        more = docs.unionByName(spark.createDataFrame([(n + k, often) for k in range(80)] + [(n + 90 + k, twice) for k in range(3)], "key long, text string"))
        got = {r["key"]: r["hot"] for r in substring.estimated(more, 12, 4).filter(F.col("key") >= n).collect()}
        assert got == {n + k: True for k in range(80)} | {n + 90 + k: False for k in range(3)}


# decontamination


def test_decontamination_finds_items_and_leaves_others(spark):
    rng = random.Random(8)
    items = [" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(20)) + ". " + " ".join("".join(rng.choice("klmnop") for _ in range(5)) for _ in range(6)) + "." for _ in range(40)]
    common = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)) for _ in range(30)]
    texts = [*ODD, *common, common[0][:900] + " " + items[3] + " " + common[1][:500], items[5].upper() + "!", common[2] + "\n" + items[7] + items[8], items[9].split(". ")[0]]
    bench = spark.createDataFrame([*enumerate(items), (100, None), (101, ""), (5, items[5])], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.judged(frame(spark, texts), bench).collect()}
    n = len(ODD) + len(common)
    assert [sorted(set(got[n + k]["item_ids"])) for k in range(4)] == [[3], [5], [7, 8], []]
    assert not any(got[k]["contaminated"] for k in range(n))
    assert decontaminate.clean(frame(spark, texts), bench).columns == frame(spark, texts).columns
    assert decontaminate.clean(frame(spark, texts), bench.limit(0)).count() == len(texts)
    assert decontaminate.judged(frame(spark, []), bench).count() == 0


def test_block_max_wand_equals_full_scores():
    rng = random.Random(9)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 25))) for _ in range(90)]
    w, h = decontaminate._tokens(texts)
    df = Counter(x for a, b in zip(w.first, w.first[1:]) for x in set(h[a:b].tolist()))
    terms = np.array(sorted(df), np.uint64)
    index = decontaminate.build(list(range(90)), texts, decontaminate.Counts(90, float(w.counts.mean()), terms, np.array([df[x] for x in terms.tolist()])), 64)
    for _ in range(60):
        query = sorted(rng.sample(range(len(index.terms)), rng.randint(1, 25)))
        scores = np.zeros(90)
        for t in query:
            np.add.at(scores, index.items[index.start[t] : index.start[t + 1]], index.impacts[index.start[t] : index.start[t + 1]])
        least = rng.choice([0.1, 0.3, 0.6])
        assert {i for i, _ in index.search(query, least)} == set(np.flatnonzero(scores >= least - 1e-12).tolist())


def bm25_found(texts, items, least=decontaminate.SCORE, overlap=decontaminate.OVERLAP):
    """Brute force: every passage of every text against every item, word by word."""
    cut = lambda t: re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
    grams = lambda w, n=3: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    bags = [(i, t, Counter(cut(t))) for i, t in items if cut(t)]
    df, total = Counter(w for *_, bag in bags for w in bag), len(bags)
    mean = sum(sum(bag.values()) for *_, bag in bags) / max(1, total)
    idf = {w: math.log(1 + (total - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    out = []
    for text in texts:
        words, found = cut(text), Counter()
        for i, t, bag in bags:
            size = sum(bag.values())
            impact = {w: idf[w] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / mean)) for w, n in bag.items()}
            step = decontaminate.length_class(size)
            for at in range(0, len(words), step):
                if sum(impact.get(w, 0) for w in set(words[at : at + 2 * step])) < (least - 1e-9) * sum(impact.values()):
                    continue
                near = words[max(0, at - step) : at + 3 * step]
                have = set().union(*(grams(near, n) for n in (1, 2, 3)))
                parts = [cut(x) for x in decontaminate.question_answer(t)]
                parts = [grams(x, min(3, len(x))) if x else set() for x in parts]
                if all(len(x & have) >= overlap * len(x) for x in parts) and any(parts):
                    found[i, t] = 1
        out.append(sorted(i for i, _ in found))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 23, 900])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(18)
    pool = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(150)]
    make = lambda n: " ".join(rng.choice(pool) + rng.choice(["", "", ",", "."]) for _ in range(n))
    items = [(k, make(rng.choice([4, 12, 20, 40, 90]))) for k in range(30)] + [(30, None), (31, ""), (None, make(15)), (5, make(15)), (7, "... !?")]
    items.append(items[3])
    texts = [*ODD, *(make(rng.randint(1, 400)) for _ in range(25))]
    for k in range(45):  # whole items and pieces of them
        words = items[rng.randrange(30)][1].split()
        part = words if k % 2 else words[rng.randint(0, len(words) // 2) :]
        texts.append(" ".join([make(rng.randint(0, 150)), *part, make(rng.randint(0, 150))]))
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _found string")
    rows = decontaminate.search(table, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes).collect()
    got = {r["doc_id"]: sorted((x["item_id"] for x in r["__found"]), key=lambda x: (x is None, x or 0)) for r in rows}
    want = bm25_found(texts, [(-1 if i is None else i, t) for i, t in dict.fromkeys(items)])
    assert sum(map(len, want)) > 20 and all(r["_found"] == "x" for r in rows)
    assert [set(-1 if i is None else i for i in got[k]) for k in range(len(texts))] == [set(x) for x in want]


# near-duplicates


def classes(texts, ids, percent):
    sets = {}
    for i, t in zip(ids, texts, strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("block_bytes", [1 << 24, 4000])
def test_near_duplicates_equal_brute_force(spark, block_bytes):
    rng = random.Random(10)
    texts = list(ODD)
    for _ in range(6):
        base = prose(rng, rng.randint(40, 120)).split()
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"edit{rng.random()}"
            texts.append(" ".join(copy))
    texts += ["A B c d", "a b C d", "a b c", *texts[-2:]]
    ids = rng.sample(range(1000), len(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame(spark, texts, ids), 85, block_bytes).collect()}
    assert got == classes(texts, ids, 85)


def test_near_duplicates_of_odd_tables(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    rows = minhash.near_duplicates(frame(spark, ["a b c", "a b c", "a b c", "other", None], [4, 4, None, None, None])).collect()
    assert Counter((r["doc_id"], r["component_id"], r["kept"]) for r in rows) == Counter({(4, 4, True): 2, (None, 4, False): 1, (None, None, True): 2})
    kept = minhash.kept_documents(frame(spark, ["a b c", "a b c", "a b c", "z", "z", None, "z y", "z y"], [4, 4, None, None, None, None, 7, 9]))
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter({(4, "a b c"): 2, (None, "z"): 1, (None, None): 1, (7, "z y"): 1})
    kept = minhash.kept_documents(frame(spark, ["a b c", "a b c", "z"], [1, 2, 3]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3] and kept.columns == frame(spark, []).columns


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 501), (501, 502), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(201)) and got[502] == got[500] == 500
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# quality


def symbols_of(text):
    out = []
    for ch in text:
        small = ch.lower()
        capital = ch.isupper() and len(small) == 1 and ord(ch) < 1 << 16 and ord(small) < 1 << 16
        out += ["shift", small] if capital else [ch]
    return out


class BruteKneserNey:
    """Interpolated modified Kneser-Ney by dictionaries, one n-gram at a time."""

    def __init__(self, texts, order=4, alphabet=0x110001):
        self.order, self.alphabet, self.levels = order, alphabet, []
        grams = Counter()
        for text in texts:
            run = ["begin"] * (order - 1) + symbols_of(text)
            grams.update(tuple(run[k : k + order]) for k in range(len(run) - order + 1))
        for _ in range(order):
            of = Counter(grams.values())
            n1, n2, n3, n4 = (of[k] for k in (1, 2, 3, 4))
            d = (0.5, 1.0, 1.5)
            if min(n1, n2, n3, n4):
                y = n1 / (n1 + 2 * n2)
                found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
                d = found if all(0 < x <= k for k, x in zip((1, 2, 3), found)) else d
            total, cut = Counter(), Counter()
            for g, c in grams.items():
                total[g[:-1]] += c
                cut[g[:-1]] += d[min(c, 3) - 1]
            self.levels.append((grams, d, total, cut))
            grams = Counter(g[1:] for g in grams)

    def p(self, gram, level=0):
        if level == self.order:
            return 1 / self.alphabet
        grams, d, total, cut = self.levels[level]
        lower = self.p(gram[1:], level + 1)
        if gram[:-1] not in total:
            return lower
        c = grams[gram]
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / total[gram[:-1]] + cut[gram[:-1]] / total[gram[:-1]] * lower

    def perplexity(self, text):
        run = ["begin"] * (self.order - 1) + symbols_of(text)
        logs = [math.log2(self.p(tuple(run[k : k + self.order]))) for k in range(len(run) - self.order + 1)]
        return 2 ** (-sum(logs) / len(logs))


def brute_quality(docs, labels, folds, keeps=quality.KEEPS):
    """docs: {doc_id: (text, lang)}; folds: {text: fold}. Perplexity, threshold and kept of each."""
    good = {i for i, q, t in labels if q == 1 and not t}
    poor = {i for i, q, t in labels if q == 0} - good
    trusted = {i: docs[i] for i in good if i in docs and docs[i][0]}
    whole = BruteKneserNey([t for t, _ in trusted.values()])
    without = [BruteKneserNey([t for t, _ in trusted.values() if folds[t] != k]) for k in range(quality.FOLDS)]
    score = {i: whole.perplexity(t) if t else None for i, (t, _) in docs.items()}
    ours = {i: without[folds[t]].perplexity(t) for i, (t, _) in trusted.items()}

    def limit(mine, bad):
        if not mine:
            return None
        at = [sorted(mine)[max(1, math.ceil(q * len(mine) - 1e-9)) - 1] for q in keeps]
        share = lambda xs, x: sum(v > x for v in xs) / len(xs)
        return max(at, key=lambda x: (round(share(bad, x) - share(mine, x), 9), x)) if bad else at[keeps.index(quality.KEEP)]

    bad = {i: score[i] for i in poor if score.get(i) is not None}
    by = {lang: limit([ours[i] for i in ours if docs[i][1] == lang], [x for i, x in bad.items() if docs[i][1] == lang]) for lang in {x for _, x in docs.values()}}
    overall = limit(list(ours.values()), list(bad.values()))
    out = {}
    for i, (_, lang) in docs.items():
        least = by[lang] if by[lang] is not None else overall if overall is not None else math.inf
        out[i] = (score[i], least, score[i] is not None and score[i] <= least)
    return out


@pytest.mark.parametrize("shard_rows", [1 << 21, 8000])
def test_quality_equals_brute_force(spark, shard_rows):
    rng = random.Random(16)
    words = {"en": ["the", "Small", "river", "runs", "over", "stones"], "zh": ["山", "水下", "人云", "石", "火木"], None: ["река", "Течёт", "тихо", "🙂", "🙃🚀"]}
    docs = {}
    for k in range(90):
        lang = ("en", "zh", None)[k % 3]
        docs[k] = (" ".join(rng.choice(words[lang]) for _ in range(rng.randint(3, 40))), lang)
    for k in range(90, 110):
        docs[k] = ("".join(chr(rng.choice([rng.randrange(0x4E00, 0x9000), rng.randrange(0x1F600, 0x1F640), rng.randrange(97, 123)])) for _ in range(60)), ("en", "zh", None, "xx")[k % 4])
    docs |= {200: (None, "en"), 201: ("", "zh"), 202: ("İ\x00 \U0010ffff Ǆ", "yy"), 203: docs[0], 204: ("The small" * 700, "en")}
    labels = [(k, 1, 0) for k in range(60)] + [(k, 0, k % 2) for k in range(90, 100)] + [(3, 0, 0), (5, 1, 1), (None, 1, 0), (203, 1, None)]
    table = spark.createDataFrame([(i, t, g, "clash") for i, (t, g) in docs.items()], "doc_id long, text string, lang string, perplexity string")
    folds = {r["text"]: r["f"] for r in table.select("text", F.pmod(F.xxhash64("text"), F.lit(quality.FOLDS)).alias("f")).collect()}
    want = brute_quality(docs, labels, folds)
    got = {r["doc_id"]: r for r in quality.classified(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), shard_rows=shard_rows).collect()}
    assert set(got) == set(want)
    for i, (score, limit, kept) in want.items():
        assert (got[i]["perplexity"] is None) == (score is None) and got[i]["kept"] == kept, i
        assert got[i]["threshold"] == pytest.approx(limit, rel=1e-9) and (score is None or got[i]["perplexity"] == pytest.approx(score, rel=1e-9)), i
    normal = [got[k]["perplexity"] for k in range(60)]
    assert min(got[k]["perplexity"] for k in range(90, 110)) > 10 * max(normal)  # noise in Chinese and emoji beats no trusted text


def test_kneser_ney_sums_to_one():
    model = BruteKneserNey(["abab", "abcabd", "Bad cab"], alphabet=7)
    kinds = ["a", "b", "c", "d", " ", "shift", "begin"]
    for context in (("begin",) * 3, ("a", "b", "a"), ("d", "d", "d")):
        assert sum(model.p((*context, x)) for x in kinds) == pytest.approx(1)


def test_repeated_rows_keep_their_scores_over_many_shards(spark):
    docs = spark.createDataFrame([(1, "abc", "en"), (1, "abc", "en"), (1, "abd", "en"), (None, "abc", None), (None, "abc", None)], "doc_id long, text string, lang string")
    counts = quality.gram_counts(spark.createDataFrame([("abc abd", 0), ("bcd", 1)], "text string, fold long"))
    table = quality.model_table(counts)
    one, many = (sorted((r["doc_id"] or 0, r["n_symbols"], round(r["perplexity"], 9)) for r in quality.perplexities(docs, table, quality.FOLDS, n).collect()) for n in (1 << 20, 4))
    assert one == many and len(one) == 5


def test_grams_of_long_texts_are_those_of_the_whole():
    own, rng = quality.Grams(), random.Random(17)
    texts = [None, "", "Ab", *("".join(rng.choice("aBcÄ🙂 ") for _ in range(rng.randint(1, 300))) for _ in range(20))]
    whole, parts = ([np.concatenate(x) for x in zip(*own.of(texts, n), strict=True)] for n in (1 << 20, 7))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_quality_keeps_trusted_kind_and_drops_noise(spark):
    rng = random.Random(12)
    good = [" ".join(rng.choice(["the", "small", "river", "runs", "over", "stones"]) for _ in range(60)) for _ in range(60)]
    noise = ["".join(rng.choice("qxzj#@%&") for _ in range(200)) for _ in range(10)]
    docs = frame(spark, [*good, *noise, *ODD])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(3, 1, 0), (60, 0, 0), (61, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classified(docs, labels).collect()}
    assert len(got) == 70 + len(ODD) and sum(got[i]["kept"] for i in range(60)) >= 57
    assert not any(got[i]["kept"] for i in range(60, 70)) and got[70]["perplexity"] is None and not got[70]["kept"]
    assert all(r["kept"] for r in quality.classified(docs.filter("doc_id < 5"), labels.limit(0)).collect())
    assert quality.classified(docs.limit(0), labels).count() == 0


def test_quality_separates_a_minority_in_another_script(spark):
    rng = random.Random(14)
    many = ["".join(chr(0x4E00 + rng.randrange(90)) for _ in range(3000)) + " " * 100 for _ in range(60)]
    words = ["река", "течёт", "между", "камнями", "тихо", "утром"]
    good = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(30)]
    letters = sorted(set("".join(words)))
    bad = [" ".join("".join(rng.choice(letters) for _ in rng.choice(words)) for _ in range(60)) for _ in range(10)]
    docs = spark.createDataFrame([(i, t, "zh" if i < 60 else "ru") for i, t in enumerate([*many, *good, *bad])], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classified(docs, labels).collect()}
    assert sum(got[i]["kept"] for i in range(60, 90)) >= 27 and not any(got[i]["kept"] for i in range(90, 100))


def test_quality_threshold_stands_an_odd_trusted_document(spark):
    rng = random.Random(15)
    text = lambda words: " ".join(rng.choice(words) for _ in range(60))
    good = [text(["the", "small", "river", "runs", "over", "stones"]) for _ in range(150)]
    odd = ["".join(rng.choice("qxzj#@%&") for _ in range(200)) for _ in range(1)]
    bad = [text(["eht", "llams", "revir", "snur", "revo", "senots"]) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*good, *odd, *bad])], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([*((i, 1, 0) for i in range(151)), *((i, 0, 0) for i in range(151, 161))], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classified(docs, labels).collect()}
    assert sum(got[i]["kept"] for i in range(150)) >= 145 and not any(got[i]["kept"] for i in range(151, 171))


def test_bitmap_prefilter_loses_nothing(spark):
    docs, ids = frame(spark, ["t"] * 3000), spark.range(0, 3000, 3).select(F.col("id").alias("doc_id"))
    left = {r["doc_id"] for r in quality.likely(docs, ids).collect()}
    assert set(range(0, 3000, 3)) <= left and len(left) < 1100


# chat


def test_chat_round_trip(spark):
    probe = ["<|im_end|>", "<\\|im_end|>", "<\\\\|x", "<|", "|>", "a<", "", None, "user\n", "é日本"]
    rows = []
    for conv in range(20):
        for turn, role in enumerate(["system", "user", "assistant", "user", "assistant"][conv % 2 :]):
            rows.append((conv, turn, role, probe[(conv + turn) % len(probe)], "clash"))
    rows += [(50, 0, "assistant", "x", ""), (51, 0, "tool\n<|im_end|>\\n", "y", ""), (52, 0, None, None, ""), (None, 0, "user", "n", ""), (53, 1, "user", "b", ""), (53, 1, "user", "b", ""), (53, None, "user", "first", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    got = {r["conv_id"]: r for r in chat.digest(table).collect()}
    want = {}
    for conv, turn, role, text, _ in [*rows, (-1, 0, "user", p := "<|im_end|><|im_start|>assistant ok", ""), (-1, 1, "assistant", p, "")]:
        want.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns) and got[conv]["loss_chars"] == len(loss)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert got[0]["valid"] and got[-1]["valid"] and not any(got[c]["valid"] for c in (50, 51, 52, 53, None))
    assert chat.formatted(table.limit(0)).count() == 0


def test_chat_escapes_are_reversible():
    rng = random.Random(13)
    for _ in range(3000):
        text = "".join(rng.choice("<|\\>n\n") for _ in range(rng.randint(0, 12)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


# clashing names


def test_extra_columns_of_any_name_come_back_unchanged(spark):
    import public_tokenizers

    extra = [*langid.ADDED, *bpe.ADDED, *substring.ADDED, "_found", "_kept", "kept_id", "kept_body", "id", "body", "ranges", "hashes", "anchor", "family", "digest"]
    texts = [*ODD, "the same words here again and again", "the same words here again and again"]
    rows = [(i if i < 9 else None, t, "en", *(f"{c}{i}" for c in extra)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in extra))
    bench = spark.createDataFrame([(1, "the same words here again and again")], "item_id long, text string")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = lambda df: sorted(map(repr, df.select("doc_id", *extra).collect()))
    for found in (langid.predict(docs, langid.train(docs)), bpe.encoded(docs, ranks, public_tokenizers.PATTERN), substring.deduplicated(docs), decontaminate.search(docs, bench)):
        assert plain(found) == plain(docs)
        assert plain(type(docs).limit(found, 0)) == []
    kept = minhash.kept_documents(docs)
    assert kept.columns == docs.columns and set(plain(kept)) < set(plain(docs))
    assert decontaminate.clean(docs, bench).columns == docs.columns and decontaminate.clean(docs, bench).count() == len(texts) - 2
    shards = sharding.assign(docs.drop("text"), "doc_id", sharding.Ring(3, 4), tiebreak=["lang"])
    assert plain(shards) == plain(docs)


def test_symbols_are_no_letters(spark):
    texts = ["🙂🙃", "🚀", "𝟘𝟙", "𝔸𝔹", "中文"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*texts, "plain words"])], "doc_id long, text string, lang string")
    got = {r["text"]: r["_lang"] for r in langid.predict(docs, langid.train(docs)).collect()}
    assert [got[t] for t in texts] == ["und", "und", "und", "en", "en"]


def test_a_hot_anchor_is_judged_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT", 3)
    rng = random.Random(19)
    hot = prose(rng, 40)
    texts = [" ".join([prose(rng, rng.randint(0, 20)), hot, prose(rng, rng.randint(0, 20)), hot if k % 7 == 0 else ""]) for k in range(60)] + ODD
    ids = [*rng.sample(range(500), 58), 501, 501, *range(600, 600 + len(ODD))]
    got = substring.deduplicated(frame(spark, texts, ids).repartition(9), window=12, anchor=4, bits=16).select("doc_id", "_n_words", "_n_removed", "_kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter((i, *w) for i, w in zip(ids, removed(texts, ids, 12), strict=True))


def test_components_of_hot_nodes(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT", 3)
    monkeypatch.setattr(components, "SHARE", 9)
    rng = random.Random(20)
    edges = [(0, k) for k in range(1, 40)] + [(50, k) for k in range(51, 80)] + [(39, 60), (90, 91)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(150)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {k: k for e in edges for k in e}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert got == {k: find(k) for e in edges if e[0] != e[1] for k in e}


def test_hot_keys_are_joined_in_place(spark):
    from tabularium.llm.shared import hot_join

    rows = spark.createDataFrame([(k % 7 if k % 2 else 0, k) for k in range(200)] + [(None, 1), (99, 1)], "key int, v int")
    table = rows.filter("key < 50").groupBy("key").agg(F.count("*").alias("n"))
    plain = sorted(map(tuple, rows.join(table, "key").collect()))
    assert all(sorted(map(tuple, hot_join(rows, table, "key", "n", least, most).collect())) == plain for least, most in ((1000, 4096), (10, 4096), (1, 2)))
