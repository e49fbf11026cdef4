"""Packing, cross-tokenizer alignment and centroid clustering against brute force, with odd texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tabularium.llm import alignment, centroids, packing, vocabularies
from tests.llm.test_operators import ODD, frame, prose

WORD, BYTE, PIECE = (vocabularies.read(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
STRANGE = [
    "two  blanks and   three", " lead", "trail ", "tab\tand\r\nline\n\nends\n \n x", "é café ́alone", "ᲀ \x1c\x1d \x85 \xa0 　x", "a▁b", "<|endoftext|> in <|startoftext|>text", "<s> </s> <unk> <0x41>",
    "ΣΑΣ İstanbul ﬁne", "🙂🙃 \U0001f468‍\U0001f469‍\U0001f467 " * 30, "aaaaaaaaaaaaaaaa" * 300, "ab" * 700, "日本語のテキスト" * 50, "don't we'll I'VE 'S'", "﻿mark", "x y", "1234567890 12.5e-7", "   ", "क्ष กำ",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_buffer(WORD)


def check_pieces(rows, want, capacity=4096):
    """Every document's ids in order, each once; sequences without gaps, full or powers of two."""
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(by) == set(want)
    for doc, ids in want.items():
        at = 0
        for r in sorted(by[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            raw = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(raw) == r["ids_crc32"] and ("ids" not in r or bytes(r["ids"]) == raw)
            at += r["length"]
        assert at == len(ids)
    sizes = []
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == capacity or at < capacity and at & (at - 1) == 0
        sizes.append(at)
    return sizes


@pytest.mark.parametrize("pool", [1 << 21, 5000])
def test_packing_holds_every_id_once_and_pads_nothing(spark, library, pool):
    rng = random.Random(3)
    texts = [*ODD, *STRANGE, *(prose(rng, rng.choice([1, 3, 40, 700, 6000])) for _ in range(60))]
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    rows = [r.asDict() for r in packing.packed(frame(spark, texts).repartition(3).withColumn("sequence_id", F.lit("clash")), WORD, ids=True, pool=pool).collect()]
    sizes = check_pieces(rows, want)
    assert sum(n < 4096 for n in sizes) <= 12 * max(1, sum(map(len, want.values())) // pool + 1)
    assert all(len(ids) == 1 for i, ids in want.items() if not texts[i])


def test_packing_of_texts_beyond_a_stretch_and_of_nothing(spark, library, monkeypatch):
    monkeypatch.setattr(vocabularies, "STRETCH", 50)
    rng = random.Random(4)
    for text in [*STRANGE, prose(rng, 500)]:
        got = packing.tokens(WORD)([text])[0].tolist()
        assert got == library.encode(text, add_special_tokens=False).ids
        parts = list(vocabularies.stretches(text, packing.re.compile(r"[ \t\n\r]"), 50))
        assert "".join(parts) == text
        units = packing.tokens(WORD)
        assert [i for p in parts for i in units([p])[0].tolist()] == got
    assert packing.packed(frame(spark, []), WORD).count() == 0
    repeats = frame(spark, ["same text", "same text", None], [7, 7, 8]).withColumn("doc_id", F.when(F.col("doc_id") == 7, 7).cast("long"))
    rows = packing.packed(repeats, WORD).collect()
    assert sum(r["length"] for r in rows) == 2 * (len(library.encode("same text").ids) + 1) + 1 and {r["doc_id"] for r in rows} == {7, None}


def test_plain_words_are_those_of_the_library(library):
    rng = random.Random(14)
    plain = packing.plain_words(WORD)
    chars = "".join(map(chr, range(0x21, 0x7F))) + "ÀÉÎÕÜßàéîõüÿØøÞ" + "aeinrst" * 6 + "AEST'" * 3
    units = ["".join(rng.choice(chars) for _ in range(rng.randint(1, 14))) for _ in range(30_000)]
    units += [t.removesuffix("</w>") for t in library.get_vocab()] + ["'S'T'rE", "don't", "x" * 3000, "", "<|endoftext|>", "日本", "a×b", "12ab", "ſ", "İ"]
    got = plain(units)
    known = [k for k, x in enumerate(got) if x is not None]
    assert len(known) > 60_000 and got[units.index("<|endoftext|>")] is None and got[units.index("İ")] is None
    want = library.encode_batch([units[k] for k in known], add_special_tokens=False)
    assert [got[k] for k in known] == [e.ids for e in want]


def test_assignment_goes_to_the_lowest_cost_that_has_room():
    rng = np.random.default_rng(5)
    cost = packing.Cost(1.0, 0.01)
    for _ in range(200):
        capacity = int(rng.integers(5, 60))
        lengths = rng.integers(1, capacity, int(rng.integers(1, 40)))
        rooms = [capacity] * (int(lengths.sum()) // capacity)
        plan = packing.assigned(lengths, np.array(rooms, np.int64), cost)
        room, load, at = list(rooms), [0.0] * len(rooms), 0
        for d in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
            fit = [s for s in range(len(rooms)) if room[s] >= lengths[d]]
            if fit:
                s = min(fit, key=lambda s: load[s])
                assert plan[at] == (d, 0, lengths[d], s)
                room[s], load[s], at = room[s] - lengths[d], load[s] + cost.of(lengths[d]), at + 1
        used = Counter()
        for _d, begin, end, s in plan:
            used[s] += end - begin
        assert [used[s] for s in range(len(rooms))] == rooms
        assert len({d for d, *_ in plan[at:]}) <= sum(r > 0 for r in room) + 1
    assert packing.binary_rooms(4095 - 1024) == [2048, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1] and packing.binary_rooms(0) == []


# alignment


def brute(texts):
    """Rows by merging common ends from the left, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_library, b_library = Tokenizer.from_buffer(BYTE), sentencepiece.SentencePieceProcessor(model_proto=PIECE)
    a_library.encode_special_tokens = True
    byte_of = {c: b for b, c in vocabularies.byte_characters().items()}
    token = {i: t for t, i in a_library.get_vocab().items()}

    def piece(i):
        return bytes([int(b_library.id_to_piece(i)[3:5], 16)]) if b_library.is_byte(i) else b_library.id_to_piece(i).replace("▁", " ").encode()

    out, docs = [], Counter()
    for t in texts:
        a, b = (a_library.encode(" " + t, add_special_tokens=False).ids, b_library.encode(t)) if t else ([], [])
        bytes_a, bytes_b = [bytes(byte_of[c] for c in token[i]) for i in a], [piece(i) for i in b]
        if not t or not b"".join(bytes_a) == (" " + t).encode() == b"".join(bytes_b):
            out.append((0, 0, [], Counter()))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        found, pairs, i, j = [], Counter(), 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            found.append((a[i:x], b[j:y]))
            pairs.update((p, q) for p in a[i:x] for q in b[j:y])
            i, j = x, y
        out.append((len(a), len(b), found, pairs))
        docs.update(pairs.keys())
    most = defaultdict(int)
    for (p, _), n in docs.items():
        most[p] = max(most[p], n)
    rows = []
    for n_a, n_b, found, pairs in out:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        rows.append((n_a, n_b, len(found), sum(pairs.values()), sum(n for p, n in pairs.items() if docs[p] == most[p[0]]), sum(n * docs[p] for p, n in pairs.items()), digest))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("chunk", [1 << 20, 200])
def test_alignment_equals_brute_force(spark, chunk):
    rng = random.Random(6)
    texts = [*ODD, *STRANGE, "the same text", "the same text", *(prose(rng, rng.choice([1, 5, 60])) for _ in range(30))]
    want = brute(texts)
    got = alignment.judged(frame(spark, texts).repartition(3).withColumn("chunk", F.lit("clash")).withColumn("n_a", F.lit(-1)), BYTE, PIECE, chunk).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == dict(enumerate(want))
    assert any(w[0] == 0 for w, t in zip(want, texts, strict=True) if t) and any(w[2] < min(w[0], w[1]) for w in want)


def test_alignment_of_repeats_nulls_and_nothing(spark):
    texts = ["one text", "one text", None, "other"]
    rows = spark.createDataFrame([(5, texts[0]), (5, texts[1]), (None, texts[2]), (None, texts[3])], "doc_id long, text string")
    got = alignment.judged(rows, BYTE, PIECE).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == Counter(brute(texts))
    assert alignment.judged(rows.limit(0), BYTE, PIECE).count() == 0 and alignment.judged(rows.filter("text is null"), BYTE, PIECE).count() == 1


def test_alignment_in_stretches_and_of_large_groups(monkeypatch):
    rng = random.Random(7)
    texts = [*STRANGE, prose(rng, 400)]
    one = alignment.Aligner(BYTE, PIECE)
    whole = one.tokens(texts)
    monkeypatch.setattr(vocabularies, "STRETCH", 20)
    again = alignment.Aligner(BYTE, PIECE)
    assert all(np.array_equal(x, y) for p in (one, again) for q, r in zip(whole, p.tokens(texts), strict=True) for x, y in zip(q, r, strict=True))
    a, b = np.array([1, 2, 1, 3, 2]), np.array([4, 4, 5])
    found = tuple(np.array([x]) for x in (0, 5, 0, 3))
    small = alignment.links(a, b, found, np.array([0]), 10)
    monkeypatch.setattr(alignment, "LARGE", 1)
    large = alignment.links(a, b, found, np.array([0]), 10)
    assert all(map(np.array_equal, small, large)) and dict(zip(small[1].tolist(), small[2].tolist(), strict=True)) == {14: 4, 15: 2, 24: 4, 25: 2, 34: 2, 35: 1}


def test_groups_cut_at_every_common_end():
    rng = np.random.default_rng(8)
    for _ in range(300):
        docs = int(rng.integers(1, 5))
        ends = [[], []]
        first = [[0], [0]]
        at = 0
        for _d in range(docs):
            n = int(rng.integers(1, 200))
            for k in (0, 1):
                cuts = sorted({*rng.choice(np.arange(1, n + 1), int(rng.integers(0, min(n, 1 + n // int(rng.integers(1, 8))))), replace=False).tolist(), n})
                ends[k] += [at + c for c in cuts]
                first[k].append(len(ends[k]))
            at += n
        a, b = map(np.array, ends)
        found = alignment.groups(a, b, *map(np.array, first))
        common = sorted(set(ends[0]) & set(ends[1]))
        assert a[found[1] - 1].tolist() == common == b[found[3] - 1].tolist()
        assert found[0].tolist() == [0, *found[1][:-1].tolist()] and found[2].tolist() == [0, *found[3][:-1].tolist()]


# centroids


def lloyd(rows, k, rounds, dims, scale, seed):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centre = [v for _, v in start]
    distance = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c, strict=True))
    nearest = lambda v: min(range(len(centre)), key=lambda c: (distance(v, centre[c]), c))
    for _ in range(rounds):
        label = [nearest(v) for _, v in kept]
        for c in range(len(centre)):
            own = [v for (_, v), at in zip(kept, label, strict=True) if at == c]
            if own:
                centre[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    label = [nearest(v) for _, v in kept]
    far = [distance(v, centre[c]) for (_, v), c in zip(kept, label, strict=True)]
    by = Counter()
    for c, d in zip(label, far, strict=True):
        by[c] += d
    return Counter((i, c, d, by[c], sum(far), hashlib.sha256(",".join(map(str, centre[c])).encode()).hexdigest()) for (i, _), c, d in zip(kept, label, far, strict=True))


CASES = "vec_id long, embedding array<float>, label int, block string, chunk string, cluster string"


@pytest.mark.parametrize(("dims", "width", "size", "k"), [(7, 3, 5, 4), (4, 16, 1000, 30), (5, 1, 3, 200)])
def test_centroids_equal_brute_force(spark, dims, width, size, k):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(size=dims).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, [0.5] * dims) for i in range(40)] + [(7, [1.0] * dims), (7, [-1.0] * dims), (None, [0.25] * dims), (None, [-0.0] * dims)]
    rows += [(200, None), (201, []), (202, [1.0] * (dims + 1)), (203, [None] + [1.0] * (dims - 1)), (204, [float("nan")] * dims), (205, [float("inf")] * dims), (206, [1000.0] * dims)]
    table = spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], CASES).repartition(3)
    got = centroids.clustered(table, k=k, rounds=3, dims=dims, width=width, size=size).collect()
    assert Counter(map(tuple, got)) == lloyd(rows, k, 3, dims, 256, 2)


def test_centroids_of_nothing_and_of_numbers_that_are_too_large(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0], 1, "x", "y", "z"), (2, [1e30, 2.0], 1, "x", "y", "z")], CASES)
    assert centroids.clustered(table.limit(0), dims=2).count() == 0 and centroids.clustered(table, dims=3).count() == 0
    with pytest.raises(Exception, match="beyond"):
        centroids.clustered(table, dims=2).count()
    with pytest.raises(ValueError, match="SLICE_BYTES"):
        centroids.clustered(table, k=1 << 20, dims=16)
    x = np.array([[centroids.LARGEST] * 64, [-centroids.LARGEST] * 64])
    assert centroids.squared_distances(x, x).tolist() == [[0, 64 * (2 * centroids.LARGEST) ** 2], [64 * (2 * centroids.LARGEST) ** 2, 0]]
    assert all(centroids.wide(centroids.narrow(y), 2).tolist() == y.tolist() for y in (np.array([1, -2]), np.array([1 << 20, 0]), np.array([1 << 40, -1])))
