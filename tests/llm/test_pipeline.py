"""The pipeline and the registered queries against brute-force versions, on the smallest test tables."""

import hashlib
import os
import re

import pytest

from tests.llm.test_operators import classes, removed

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def test_pipeline_equals_brute_force(spark):
    import public_tokenizers
    import tiktoken

    import corpus_pipeline
    from tabularium.llm import bpe

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "MinHash near-dedup", "substring dedup", "benchmark decontamination", "byte-level BPE"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = corpus_pipeline.language_id(spark, docs, DATA)
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    groups = classes(list(left.values()), list(left), corpus_pipeline.NEAR)
    left = {i: t for i, t in left.items() if groups[i][2]}
    ids = sorted(left)
    n = 50
    first, words = {}, {i: re.findall(r"[^\x20\x09-\x0D]+", left[i] or "") for i in ids}
    for i in ids:
        for k in range(len(words[i]) - n + 1):
            first.setdefault(tuple(words[i][k : k + n]), i)
    for i in ids:
        gone = {j for k in range(len(words[i]) - n + 1) if first[tuple(words[i][k : k + n])] < i for j in range(k, k + n)}
        if gone:
            spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", left[i])]
            ends = [s for s, _ in spans[1:]] + [len(left[i])]
            left[i] = left[i][: spans[0][0]] + "".join(left[i][a:b] for k, ((a, _), b) in enumerate(zip(spans, ends, strict=True)) if k not in gone)
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    left = {i: t for i, t in left.items() if not any(plain(x) in plain(t) for x in items)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DATA).collect()}
    assert set(got) == set(left)
    for i, text in left.items():
        ids_ = library.encode_ordinary(text)
        assert list(got[i]["ids"]) == ids_ and got[i]["n_tokens"] == len(ids_)
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_queries_with_sql_equal_it(spark):
    import duckdb

    from tabularium.llm import entry

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    for name, sql in entry.oracle_sql().items():
        df, found = entry.queries()[name](spark, DATA), con.sql(sql)
        names = sorted(df.columns)
        assert sorted(found.columns) == names
        assert sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(repr, found.select(", ".join(names)).fetchall())), name


def test_queries_without_sql(spark):
    from tabularium.llm import entry

    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    rows = {name: entry.queries()[name](spark, DATA).collect() for name in ("op1_sharding", "op2_langid", "op5_spotsigs", "op7_decontaminate", "op9_quality")}
    assert all(len(r) == n for r in rows.values())
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    held = [r for r in rows["op2_langid"] if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    for r in rows["op7_decontaminate"]:
        assert {i for i, x in items.items() if x in texts[r["doc_id"]]} <= set(r["item_ids"])


def test_packing_and_alignment_of_the_test_table(spark):
    from tabularium.llm import entry
    from tests.llm.test_packing_alignment_centroids import COLUMNS, WORD, brute, check_pieces
    from tokenizers import Tokenizer

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    library = Tokenizer.from_buffer(WORD)
    check_pieces([r.asDict() for r in entry.queries()["op11_packing"](spark, DATA).collect()], {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()})
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in entry.queries()["op12_alignment"](spark, DATA).collect()}
    assert got == dict(zip(texts, brute(list(texts.values())), strict=True))


def test_removed_matches_a_hand_made_case():
    assert [x[1] for x in removed(["a b c d", "x a b c y", "a b c"], [0, 1, 2], 3)] == [0, 3, 3]
