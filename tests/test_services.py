"""Sources, sinks, enrichment flow, assembly, streaming and the key pool."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from tabularium.clients import keys
from tabularium.operators import assemble, corpus_checks, enrich, places, refs, release
from tabularium.sources import readers, sinks
from tabularium.streaming import incremental


class Clock:
    def __init__(self):
        self.now, self.slept = 1_000_000.0, []

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.slept.append(s)
        self.now += max(s, 0.001)


def pool(*names):
    clock = Clock()
    return keys.KeyPool(list(names), clock, clock.sleep), clock


def test_keys_rotate_rest_and_return():
    p, clock = pool("aaa111", "bbb222")
    assert p.take() == "aaa111"
    p.limit("aaa111")
    assert p.take() == "bbb222" and p.rotations == 1 and p.log[0] == ("****111", "****222", "minute")
    p.limit("bbb222")
    start = clock.now
    assert p.take() == "aaa111" and clock.now - start >= keys.MINUTE_COOLDOWN - 1 and max(clock.slept) <= keys.POLL


def test_daily_limits_and_invalid_keys():
    p, clock = pool("k1", "k2")
    p.limit("k1", daily=True)
    p.limit("k2", daily=True)
    assert all(s.until - clock.now >= keys.DAY for s in p.states)
    with pytest.raises(keys.QuotaExhausted):
        p.take(wait=False)
    p.reset()
    p.disable("k1")
    assert p.take() == "k2" and p.stats()["****k1"] == {"requests": 0, "failures": 2}
    p.disable("k2")
    with pytest.raises(keys.NoKey):
        p.take()
    with pytest.raises(keys.NoKey):
        keys.KeyPool([])


def test_calls_retry_and_models_rotate():
    p, clock = pool("k1", "k2")
    replies = iter([keys.Transient(), "", keys.RateLimited(), keys.InvalidKey(), "yes"])

    def send(_):
        r = next(replies)
        if isinstance(r, Exception):
            raise r
        return r

    assert keys.call(p, send) == "yes" and clock.slept[:2] == [2.0, 4.0]
    p, _ = pool("k1")

    def limited(model, _):
        if model == "first":
            raise keys.RateLimited(daily=True)
        return "done"

    assert keys.with_models(["first", "second"], p, limited) == ("second", "done")


def test_pool_under_threads():
    p, _ = pool(*[f"key{i}" for i in range(4)])
    got = []
    threads = [threading.Thread(target=lambda: got.extend(p.take() for _ in range(50))) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(got) == 400 == sum(s.requests for s in p.states)


def test_gates_and_exit_codes():
    ok, bad = (lambda: True), (lambda: False)

    def broken():
        raise OSError("disk")

    assert keys.staged([keys.Stage("split", bad), keys.Stage("chunk", ok)]) == ("fail:split", [])
    assert keys.staged([keys.Stage("split", ok), keys.Stage("review", broken, gate=False)]) == ("ok", ["review: disk"])
    assert keys.staged([keys.Stage("split", bad), keys.Stage("chunk", ok)], {"chunk"}) == ("ok", [])
    with pytest.raises(ValueError):
        keys.staged([], {"nothing"})
    assert [keys.exit_code(s) for s in ("ok", "fail:split", "fail:confidence", "fail:extract")] == [0, 3, 2, 1]


def test_settings():
    s = readers.Settings.from_env("X_", {"X_BATCH_SIZE": "7", "X_SEMANTIC_CHUNKING": "true", "X_PRIMARY_MODEL": "m", "X_FALLBACK_MODEL": "m", "X_CHUNK_WORDS": ""})
    assert (s.batch_size, s.semantic_chunking, s.chunk_words, s.models()) == (7, True, 250, ["m"])
    assert readers.generation_options(temperature=0.0, thinking_budget=5, thinking_level="LOW", top_p=None) == {"temperature": 0.0, "thinking_budget": 5}


def test_sources(spark, tmp_path):
    (tmp_path / "reg.json").write_text(json.dumps([{"law_id": "A", "txt_filename": "a.txt", "pdf_filename": "a.pdf", "expected_article_count": 3}, {"law_id": "B", "pdf_filename": "b.pdf"}]))
    reg = readers.registry(spark, str(tmp_path / "reg.json"))
    assert readers.law(reg, "B").first()["repealed_articles"] == []
    with pytest.raises(KeyError, match="'A', 'B'"):
        readers.law(reg, "C")
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.txt").write_text("menu نص القانون\nمادة 1\nنص Creative Commons")
    (raw / "x.pdf").write_bytes(b"p1|p2||p3")
    got = {r["law_id"]: (r["source"], r["source_exists"]) for r in readers.with_sources(reg, readers.files(spark, str(raw))).collect()}
    assert got == {"A": ("a.txt", True), "B": ("b.pdf", False)}
    assert readers.whole_texts(spark, str(raw / "a.txt")).first()["raw_text"] == "مادة 1\nنص"
    pages = readers.extracted(spark, str(raw / "x.pdf"), lambda b: b.decode().split("|"))
    assert pages.first()[:] == ("x.pdf", "p1\n\np2\n\np3", 4)
    ranges = readers.page_ranges(pages.withColumn("page_count", F.lit(31)))
    assert sorted((r["start"], r["stop"]) for r in ranges.collect()) == [(0, 15), (15, 30), (30, 31)]

    def client(frames):
        for f in frames:
            yield f.assign(text="p" + f["start"].astype(str))[["name", "start", "text"]]

    assert readers.recognised(ranges, client).first()["raw_text"] == "p0\n\np15\n\np30"
    a, b = spark.createDataFrame([("A", "raw"), ("B", "raw")], "law_id string, text string"), spark.createDataFrame([("A", "clean")], "law_id string, text string")
    assert {r["law_id"]: r["text"] for r in readers.clean_preferred(a, b).collect()} == {"A": "clean", "B": "raw"}
    done, todo = readers.cached_first(a.select("law_id"), b)
    assert (done.count(), [r["law_id"] for r in todo.collect()]) == (1, ["B"])


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1, "نص, \"x\"\nسطر"), ("A", 2, "b"), ("B", 1, "c")], "law_id string, n int, text string")
    sinks.json_arrays(rows, str(tmp_path / "arr"), "n")
    text = "\n".join(p.read_text() for p in (tmp_path / "arr" / "law_id=A").glob("part*"))
    assert [x["text"] for x in json.loads(text)] == ["نص, \"x\"\nسطر", "b"]
    sinks.json_lines(rows, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 3
    sinks.review_csv(rows.coalesce(1), str(tmp_path / "csv"))
    data = next((tmp_path / "csv").glob("part*")).read_bytes()
    assert data.startswith(b"\xef\xbb\xbflaw_id,n,text\n")
    sinks.texts(rows.filter("law_id = 'B'"), str(tmp_path / "txt"))
    assert next((tmp_path / "txt" / "law_id=B").glob("part*")).read_text() == "c\n"
    table = str(tmp_path / "table")
    sinks.upsert(rows, table, "text")
    sinks.upsert(rows.limit(1).withColumn("n", F.lit(9)), table, "text")
    assert sorted(r["n"] for r in sinks.current(spark, table, "text").collect()) == [1, 2, 9]
    sent = sinks.upsert_service(rows, lambda: len, "text", batch=2)
    assert sent.agg(F.sum("written")).first()[0] == 3


def test_packed_texts_come_back_as_they_were_from_few_files(spark, tmp_path):
    odd = ["", None, "\x1b", "\x1e\x1f\x1b1\x1b2", "\x1b0", "\n a\r\n\n", "\ufeffنص", "\x1f", "x\x1e", "\x1b\x1b3\x1f"]
    rows = [(i, t) for i in (*odd, *(f"L{k}" for k in range(40))) for t in odd]
    df = spark.createDataFrame(rows, "law_id string, text string").repartition(3)
    sinks.packed_texts(df, str(tmp_path / "packed"))
    assert len(list((tmp_path / "packed").rglob("part-*"))) == 3
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")  # records lie across splits
    try:
        back = readers.packed_texts(spark, str(tmp_path / "packed"), strip=False).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    key = lambda r: tuple((x is not None, x or "") for x in r)
    assert sorted(map(tuple, back), key=key) == sorted(rows, key=key)
    sinks.packed_texts(spark.createDataFrame([("A", "menu نص القانون مادة 1 Creative Commons")], "law_id string, text string"), str(tmp_path / "page"))
    assert readers.packed_texts(spark, str(tmp_path / "page")).collect() == [("A", "مادة 1")]


def test_texts_read_writes_no_file_for_each_law(spark):
    from tabularium.plans import queries

    assert len(queries.QUERIES["texts_read"](spark, "/root/testdata/sf0.001").inputFiles()) < 20


def test_upsert_outlives_broken_and_repeated_batches(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = lambda ids, n: spark.createDataFrame([(i, n) for i in ids], "id int, n int")
    read = lambda: {r["id"]: r["n"] for r in sinks.current(spark, table, "id").collect()}
    assert sinks.current(spark, table, "id") is None
    sinks.upsert(rows(range(10), 0), table, "id")
    broken = tmp_path / "t" / "v=1"  # a write that broke off: one file and no mark
    rows([1], 5).coalesce(1).write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert read() == dict.fromkeys(range(10), 0)
    sinks.upsert(rows([10], 1), table, "id")
    sinks.upsert(rows([10], 1), table, "id")  # the same batch again
    sinks.upsert(spark.createDataFrame([(3, 7), (3, 8), (3, 6)], "id int, n int"), table, "id")
    assert read() == {**dict.fromkeys(range(10), 0), 10: 1, 3: 8}
    want = read()
    for k in range(2 * sinks.MERGED_AT):
        sinks.upsert(rows([100 + k], k), table, "id")
        want[100 + k] = k
    assert read() == want and len(list((tmp_path / "t").glob("*"))) < 3 * sinks.MERGED_AT
    assert any(p.name.startswith("base=") for p in (tmp_path / "t").glob("*")) and not (tmp_path / "t" / "v=0").exists()


def test_arrays_of_large_laws_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ARRAY_ROWS", 2)
    with pytest.raises(ValueError):
        sinks.json_arrays(spark.createDataFrame([("A", k) for k in range(3)], "law_id string, n int"), str(tmp_path / "a"), "n")


def test_a_resting_key_is_limited_once():
    p, clock = pool("k1", "k2")
    p.limit("k1")
    until, log = p.states[0].until, list(p.log)
    clock.now += 1
    p.limit("k1")
    p.limit("k1", daily=True)
    assert (p.states[0].until, p.log, p.states[0].failures) == (until, log, 1)


def test_ranks_sort_ids_only(spark):
    rows = spark.createDataFrame([("A", 3, "x"), ("A", 1, "y"), ("A", 1, "y"), ("A", None, "z"), (None, 2, "w"), ("B", 5, "v")], "law_id string, n int, text string")
    got = sorted((r["law_id"] or "", r["r"], r["text"]) for r in places.ranked(rows, "r", "law_id", "n").collect())
    assert got == [("", 1, "w"), ("A", 1, "z"), ("A", 2, "y"), ("A", 3, "y"), ("A", 4, "x"), ("B", 1, "v")]


def test_enrichment_flow(spark):
    found = spark.createDataFrame([("L", f"a{i}", i, "main", f"نص المادة {i}") for i in range(7)], "law_id string, article_id string, sequence_index int, article_type string, text string")
    cache = spark.createDataFrame([("a0", "completed", "m", None), ("a1", "", "m", ""), ("a2", "", None, None), ("a3", "failed", "m", "x")], "article_id string, enrichment_status string, enrichment_model string, enrichment_error string")
    work = enrich.work_list(found, cache)
    assert sorted(r["article_id"] for r in work.collect()) == ["a2", "a3", "a4", "a5", "a6"] and enrich.work_list(found, cache, force=True).count() == 7
    batches = enrich.batched(work, 2)
    assert sorted(r["count"] for r in batches.groupBy("batch").count().collect()) == [1, 2, 2]
    assert sorted(r["count"] for r in enrich.halves(enrich.batched(work, 150)).groupBy("part").count().collect()) == [1, 2, 2]
    replies = enrich.called(enrich.prompts(batches, found.select("law_id").distinct()))
    rows = {r["article_id"]: r for r in enrich.parsed(replies).collect()}
    assert set(rows) == {"a2", "a3", "a4", "a5", "a6"} and rows["a4"]["keywords"] == ["نص", "المادة", "4"]


def test_enrichment_cascade(spark):
    found = spark.createDataFrame([("L", f"a{i}", i, "main", "bad" if i == 3 else "worse" if i == 5 else f"نص {i}") for i in range(9)], "law_id string, article_id string, sequence_index int, article_type string, text string")

    stub = enrich.stub_client

    def client(frames):
        for f in stub(frames):
            broken = f["prompt"].str.contains("bad")
            f.loc[broken, "error"] = "refused"
            f.loc[broken, "reply"] = None
            f.loc[f["prompt"].str.contains("worse") & ~broken, "reply"] = "no json"
            yield f

    got = {r["article_id"]: (r["enrichment_status"], r["enrichment_error"]) for r in enrich.cascade(found, found.select("law_id").distinct(), client, size=4).collect()}
    assert len(got) == 9 and got["a3"] == ("failed", "refused") and got["a5"] == ("", "unreadable reply")
    assert all(v == ("completed", None) for k, v in got.items() if k not in ("a3", "a5"))
    long = spark.createDataFrame([("L", "x", "كلمة " * 300), ("L", "y", "كلمة")], "law_id string, article_id string, text string")
    assert [r["article_id"] for r in enrich.semantic_prompts(long).collect()] == ["x"]


def test_assembly(spark):
    rows = spark.createDataFrame(
        [("a1", "L", 2, "main", False, 0), ("a2", "L", 1, "main", False, 1), ("a1", "L", 3, "main", False, 2), ("a3", "L", 1, "issuance", False, 3), ("a4", "L", None, "main", True, 4)],
        "article_id string, law_id string, article_number int, article_type string, is_repealed boolean, ordinal int",
    )
    reg = spark.createDataFrame([("L", [1])], "law_id string, repealed_articles array<int>")
    out = assemble.ordered(assemble.flagged(assemble.keep_last(rows), reg)).orderBy("release_rank").collect()
    assert [(r["article_id"], r["article_number"], r["is_repealed"], r["newly_flagged"]) for r in out] == [("a4", None, False, False), ("a2", 1, True, True), ("a1", 3, False, False), ("a3", 1, True, True)]
    refs_in = spark.createDataFrame([("L", "a1", 3, "main", 0, [("r", [1, 9, 3], True), ("s", [9], True)]), ("L", "a2", 1, "main", 1, []), ("L", "a3", 1, "issuance", 2, [])], "law_id string, article_id string, article_number int, article_type string, ordinal int, cross_refs array<struct<ref_text:string,article_numbers:array<int>,same_law:boolean>>")
    got = {r["ref_no"]: r["target_article_ids"] for r in refs.resolved(refs_in).collect()}
    assert got == {0: ["a3", "a1"], 1: None}
    assert assemble.violations(rows, "article_id").first()["n"] == 2


def test_corpus_checks_and_ledger(spark):
    rows = [("L", "a", 1, "t", "s", "حق", ["k"], False, None), ("L", "b", 2, " ", None, "غير", [], True, None), ("L", "c", 3, "", "", "", [], False, "failed")]
    enriched = spark.createDataFrame(rows, "law_id string, article_id string, article_number int, topic string, article_summary string, article_category string, keywords array<string>, is_repealed boolean, enrichment_error string")
    reg = spark.createDataFrame([("L", [1])], "law_id string, repealed_articles array<int>")
    got = sorted((r["article_id"], r["code"], r["field"]) for r in corpus_checks.issues(enriched, reg).collect())
    assert got == [("a", "V004", "is_repealed"), ("b", "V001", "article_summary"), ("b", "V001", "topic"), ("b", "V002", "article_category"), ("b", "V004", "is_repealed"), ("b", "V005", "keywords"), ("c", "V003", "enrichment_error")]
    ledger = spark.createDataFrame([("s", 1_000_000, 500_000, 2), ("s", 0, 0, 0)], "stage string, input_tokens long, output_tokens long, image_pages long")
    row = release.ledger_totals(ledger, "stage").first()
    assert (row["calls"], row["cost_usd"]) == (2, pytest.approx(0.1 + 0.2 + 0.00516))


def test_stream_cleans_splits_and_merges(spark, tmp_path):
    raw, table, cp = (str(tmp_path / x) for x in ("raw", "table", "cp"))
    for k, text in enumerate(["مادة 1\nقـديم\nمادة 2\nنص", "مادة 1\nجديد"]):
        spark.createDataFrame([("L", text)], "law_id string, raw_text string").write.mode("append").parquet(raw)
        query = incremental.merged_into(incremental.article_stream(incremental.raw_stream(spark, raw)), table, cp)
        query.awaitTermination()
        assert query.exception() is None and k >= 0
    rows = {r["article_id"]: r["text"] for r in sinks.current(spark, table, "article_id").collect()}
    assert rows == {"L_001": "جديد", "L_002": "نص"}


def test_clients_see_few_requests_at_once(spark):
    """However many requests a task holds, in one batch or several; their order and rows stay."""

    def sizes(frames):
        for frame in frames:
            yield frame.assign(reply=str(len(frame)), error=None)

    rows = spark.range(0, 1000, 1, 1).select(F.lit("l").alias("law_id"), F.col("id").alias("batch"), F.lit(1).cast("long").alias("count"), F.lit("p").alias("prompt"))
    got = enrich.called(rows, sizes).collect()
    assert [r["batch"] for r in got] == list(range(1000)) and {int(r["reply"]) for r in got} == {enrich.PROMPTS, 1000 % enrich.PROMPTS}
