"""Extraction routes, clients with a key pool, and a whole batch from sources to a release."""

import json

import pytest

from tabularium.clients import keys, remote
from tabularium.operators import chunk, enrich, extract, split_checks
from tabularium.plans import batch
from tabularium.sources import readers

BODY = "يلتزم كل طرف بما ورد في هذا الاتفاق ويجب عليه الوفاء به في الموعد المحدد دون تأخير أو مماطلة وفقا لأحكام هذا الباب"


def law_text(n, skip=()):
    return "\n".join(f"مادة ({k})\n{BODY} {k}" for k in range(1, n + 1) if k not in skip)


@pytest.fixture
def sources(tmp_path):
    laws = [("good", 12, law_text(12)), ("gap", 12, law_text(12, {6})), ("poor", 40, "نص قصير"), ("gone", 3, None)]
    folder = tmp_path / "texts"
    folder.mkdir()
    rows = []
    for name, expected, text in laws:
        rows.append({"law_id": name, "law_name_ar": f"قانون {name}", "law_number": "1", "year": 2001, "expected_article_count": expected, "txt_filename": f"{name}.txt"})
        if text is not None:
            (folder / f"{name}.txt").write_text(text, encoding="utf-8")
    (tmp_path / "registry.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    return tmp_path


def test_batch_runs_resumes_and_reports(spark, sources, capsys):
    where = [str(sources / "registry.json"), str(sources / "texts"), str(sources / "out")]
    client = ["--client", "tabularium.operators.enrich:stub_client"]
    assert batch.main(where, spark) == 1
    bare = spark.read.parquet(f"{where[2]}/enrich").select("enrichment_error", "topic").distinct().collect()
    assert [(r["enrichment_error"], r["topic"]) for r in bare] == [("not_reached", None)]  # without a client nothing is made up
    assert batch.main([*where, *client, "--stages", *batch.STAGES[5:]], spark) == 1
    said = capsys.readouterr().out
    assert "gap failed at split" in said and "poor failed at confidence" in said
    out = str(sources / "out")
    assert {r["law_id"] for r in spark.read.parquet(f"{out}/assemble").collect()} == {"good"}
    document = json.loads(spark.read.parquet(f"{out}/release").first()["metadata"])
    assert document["law_name_ar"] == "قانون good" and document["year"] == 2001 and document["statistics"]["total_articles"] == 12
    assert document["enrichment"]["models_used"] == {"primary": 12} and document["output_files"]["chunks_json"] == "chunks.json" and document["exported_at"].endswith("+00:00")
    texts = {r["code"]: r["description"] for r in spark.read.parquet(f"{out}/split_issues").filter("law_id = 'gap'").collect()}
    assert texts["E003"] == "Article 6 missing and not in repealed_articles (neighbours present — likely a split error)"
    report = spark.read.parquet(f"{out}/assembly_report").first()
    assert (report["total_articles_in"], report["total_articles_out"], report["duplicates_removed"]) == (12, 12, 0)

    # A run that broke off after validation takes up the tables that are whole; no article is asked for again.
    (sources / "out" / "assemble" / "_SUCCESS").unlink()
    laws = readers.registry(spark, where[0]).filter("law_id <> 'gone'")

    def never(frames):
        raise AssertionError("asked again")
        yield

    again = batch.Batch(laws, readers.whole_texts(spark, where[1]), out, client=never).run()
    assert {r["law_id"]: r["status"] for r in again.collect()} == {"good": "ok", "gap": "fail:split", "poor": "fail:confidence"}
    with pytest.raises(ValueError, match="no such stage"):
        batch.Batch(laws, readers.whole_texts(spark, where[1]), out).run({"nothing"})
    new = batch.Batch(laws, readers.whole_texts(spark, where[1]), str(sources / "part"))
    assert {r["status"] for r in new.run({"extract", "clean"}).collect()} == {"pending:confidence"}
    with pytest.raises(FileNotFoundError, match="confidence"):
        new.run({"split"})


def test_a_later_run_works_on_new_and_changed_laws_only(spark, sources):
    registry, texts = str(sources / "registry.json"), str(sources / "texts")
    kept = ["law_id", "article_id", "article_number", "text", "topic", "enrichment_status", "release_rank"]

    def run(kind, out, client=enrich.stub_client):
        laws = readers.registry(spark, registry).filter("law_id <> 'gone'")
        b = kind(laws, readers.whole_texts(spark, texts), str(sources / out), client=client)
        return b, sorted(map(tuple, b.run().collect())), sorted(map(tuple, b.table("assemble").select(*kept).collect()))

    def made(b, name, generation):
        place = f"{b.out}/{name}/generation={generation}"
        return sorted({r["law_id"] for r in spark.read.parquet(place).collect()}) if (sources / "inc" / name / f"generation={generation}").exists() else None

    def entry(**law):
        rows = json.loads((sources / "registry.json").read_text(encoding="utf-8"))
        rows = [r for r in rows if r["law_id"] != law["law_id"]] + [{"law_name_ar": "قانون", "law_number": "1", "year": 2001, "txt_filename": f"{law['law_id']}.txt"} | law]
        (sources / "registry.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")

    b, *first = run(batch.Incremental, "inc")
    assert made(b, "extract", 1) == ["gap", "good", "poor"]
    # a law more: it alone is read and written
    (sources / "texts" / "more.txt").write_text(law_text(12) + " آخر", encoding="utf-8")
    entry(law_id="more", expected_article_count=12)
    b, *second = run(batch.Incremental, "inc")
    assert [made(b, n, 2) for n in ("extract", "split", "enrich", "chunk")] == [["more"]] * 4
    assert {r[0] for r in first[1]} == {"good"} and {r[0] for r in second[1]} == {"good", "more"}
    # nothing has changed: nothing runs, nor is anything asked
    before = (sources / "inc" / "release" / "_SUCCESS").stat().st_mtime_ns

    def never(frames):
        raise AssertionError("asked again")
        yield

    b, *third = run(batch.Incremental, "inc", never)
    assert third == second and made(b, "extract", 3) is None and (sources / "inc" / "release" / "_SUCCESS").stat().st_mtime_ns == before
    # another count goes on from the confidence gate, another text from extraction
    entry(law_id="gap", expected_article_count=11)
    (sources / "texts" / "good.txt").write_text(law_text(12) + " جديد", encoding="utf-8")
    b, *fourth = run(batch.Incremental, "inc")
    assert made(b, "extract", 3) == ["good"] and made(b, "confidence", 3) == ["gap", "good"]
    assert fourth == list(run(batch.Batch, "all")[1:]) and any("جديد" in r[3] for r in fourth[1])
    # a law that has left is in no table that is read
    rows = [r for r in json.loads((sources / "registry.json").read_text(encoding="utf-8")) if r["law_id"] != "more"]
    (sources / "registry.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    assert {r[0] for r in run(batch.Incremental, "inc")[2]} == {"good"}


def test_exit_codes():
    assert batch.code({"ok": 3}) == 0 and batch.code({}) == 1 and batch.code({"ok": 1, "fail:split": 1}) == 1
    assert batch.code({"fail:confidence": 1}) == 2 and batch.code({"fail:split": 1}) == 3 and batch.code({"fail:extract": 1}) == 1


def test_batch_of_unknown_laws(spark, sources):
    assert batch.main([str(sources / "registry.json"), str(sources / "texts"), str(sources / "none"), "nobody"], spark) == 1


def test_extraction_takes_the_first_source(spark):
    reg = spark.createDataFrame([("plain", "p.txt", "p.pdf", 6, 0), ("cached", None, "c.pdf", 6, 0), ("native", None, "n.pdf", 6, 0), ("scan", None, "s.pdf", 6, 0), ("none", None, None, 6, 0), ("twice", "t.txt", None, 6, 0)],
                                "law_id string, txt_filename string, pdf_filename string, expected_article_count int, expected_chapter_headings int")
    texts = spark.createDataFrame([("p.txt", law_text(6)), ("t.txt", law_text(6) + "\n" + law_text(6))], "name string, raw_text string")
    cache = spark.createDataFrame([("cached", "kept"), ("plain", "unused")], "law_id string, text string")
    native = spark.createDataFrame([("n.pdf", law_text(6), 3), ("s.pdf", None, 16), ("c.pdf", "x", 1)], "name string, raw_text string, page_count int")
    asked = []

    def recognise(rows):
        asked.append(sorted((r["name"], r["page_count"]) for r in rows.collect()))
        return readers.recognised(readers.page_ranges(rows), remote.stub_recogniser)

    got = {r["law_id"]: r for r in extract.extracted(reg, texts, cache, native, recognise).collect()}
    routes = {k: r["extraction_source"] for k, r in got.items()}
    assert routes == {"plain": "plaintext", "cached": "cached", "native": "pymupdf", "scan": "gemini_ocr", "none": "failed", "twice": "plaintext+dedup_stripped"}
    assert asked == [[("s.pdf", 16)]] and got["scan"]["text"].split("\n")[0] == "s.pdf 1" and "s.pdf 16" in got["scan"]["text"]
    assert got["none"]["error"] and not got["none"]["success"] and got["none"]["char_count"] == 0 and got["cached"]["text"] == "kept"
    assert extract.extracted(reg.limit(0), texts).count() == 0


def test_clients_own_a_key_pool_and_keep_errors(spark):
    def send(key, prompt):
        if key == "bad":
            raise keys.InvalidKey
        if "boom" in prompt:
            raise ValueError("boom")
        return f"{key}:{prompt}"

    rows = spark.createDataFrame([(1, "a"), (2, "boom"), (3, "b")], "batch int, prompt string").coalesce(1)
    got = {r["batch"]: (r["reply"], r["error"]) for r in enrich.called(rows, remote.pooled(["bad", "good"], send)).collect()}
    assert got == {1: ("good:a", None), 2: (None, "ValueError: boom"), 3: ("good:b", None)}


def test_semantic_cuts_by_a_client(spark):
    rows = spark.createDataFrame([("long", "l", " ".join(f"w{k}" for k in range(600))), ("short", "l", "few words")], "article_id string, law_id string, text string")
    replies = enrich.called(enrich.semantic_prompts(rows), remote.stub_cutter).select("article_id", "reply")
    got = sorted((r["article_id"], r["chunk_method"], r["word_count"]) for r in chunk.chunked(rows.join(replies, "article_id", "left"), reply="reply").collect())
    assert got == [("long", "semantic", 100), ("long", "semantic", 250), ("long", "semantic", 250), ("short", "rule_based", 2)]


@pytest.mark.parametrize(("part", "whole", "said"), [(9, 8, "112.5%"), (449, 400, "112.2%"), (451, 400, "112.8%"), (1, 3, "33.3%"), (2, 3, "66.7%"), (0, 5, "0.0%")])
def test_shares_round_halves_to_even(spark, part, whole, said):
    row = spark.range(1).selectExpr(f"{part} as a", f"{whole} as b")
    assert row.select(split_checks._percent(row["a"], row["b"])).first()[0] == said == f"{part / whole:.1%}"


def test_presentation_forms_of_documents_are_folded(spark):
    laws = spark.createDataFrame([("a", None, "a.pdf", 12, 0)], "law_id string, txt_filename string, pdf_filename string, expected_article_count int, expected_chapter_headings int")
    plain = law_text(12)
    forms = plain.replace("مادة", "\ufee3\ufe8e\ufea9\ufe93").replace("يلتزم", "\ufef3\ufee0\ufe98\ufeb0\ufee1")
    native = spark.createDataFrame([("a.pdf", forms, 3)], "name string, raw_text string, page_count int")
    texts = spark.createDataFrame([], "name string, raw_text string")
    row = extract.extracted(laws, texts, native=native).first()
    assert (row["text"], row["extraction_source"], row["success"]) == (plain, "pymupdf", True)
