"""The log of answers outlives a broken run; reachability over references equals a search by hand."""

import os
import time
from collections import deque

import pytest
from pyspark.sql import functions as F

from tabularium.operators import enrich, refs, replies


def prompts(spark, n):
    return spark.createDataFrame([("L", k, 1, f"prompt {k}") for k in range(n)], "law_id string, batch long, count long, prompt string")


def counting(folder, bad=None):
    """A client that leaves a file for each call and breaks on one prompt as long as its switch is there."""

    def run(frames):
        for frame in frames:
            for p in frame["prompt"]:
                open(f"{folder}/{p.split()[1]}-{time.time_ns()}", "w").close()
                if bad is not None and p == f"prompt {bad}" and os.path.exists(f"{folder}/broken"):
                    time.sleep(4)
                    raise RuntimeError("the client broke")
            yield frame.assign(reply=[f"answer to {p}" for p in frame["prompt"]], error=None)

    return lambda requests: enrich.called(requests, run)


def calls(folder):
    return sorted(int(f.split("-")[0]) for f in os.listdir(folder) if "-" in f)


def test_a_broken_run_asks_no_answered_prompt_again(spark, tmp_path):
    told, log = tmp_path / "told", str(tmp_path / "log")
    told.mkdir()
    (told / "broken").touch()
    with pytest.raises(Exception, match="the client broke"):
        replies.asked(prompts(spark, 60), counting(told, bad=59), log, per_task=4)
    kept = {r["key"] for r in replies.logged(spark, log).collect()}
    assert kept
    keys = {r["_key"]: r["batch"] for r in replies.keyed(prompts(spark, 60), "primary").collect()}
    answered = {keys[k] for k in kept}
    (told / "broken").unlink()
    before = calls(told)
    got = {r["batch"]: r["reply"] for r in replies.asked(prompts(spark, 60), counting(told), log, per_task=4).collect()}
    assert got == {k: f"answer to prompt {k}" for k in range(60)}
    again = calls(told)
    for k in before:
        again.remove(k)
    assert set(again) == set(range(60)) - answered and len(again) == len(set(again))
    replies.asked(prompts(spark, 60), counting(told), log)
    assert len(calls(told)) == len(before) + len(again)  # all is known now


def test_failed_calls_equal_and_null_prompts(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame([("L", 0, 1, "same", "x"), ("L", 1, 1, "same", "y"), ("L", 2, 1, None, "z"), ("L", 3, 1, "bad", None)], "law_id string, batch long, count long, prompt string, reply_of string")

    def refuse(requests):
        bad = F.col("prompt") == "bad"
        return requests.withColumn("reply", F.when(~bad, F.upper("prompt"))).withColumn("error", F.when(bad, "refused"))

    first = {r["batch"]: (r["reply_of"], r["reply"], r["error"]) for r in replies.asked(rows, refuse, log).collect()}
    assert first == {0: ("x", "SAME", None), 1: ("y", "SAME", None), 2: ("z", None, None), 3: (None, None, "refused")}
    fine = lambda requests: requests.withColumn("reply", F.lit("new")).withColumn("error", F.lit(None).cast("string"))
    second = {r["batch"]: (r["reply"], r["error"]) for r in replies.asked(rows, fine, log).collect()}
    assert second == {0: ("SAME", None), 1: ("SAME", None), 2: (None, None), 3: ("new", None)}
    assert {r["reply"] for r in replies.asked(rows, fine, log, model="other").filter("batch <> 2").collect()} == {"new"}
    assert replies.asked(rows.limit(0), fine, log).count() == 0 and replies.asked(rows.limit(0), fine, str(tmp_path / "none")).count() == 0


def test_cascade_with_a_log(spark, tmp_path):
    rows = [("L", f"a{i}", "main", i, "bad" if i == 3 else "worse" if i == 5 else f"text {i}") for i in range(9)]
    work = spark.createDataFrame(rows, "law_id string, article_id string, article_type string, sequence_index int, text string")
    laws, log, stub = work.select("law_id").distinct(), str(tmp_path / "log"), enrich.stub_client

    def client(frames):
        for f in stub(frames):
            broken = f["prompt"].str.contains("bad")
            f.loc[broken, "error"] = "refused"
            f.loc[broken, "reply"] = None
            f.loc[f["prompt"].str.contains("worse") & ~broken, "reply"] = "no json"
            yield f

    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(enrich.cascade(work, laws, client, size=4, log=log)) == plain(enrich.cascade(work, laws, client, size=4))
    made = replies.logged(spark, log).count()
    got = {r["article_id"]: r["enrichment_status"] for r in enrich.cascade(work, laws, stub, size=4, log=log).collect()}
    assert got == {f"a{i}": "completed" for i in range(9)}  # what was refused or unreadable is asked again
    more = replies.logged(spark, log).count() - made
    enrich.cascade(work, laws, stub, size=4, log=log)
    assert 0 < more < made and replies.logged(spark, log).count() == made + more


@pytest.mark.parametrize("seed", [1, 2])
def test_reaching(spark, seed):
    import random

    r = random.Random(seed)
    links = {(law, f"a{r.randrange(60)}", f"a{r.randrange(60)}") for law in "LM" for _ in range(55)} | {("N", f"a{k}", f"a{k + 1}") for k in range(12)} | {("N", "a12", "a0"), ("O", "a1", "a1")}
    goals = [("L", "a1"), ("L", "a1"), ("M", "a7"), ("N", "a12"), ("O", "a9"), (None, "a1"), ("L", None)]
    want = {}
    todo = deque((g, 0) for g in goals if None not in g)
    while todo:
        at, n = todo.popleft()
        if at not in want:
            want[at] = n
            todo.extend(((law, a), n + 1) for law, a, b in links if (law, b) == at)
    table = spark.createDataFrame([*links, *links, (None, "a2", "a1"), ("L", "x", None)], "law_id string, article_id string, target string")
    found = refs.reaching(table, spark.createDataFrame(goals, "law_id string, article_id string"))
    assert {(x["law_id"], x["article_id"]): x["steps"] for x in found.collect()} == want and found.count() == len(want)
    assert refs.reaching(table.limit(0), spark.createDataFrame([], "law_id string, article_id string")).count() == 0
