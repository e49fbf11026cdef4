"""Places in a total order, the binary split of calls, and nearest vectors against plain Python."""

import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularium.operators import enrich, nearest, places

DATA = "/root/testdata/sf0.1"


@pytest.mark.parametrize("n", [0, 1, 500])
def test_places_are_those_of_a_sort(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([1, 2, 3, None]), k) for k in range(n)]
    got = places.placed(spark.createDataFrame(rows, "g string, x int, k int").repartition(7), "at", "g", "x").collect()
    key = lambda g, x: (g is not None, g or "", x is not None, x or 0)
    assert [r["at"] for r in sorted(got, key=lambda r: r["at"])] == list(range(n))
    assert [(r["g"], r["x"]) for r in sorted(got, key=lambda r: r["at"])] == sorted(((g, x) for g, x, _ in rows), key=lambda r: key(*r))
    assert sorted(r["k"] for r in got) == list(range(n))


@pytest.mark.parametrize("groups", [0, 1 << 16])
def test_a_group_of_all_rows_is_ranked_by_many_tasks(spark, monkeypatch, groups):
    monkeypatch.setattr(places, "GROUPS", groups)  # joined by a shuffle, and broadcast
    rows = spark.range(20_000).select(F.lit("law").alias("g"), (F.col("id") * 7919 % 20_011).alias("x"))
    got = places.ranked(rows.repartition(8), "r", "g", "x")
    assert got.filter("r < 1 or r > 20000").count() == 0 and got.select("r").distinct().count() == 20_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows would fit one task
    try:
        parts = rows.repartition(8).repartitionByRange("g", "x").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(parts) > 1 and max(r["count"] for r in parts) < 15_000
        assert places.placed(rows, "at", "g", "x").select("at").distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {x: k + 1 for k, x in enumerate(sorted(k * 7919 % 20_011 for k in range(20_000)))}
    assert all(want[r["x"]] == r["r"] for r in got.limit(2000).collect())


@pytest.mark.parametrize(("bad", "n"), [([70], 150), ([], 150), ([0, 1, 149], 150), (range(5), 5), ([0], 1), ([], 0)])
def test_calls_of_the_binary_split(spark, bad, n):
    rows = [("L", f"bad{k}" if k in bad else f"a{k}", "main", k, f"text {k}") for k in range(n)]
    work = spark.createDataFrame(rows, "law_id string, article_id string, article_type string, sequence_index int, text string")
    got, calls = enrich.bisected(work, spark.createDataFrame([("L",)], "law_id string"), enrich.refusing_client('id="bad'))
    assert sorted(r["article_id"] for r in got.collect()) == sorted(r[1] for r in rows if not r[1].startswith("bad"))

    def counted(part):
        broken = any(r[1].startswith("bad") for r in part)
        half = len(part) // 2
        return 1 + (counted(part[:half]) + counted(part[half:]) if broken and len(part) > 1 else 0)

    total = calls.count()
    assert total == (counted(rows) if rows else 0)
    assert len(bad) != 1 or n < 2 or total <= 1 + 2 * math.ceil(math.log2(n))
    assert calls.filter("level > 8").count() == 0


def test_answers_of_the_binary_split_are_stored_without_prompts(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(enrich, "stored", lambda df, tag, store=enrich.stored: kept.setdefault(tag, []).append(df.columns) or store(df, tag))
    work = spark.createDataFrame([("L", f"a{k}", "main", k, "text") for k in range(3)], "law_id string, article_id string, article_type string, sequence_index int, text string")
    got, _ = enrich.bisected(work, spark.createDataFrame([("L",)], "law_id string"), enrich.refusing_client('id="a1'))
    assert sorted(r["article_id"] for r in got.collect()) == ["a0", "a2"]
    assert kept["replies"] and all("prompt" not in columns and "reply" in columns for columns in kept["replies"])


def neighbours(rows, k):
    out = {}
    for i, v in rows:
        if i % 100 == 0:
            near = sorted((float(((np.array(v) - np.array(w)) ** 2).sum()), j) for j, w in rows if j != i)[:k]
            out[i] = [j for _, j in near]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


def test_nearest_of_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-8, 8, 16).astype(float).tolist()) for i in range(300)] + [(1000 + i, [1.0] * 16) for i in range(400)]
    odd = [(5000, None), (5100, [1.0]), (5200, [float("nan")] * 16), (5300, [None] * 16), (None, [1.0] * 16)]
    table = spark.createDataFrame([(i, v, "x") for i, v in [*rows, *odd]], "vec_id long, embedding array<double>, v string").repartition(5)
    vectors = nearest.kept(table, 16)
    asked, want = vectors.filter("id % 100 = 0"), neighbours(rows, 10)
    assert by_query(nearest.exact(vectors, asked, 16, block=3).collect()) == want
    every = nearest.searched(vectors, asked, 16, probes=1000, keep=1000, rows=20).collect()  # all lists, split
    assert by_query(every) == want
    assert Counter(r["rank"] for r in every) == {k: len(want) for k in range(1, 11)}
    none = vectors.limit(0)
    assert nearest.exact(none, none, 16).count() == nearest.searched(none, none, 16).count() == 0
    two = vectors.filter("id in (0, 1)")
    assert by_query(nearest.searched(two, two.filter("id = 0"), 16).collect()) == {0: [1]} == by_query(nearest.exact(two, two.filter("id = 0"), 16).collect())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_recall_of_the_index(spark):
    vectors = nearest.kept(spark.read.parquet(f"{DATA}/embeddings.parquet"), 64)
    asked = vectors.filter("id % 100 = 0")
    want, got = by_query(nearest.exact(vectors, asked, 64).collect()), by_query(nearest.searched(vectors, asked, 64).collect())
    hits = sum(len(set(want[q]) & set(got.get(q, []))) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values())), hits / sum(map(len, want.values()))
    print("recall", hits / sum(map(len, want.values())))
