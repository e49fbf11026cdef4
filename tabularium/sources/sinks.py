"""Sinks: texts, JSON arrays and lines, reports, reviewers' CSV, upserts and release files. Data leaves by Spark's writers, in parallel."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assemble
from .readers import PACK_ESCAPE, PACK_FIELD, PACK_RECORD


#: Most rows of a law in one JSON array.
ARRAY_ROWS = 100_000


def texts(df: DataFrame, path: str, text: str = "text") -> None:
    """A folder for each law: for hundreds or some thousands of them. More go by ``packed_texts``, as each costs several calls to the file system."""
    df.select("law_id", F.col(text).alias("value")).write.mode("overwrite").partitionBy("law_id").text(path)


def packed_texts(df: DataFrame, path: str, text: str = "text") -> None:
    """Texts by law, many a file, as many files as tasks: records of ``PACK_RECORD`` at the end, each field behind a ``PACK_FIELD``. Both are escaped within
    fields, so any text comes back as it was, null too; ``readers.packed_texts`` reads them."""

    def field(c: Column) -> Column:
        c = c.cast("string")
        for k, mark in enumerate((PACK_ESCAPE, PACK_RECORD, PACK_FIELD), 1):  # the escape first
            c = F.replace(c, F.lit(mark), F.lit(f"{PACK_ESCAPE}{k}"))
        return F.concat(F.lit(PACK_FIELD), F.coalesce(c, F.lit(f"{PACK_ESCAPE}0")))

    df.select(F.concat(field(F.col("law_id")), field(F.col(text))).alias("value")).write.mode("overwrite").option("lineSep", PACK_RECORD).text(path)


def json_lines(df: DataFrame, path: str, by_law: bool = True) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy("law_id") if by_law else writer).json(path)


def json_arrays(df: DataFrame, path: str, order: str) -> None:
    """One pretty array for each law, in order. A law of more than ``ARRAY_ROWS`` rows is refused: it goes as lines."""
    most = df.groupBy("law_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if most > ARRAY_ROWS:
        raise ValueError(f"a law has {most} rows; write lines instead")
    others = [c for c in df.columns if c != order]
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*others).alias("_r"))))
    arrays = df.groupBy("law_id").agg(F.to_json(F.transform(rows, lambda x: x["_r"]), {"pretty": "true"}).alias("value"))
    arrays.write.mode("overwrite").partitionBy("law_id").text(path)


def review_csv(df: DataFrame, path: str) -> None:
    """Columns in their order, each file with a byte order mark before its header: values are quoted where they need it, as a quoted header would
    begin before the mark."""
    first, *rest = df.columns
    marked = df.select(F.col(f"`{first}`").alias("\ufeff" + first), *[F.col(f"`{c}`") for c in rest])
    marked.write.mode("overwrite").options(header=True, escape='"', encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def manifest(stats: DataFrame, files: dict[str, str], instructions: list[str]) -> DataFrame:
    """A JSON document for each law: statistics, file names, what reviewers look at and the states they give."""
    numbers = F.struct(*[c for c in stats.columns if c != "law_id"])
    names = F.struct(*[F.lit(v).alias(k) for k, v in files.items()])
    states = F.array(*[F.lit(s) for s in ("approved", "needs_edit", "rejected")])
    checks = F.array(*[F.lit(i) for i in instructions]).cast("array<string>")
    return stats.select("law_id", F.to_json(F.struct("law_id", numbers.alias("statistics"), names.alias("output_files"), states.alias("review_status_values"), checks.alias("fields_to_check"))).alias("manifest"))


#: Generations of changes that are merged into a new base.
MERGED_AT = 16


def upsert(new: DataFrame, path: str, key: str) -> str:
    """Merge rows into a table of generations: ``path/v=N`` holds the rows of one call only, so a small batch costs a small write. A generation counts
    once it is whole (``_SUCCESS``), so one that broke off is as if it had never begun, and a batch that runs again writes the same rows
    anew. Every ``MERGED_AT`` generations all are merged into ``path/base=N``; what is older than the base before is removed.
    Returns the folder. One writer at a time."""
    spark = new.sparkSession
    _, whole, last = _generations(spark, path)
    folder = f"{path}/v={last + 1}"
    new.write.mode("overwrite").parquet(folder)
    if len(whole) + 1 >= MERGED_AT:
        current(spark, path, key).write.mode("overwrite").parquet(f"{path}/base={last + 1}")
        _remove_older(spark, path)
    return folder


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _generations(spark: SparkSession, path: str) -> tuple[int | None, list[int], int]:
    """The newest whole base, the whole generations after it, and the last number that was ever begun."""
    fs, place = _folder(spark, path)
    base, found, last = None, [], -1
    for entry in fs.listStatus(place) if fs.exists(place) else []:
        kind, _, number = entry.getPath().getName().partition("=")
        if kind in {"v", "base"} and number.isdigit():
            last = max(last, int(number))
            if fs.exists(_folder(spark, f"{path}/{kind}={number}/_SUCCESS")[1]):
                if kind == "v":
                    found.append(int(number))
                else:
                    base = max(base if base is not None else -1, int(number))
    return base, sorted(n for n in found if base is None or n > base), last


def _remove_older(spark: SparkSession, path: str) -> None:
    """The newest base and the one before stay, with all generations after the latter: a reader that has just begun may need them."""
    fs, place = _folder(spark, path)
    names = [e.getPath().getName().partition("=") for e in fs.listStatus(place)]
    bases = sorted(int(n) for kind, _, n in names if kind == "base" and n.isdigit() and fs.exists(_folder(spark, f"{path}/base={n}/_SUCCESS")[1]))
    for kind, _, number in names:
        if len(bases) > 1 and kind in {"v", "base"} and number.isdigit() and (int(number) < bases[-2] or (kind == "v" and int(number) == bases[-2])):
            fs.delete(_folder(spark, f"{path}/{kind}={number}")[1], True)


def current(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """The rows of an upserted table: of each key that of the newest whole generation, and of several there the greatest. None before the first."""
    base, whole, _ = _generations(spark, path)
    folders = [(f"base={base}", base)] * (base is not None) + [(f"v={n}", n) for n in whole]
    if not folders:
        return None
    parts = [spark.read.parquet(f"{path}/{name}").withColumn("_generation", F.lit(n)) for name, n in folders]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return assemble.one_of_each(rows, key, "_generation").drop("_generation")


def upsert_service(df: DataFrame, client: Callable[[], Callable[[list[dict]], int]], key: str, batch: int = 500) -> DataFrame:
    """Rows to a document store, ``batch`` at a time from each partition; ``client`` makes a connection whose call upserts by ``key``.
    Returns how many went. The write is idempotent, so a task that runs twice changes nothing."""
    import pandas as pd

    def run(frames):
        send, n, held = client(), 0, []
        for frame in frames:
            held += frame.to_dict("records")
            while len(held) >= batch:
                n, held = n + send(held[:batch]), held[batch:]
        yield pd.DataFrame({"written": [n + (send(held) if held else 0)]})

    return assemble.one_of_each(df, key).mapInPandas(run, "written long")
