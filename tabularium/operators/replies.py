"""A log of a client's answers that outlives a broken run: a prompt that was answered is never asked again.

A request's key is a digest of model and prompt. Requests whose key the log has answered take that answer; the others are dealt to tasks of ``per_task`` prompts,
and each task's answers are in the log as soon as that task has committed (the committer that moves a task's files at once), so a run that breaks
loses only what tasks in flight had asked. A run appends to a folder of its own; nothing in the log is changed or moved.

Defined cases: equal prompts are asked once and share the answer; a null prompt is not asked and has neither reply nor error; failed calls are
logged for the run that made them and asked again by the next; of several answers to one key the greatest counts; an empty log or
request table is fine. Rows and columns of the requests stay as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from math import ceil

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stages import stored

ANSWER = "key string, reply string, error string"
PER_TASK = 16


def logged(spark: SparkSession, log: str) -> DataFrame:
    """(key, reply, error, run) of all runs whose tasks have committed anything."""
    try:
        return spark.read.schema(f"{ANSWER}, run string").option("basePath", log).parquet(log)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{ANSWER}, run string")


def keyed(requests: DataFrame, model: str) -> DataFrame:
    """Requests with ``_key``; null prompts have none."""
    return requests.withColumn("_key", F.sha2(F.concat(F.lit(f"{model}\n"), "prompt"), 256))


def asked(requests: DataFrame, ask: Callable[[DataFrame], DataFrame], log: str, model: str = "primary", usable: Column | None = None, per_task: int = PER_TASK) -> DataFrame:
    """``requests`` with reply and error, from the log where it has a ``usable`` answer (default: any reply), else from ``ask``, which adds both columns."""
    spark, run = requests.sparkSession, f"r{uuid.uuid4().hex}"
    usable = F.col("reply").isNotNull() if usable is None else usable
    rows = stored(keyed(requests, model).withColumn("_row", F.monotonically_increasing_id()), "requests")
    answered = logged(spark, log).filter(usable).select(F.col("key").alias("_key"))
    first = rows.filter("_key is not null").groupBy("_key").agg(F.min("_row").alias("_row")).join(answered, "_key", "left_anti").select("_row")
    first = stored(first, "unanswered")
    if n := first.count():
        todo = rows.join(first, "_row", "left_semi").repartition(ceil(n / per_task))
        answers = ask(todo).select(F.col("_key").alias("key"), "reply", "error")
        answers.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{log}/run={run}")
    # A task that committed and was repeated has told its answers twice.
    told = logged(spark, log).filter(usable | (F.col("run") == run)).groupBy("key").agg(F.max(F.struct(usable.alias("usable"), "reply", "error")).alias("_told"))
    out = rows.join(told.withColumnRenamed("key", "_key"), "_key", "left")
    return stored(out.select(*requests.columns, "_told.reply", "_told.error"), "replies")
