"""Structured Streaming: new raw texts are cleaned and split as their files come in, and articles are merged into a table by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cleanup, split
from ..sources import sinks


def raw_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """(law_id, raw_text) of Parquet files that are added to a folder."""
    return spark.readStream.schema("law_id string, raw_text string").option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def article_stream(raw: DataFrame) -> DataFrame:
    """Narrow from end to end: no state and no shuffle."""
    return split.articles(split.scanned(cleanup.clean(raw).select("law_id", "text")))


def merged_into(found: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each batch is upserted by article id; a batch that runs again writes the same rows."""

    def merge(batch: DataFrame, _: int) -> None:
        sinks.upsert(batch, path, "article_id")

    return found.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger_by_hour(calls: DataFrame, late: str = "1 hour") -> DataFrame:
    """Calls and cost of each stage by hour, as a stream: hours are final once the watermark has passed them."""
    from ..operators.release import call_cost

    cost = call_cost(F.col("input_tokens"), F.col("output_tokens"), F.col("image_pages"))
    hours = calls.withWatermark("ts", late).groupBy(F.window("ts", "1 hour").alias("hour"), "stage")
    return hours.agg(F.count("*").alias("calls"), F.round(F.sum(cost), 6).alias("cost_usd"))
