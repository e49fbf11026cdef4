"""Cleanup chain with a counter for each step: (law_id, raw_text) to (law_id, text, counters). One narrow pass, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

COUNTERS = list(T.CLEANED)


def clean(raw: DataFrame, text: str = "raw_text") -> DataFrame:
    """Each step's result becomes the next step's input; a counter is what the step changed or removed."""
    n = F.length
    step = raw.withColumn("_0", F.coalesce(F.col(text), F.lit(""))).withColumn("_u", T.cleaned(F.col("_0"))).withColumn("text", F.col("_u.text"))
    return step.select(
        *[x for x in raw.columns if x != text], "text", n("_0").alias("chars_before"), n("text").alias("chars_after"), (n("_0") - n("text")).alias("chars_removed"),
        *[F.col(f"_u.{field}").alias(counter) for counter, field in T.CLEANED.items()],
    )
