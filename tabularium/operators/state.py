"""What a run has to do again: fingerprints of the inputs of each stage of each law, and the stages whose inputs are not those they were run on.

A stage depends on its own inputs and on the stage before it, so its fingerprint holds that stage's: whatever changes, all that
follows is out of date too. State is narrow (no texts) and only ever appended to; its newest row of a law and stage counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "law_id string, stage string, print string, generation long"


def fingerprints(laws: DataFrame, inputs: Mapping[str, Sequence[str]], version: str = "1") -> DataFrame:
    """(law_id, stage, print) for each stage of ``inputs``, in that order, with the columns of ``laws`` that it reads. Columns that ``laws`` lacks are no inputs; null
    and empty differ. ``version``: of the code; another one makes everything out of date."""
    have, last, made = set(laws.columns), F.lit(version), []
    rows = laws
    for stage, names in inputs.items():
        own = [F.coalesce(F.to_json(F.struct(F.col(f"`{c}`").alias("v"))), F.lit("")) for c in names if c in have]
        made.append((stage, f"_print_{len(made)}"))
        rows = rows.withColumn(made[-1][1], F.sha2(F.concat_ws("\n", last, F.lit(stage), *own), 256))
        last = F.col(made[-1][1])
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(c).alias("print")) for s, c in made])).alias("x")
    return rows.select("law_id", each).select("law_id", "x.*")


def newest(state: DataFrame) -> DataFrame:
    """The row of each law and stage that counts."""
    return state.groupBy("law_id", "stage").agg(F.max_by("print", "generation").alias("print"), F.max("generation").alias("generation"))


def stale(now: DataFrame, state: DataFrame) -> DataFrame:
    """The rows of ``now`` (law_id, stage, print) whose stage has not been run on just these inputs."""
    before = newest(state).select("law_id", "stage", F.col("print").alias("_before"))
    return now.join(before, ["law_id", "stage"], "left").filter(~F.col("print").eqNullSafe(F.col("_before"))).drop("_before")
