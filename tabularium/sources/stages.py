"""Stage tables in the folder that driver and executors share: what several later steps read is computed once and survives lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Only used where the cluster names no shared folder, as in local tests.
LOCAL_SHARED = "/tmp/checkpoints/tabularium"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("a cluster needs spark.checkpoint.dir, a folder that driver and executors share")
    return (named or LOCAL_SHARED).rstrip("/")


def run_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_dir(spark)}/tabularium/{tag}-{uuid.uuid4().hex}"


def temporary(spark: SparkSession, path: str) -> None:
    """Have a folder removed when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here and survives lost executors. The table goes when the
    application ends."""
    path = run_dir(df.sparkSession, tag)
    df.write.parquet(path)
    temporary(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MADE: dict[tuple[str, str], DataFrame] = {}


def once(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` builds on its own stage tables, built at the first call of an application. Each call has columns of its own, so that the results can be joined."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key].toDF(*_MADE[key].columns)
