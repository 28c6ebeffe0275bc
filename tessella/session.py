"""Session helpers: worker imports and tables written to the storage that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []
#: Spark's own setting: a query's shuffle files go as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROOT = str(Path(__file__).resolve().parents[1])


def attach(spark: SparkSession) -> None:
    """Let Python workers import this package when it isn't installed on their path."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *paths])


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder stands in on a local master; a cluster has to name one that it shares."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def drop_shared(spark: SparkSession, since: int = 0) -> int:
    """Delete the folders that this driver has got from ``shared_path``, but for the first ``since``: once no result that is read
    from them is needed any more. Gives back how many are kept, for a later call."""
    for path in _MADE[since:]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    del _MADE[since:]
    return len(_MADE)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to shared storage and read them back, which cuts lineage and fixes what isn't deterministic.

    The shuffle files of the write go with its end, and not only once the driver happens to collect its garbage."""
    spark = df.sparkSession
    path, before = shared_path(spark, name), spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
