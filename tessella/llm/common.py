"""Helpers shared by the training-data operators: worker imports, shared storage, Arrow text views."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..session import materialise, shared_path

__all__ = ["attach", "give_back", "join_counted", "materialise", "settle", "shared_path", "slabs", "utf8", "with_ids"]
#: Texts in an Arrow batch.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Upper bound on the bytes of text that a kernel looks at in one go.
SLAB_BYTES = 1 << 20


def attach(spark: SparkSession) -> None:
    """Let Python workers import this package when it isn't installed on their path.

    Rows here hold whole texts, so batches get fewer of them than Spark's 10,000, unless the session says how many."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_ROWS)
    session.attach(spark)


def join_counted(rows: DataFrame, table: DataFrame, key: str, n: str, share: int = 10_000) -> DataFrame:
    """``rows`` joined with ``table``, which has each key once and in ``n`` the number of rows with it (dropped).

    Keys with more than one in ``share`` of all rows, of which there can't be more than ``share``, are broadcast; the
    others are shuffled, so no task gets more rows for one key than that part."""
    total = table.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    often = F.col(n) * share > total
    hot, cold = table.where(often).drop(n), table.where(~often).drop(n)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def settle(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps that are written and done with.

    It does so once the driver has collected the objects that stood for them, which by itself may happen much later."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_ids(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` with one of ``ids`` (one column, repeats allowed); of several rows with the same id, one.

    Only rows whose id is repeated are compared with each other; the others pass one join."""
    counted = materialise(ids.toDF("_id").groupBy("_id").agg(F.count("*").alias("_n")), "kept-ids")
    once = df.join(counted.where("_n = 1").select(F.col("_id").alias(id_col)), id_col, "left_semi")
    again = df.join(counted.where("_n > 1").select(F.col("_id").alias(id_col)), id_col, "left_semi")
    return once.unionByName(again.dropDuplicates([id_col])).select(df.columns)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the offsets where each begins (one more than texts); a null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slabs(texts: pa.Array, limit: int = SLAB_BYTES) -> Iterator[pa.Array]:
    """The texts in consecutive slices of about ``limit`` bytes; a longer text is a slice of its own."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, kind)
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, int(at[i]) + limit, "right")) - 1)
        yield texts.slice(i, j - i)
        i = j


def give_back[T](result: T) -> T:
    """The result, after Arrow's pool has returned the memory of batches that are gone: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    return result
