"""The look back and ahead in a total order, for any partitioning."""

import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import listing as L


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("share", [0.0, 0.02, 0.5, 1.0])
def test_last_and_next(spark, parts, share):
    rng = random.Random(parts)
    rows = [(i, i * 10 if rng.random() < share else None) for i in range(200)]
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "k int, v int").repartition(parts)
    got = {r.k: (r["last"], r["next"]) for r in L.last_and_next(df, ["k"], F.col("v")).collect()}
    for i, _ in rows:
        back = [v for k, v in rows if k <= i and v is not None]
        ahead = [v for k, v in rows if k >= i and v is not None]
        assert got[i] == (back[-1] if back else None, ahead[0] if ahead else None)


def test_of_nothing_and_without_one_task(spark):
    df = spark.createDataFrame([], "k int, v int")
    assert L.last_and_next(df, ["k"], F.col("v")).count() == 0
    plan = L.last_and_next(spark.range(50).withColumn("v", F.col("id")), ["id"], F.col("v"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_nearest_run_at_midnight_ties_and_either_end(spark):
    folders = spark.createDataFrame([("b_2024-01-10",), ("a_2024-01-14",), ("c_2024-01-14",), ("zz",)], "folder string")
    asked = spark.createDataFrame([("2024-01-01 05:00:00",), ("2024-01-12 00:00:00",), ("2024-01-13 00:00:00",), ("2024-01-13 07:00:00",), ("2025-01-01 00:00:00",)], "ts string").select(F.col("ts").cast("timestamp").alias("ts"))
    got = {str(r.ts): (r.folder, r["diff"]) for r in L.nearest_run(asked, folders).collect()}
    assert got == {"2024-01-01 05:00:00": ("b_2024-01-10", 8), "2024-01-12 00:00:00": ("a_2024-01-14", 2), "2024-01-13 00:00:00": ("a_2024-01-14", 1), "2024-01-13 07:00:00": ("a_2024-01-14", 0), "2025-01-01 00:00:00": ("a_2024-01-14", 353)}
