"""Buckets of variants: what is made of them grows with the fingerprints, and crowded ones are counted wherever their rows fall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("xxhash")
from tessella.llm import simhash


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def group(size):
    """Different fingerprints that share their lower two segments, so they crowd some buckets."""
    rng = np.random.default_rng(size)
    return [signed(int(x) << 42 | 0x155555 << 21 | 0xAAAAA) for x in rng.choice(1 << 22, size, replace=False)]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("size", [20, 400])
def test_no_join_takes_variants_out(spark, size):
    """The index of all variants isn't joined with the crowded buckets to leave them out, nor with itself."""
    found = simhash.links(spark.createDataFrame([(x,) for x in group(size)], "fp long"))
    assert "LeftAnti" not in plan(found) and plan(found).count("Join Inner") <= 1


@pytest.mark.parametrize(("crowd", "lot"), [(1, 7), (5, 50), (64, 100), (64, 1 << 15)])
def test_buckets_are_whole(spark, monkeypatch, crowd, lot):
    monkeypatch.setattr(simhash, "LOT", lot)
    fps = group(300) + [signed(int(x)) for x in np.random.default_rng(3).integers(0, 1 << 63, 200)]
    df = spark.createDataFrame([(x,) for x in fps], "fp long").repartition(3)
    all_rows = simhash.variants(df).collect()
    assert len(all_rows) == 64 * len(fps) and {r.more for r in all_rows} == {0}
    buckets = {}
    for r in all_rows:
        buckets.setdefault(r.key, []).append(r.fp)
    few = simhash.variants(df, crowd + 1).groupBy("key").agg((F.count("*") + F.sum("more")).alias("n")).collect()
    assert {r.key: r.n for r in few} == {k: len(v) for k, v in buckets.items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 9)
    try:
        got = simhash._bucket_links(simhash.variants(df, crowd + 1), 4, crowd).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.key: r.n for r in got if r.key is not None} == {k: len(v) for k, v in buckets.items() if len(v) > crowd}
    want = set()
    for k, v in buckets.items():
        if len(v) <= crowd:
            want |= {(min(a, b), max(a, b)) for a in v for b in v if a != b and ((a ^ b) % 2**64).bit_count() <= 4}
    links = [(r.a, r.b) for r in got if r.key is None]
    assert len(links) == len(set(links)) and set(links) <= want
    if crowd == 64:
        rest = {k for k, v in buckets.items() if len(v) > crowd}
        missed = want - set(links)  # such a pair's first bucket is a crowded one
        assert all(any(a in buckets[k] and b in buckets[k] for k in rest) for a, b in missed)
