"""Plans that hold at size: pixels travel as chunks, no group of them is a Python call of its own, and none is broadcast."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella import queries as Q
from tessella.functions import scalar as S
from tessella.operators import chunks as C
from tessella.operators import packed as P
from tessella.operators import runs as Runs

DATA = "/root/testdata/sf0.001"
#: Queries, by finding, whose plans must have neither a Python call for each group nor a pixel table that is broadcast.
PLANS = ["mask_runs", "merge_runs", "overlay_mask", "to_unit_scale", "center_pad", "compose_frame_mask", "fit_to_target", "paste_to_frame", "crop_by_box", "side_by_side", "merge_tiles_max_packed", "decode_gray", "channel_mix", "segment_pipeline", "segment_pipeline_packed"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def broadcast_pixels(text):
    """Whether a table is broadcast whose rows are pixels: exploded, and not grouped again."""
    depth = None
    for line in text.splitlines():
        at = len(line) - len(line.lstrip(" :+-|"))
        if depth is not None and (at <= depth or "HashAggregate" in line):
            depth = None
        if "BroadcastExchange" in line:
            depth = at
        elif depth is not None and ("Generate explode" in line or "MapInArrow" in line):
            return True
    return False


@pytest.mark.parametrize("name", PLANS)
def test_no_group_alone_and_no_broadcast(spark, name):
    text = plan(Q.queries()[name](spark, DATA))
    assert "FlatMapGroupsInArrow" not in text and not broadcast_pixels(text)
    assert not re.search(r"hashpartitioning\(image_id#\w+, y#", text)  # pixels dealt by place, one by one


def test_a_small_file_is_dealt_out(spark):
    """One row group of a table is hundreds of times as many pixels."""
    made = Q.fixture(spark, DATA, "mask_pixels")
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_chunks_hold_any_rows(spark):
    """Unsorted rows, wide and narrow values, reals and nulls come back, each with its key."""
    given = [(i * 7919 % 13, i * 31 % 97 - 40, None if i % 11 == 0 else i * 70_001, i / 8) for i in range(5000)]
    rows = spark.createDataFrame(given, "k long, a int, b long, r double").repartition(3)

    def back(groups, sides):
        f = sides[0]
        yield pa.RecordBatch.from_arrays([C.array(groups[0][f.g], pa.int64()), C.array(f.columns[0], pa.int32()), C.array(f.columns[1], pa.int64()), C.array(f.columns[2], pa.float64())], ["k", "a", "b", "r"])

    out = C.gathered([C.chunked(rows, ["k"], ["a", "b", "r"])], back, "k long, a int, b long, r double").collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, given))


def test_pack_of_scattered_pixels(spark):
    """Places in any order, over several cells of the dealing grid, with tiles that don't divide it."""
    rng = np.random.default_rng(4)
    places = {(int(i), int(y), int(x)): int(v) for i, y, x, v in zip(rng.integers(0, 3, 900), rng.integers(0, 1100, 900), rng.integers(0, 1100, 900), rng.integers(1, 256, 900), strict=True)}
    rows = spark.createDataFrame([(*k, v) for k, v in places.items()], "image_id long, y int, x int, v int").repartition(4)
    for tile in (7, 512):
        out = P.pack(rows, tile=tile)
        assert out.where(f"y0 % {tile} <> 0 OR x0 % {tile} <> 0 OR height > {tile} OR width > {tile}").count() == 0
        assert {(r.image_id, r.y, r.x): r.v for r in P.to_pixels(out).where("v <> 0").collect()} == places


def test_runs_of_many_rows_are_swept_apart(spark, monkeypatch):
    """Rows that are swept together keep their own stretches, empty ones between them."""
    monkeypatch.setattr(Runs, "SWEPT", 4)
    rows = spark.sql("SELECT id AS image_id, 0 AS band, CASE WHEN id % 3 = 0 THEN array() ELSE array(named_struct('y', 1, 'x0', 2, 'x1', 5), named_struct('y', 1, 'x0', 5, 'x1', 7 + int(id))) END AS runs FROM range(20)")
    rows = rows.withColumn("runs", F.col("runs").cast(Runs._RUNS)).coalesce(1)
    got = {r.image_id: [tuple(x) for x in r.runs] for r in Runs.merged(rows).collect()}
    assert got == {i: [] if i % 3 == 0 else [(1, 2, 7 + i)] for i in range(20)}


def test_rounded_units_of_any_value(spark):
    """Every byte and what isn't one: as the rounding of the quotient."""
    rows = spark.sql("SELECT cast(id - 300 AS int) AS v FROM range(900) UNION ALL SELECT NULL")
    assert rows.select(S.unit_scale_rounded(F.col("v")).alias("a"), F.round(S.unit_scale(F.col("v")), 6).alias("b")).where("NOT a <=> b").count() == 0


def test_a_place_met_twice(spark):
    """The join of places: each pair of equal places once, places of one side only never, over edges of cells and below 0."""
    left = [(1, y, x, c, 10 * c) for y in (-1, 0, 511, 512) for x in (0, 700) for c in (0, 1)] + [(2, 0, 0, 0, 1)]
    right = [(1, y, x, y + x) for y in (-1, 511, 512, 513) for x in (0, 700)] + [(1, 512, 700, 5), (3, 0, 0, 1)]
    a, b = spark.createDataFrame(left, "image_id long, y int, x int, c int, v int").repartition(3), spark.createDataFrame(right, "image_id long, y int, x int, m int").repartition(2)
    want = a.join(b, ["image_id", "y", "x"])
    got = C.met(a, b, "m")
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())


def test_canvases_over_several_cells(spark):
    """A box's pixels on a canvas of three cells a side; nulls and what falls outside leave the fill."""
    pixels = [(1, y, x, None if (y, x) == (2, 2) else y * 7 + x + 1) for y in range(5) for x in range(6)]
    rows = spark.createDataFrame(pixels, "image_id long, y int, x int, v int")
    boxes = spark.createDataFrame([(1, 1, 1, 5, 4, 9, 17)], "image_id long, x0 int, y0 int, x1 int, y1 int, dy int, dx int")
    frames = spark.createDataFrame([(1, 12, 20), (2, 3, 4), (4, 0, 4)], "image_id long, height int, width int")
    got = {(r.image_id, r.y, r.x): r.v for r in C.placed(rows, boxes, frames, "v", 255, cell=8).collect()}
    want = {(i, y, x): 255 for i, h, w in ((1, 12, 20), (2, 3, 4)) for y in range(h) for x in range(w)}
    want |= {(1, y + 9, x + 17): v for _, y, x, v in pixels if v is not None and 1 <= y < 4 and 1 <= x < 5 and y + 9 < 12 and x + 17 < 20}
    assert got == want


def test_small_files_share_tasks(spark, tmp_path):
    """A file counts as 4 MB where tasks are made up, so that hundreds of small ones were a task for every four."""
    from tessella.sources import images

    for i in range(300):
        (tmp_path / f"{i}.png").write_bytes(b"x")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        for rows in (images.scan_files(spark, str(tmp_path)), images.read_frames(spark, str(tmp_path))):
            assert rows.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
            assert rows.select("path").distinct().count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
