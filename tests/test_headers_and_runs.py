"""Image headers and masks as runs: odd files and random masks against plain numpy."""

import io
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import packed as P
from tessella.operators import runs as R
from tessella.sources import headers, sinks


def jpeg(height, width, channels=3, frame=0xC2):
    """Heads of a JPEG file: a long EXIF segment, tables, a restart marker's fill byte, then the frame."""
    exif = b"\xff\xe1" + struct.pack(">H", 60_002) + b"\x00" * 60_000
    table = b"\xff\xc4" + struct.pack(">H", 4) + b"\x01\x02"
    return b"\xff\xd8" + exif + table + b"\xff" + bytes([0xFF, frame]) + struct.pack(">HBHHB", 8 + 3 * channels, 8, height, width, channels) + b"\x00" * 9


FILES = {
    "a.png": sinks.png(bytes(12), 2, 2, 3),
    "gray.png": sinks.png(bytes(6), 3, 2, 1),
    "pixels broken.png": sinks.png(bytes(6), 2, 3, 1)[:45],
    "head broken.png": sinks.png(bytes(6), 2, 3, 1)[:20],
    "zero.png": b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">IIBBBBB", 0, 5, 8, 2, 0, 0, 0) + b"    ",
    "below/b.jpg": jpeg(4000, 6000),
    "below/base.jpeg": jpeg(7, 9, 1, 0xC0),
    "cut.jpg": jpeg(4, 6)[:300],
    "empty.png": b"",
    "text.png": b"no image at all, but long enough for a header",
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("frames")
    for name, data in FILES.items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(data)
    return str(root)


EXPECTED = {
    "a.png": ("png", 2, 2, 3, None),
    "gray.png": ("png", 3, 2, 1, None),
    "pixels broken.png": ("png", 2, 3, 1, None),
    "head broken.png": ("png", None, None, None, "truncated"),
    "zero.png": ("png", None, None, None, "malformed"),
    "b.jpg": ("jpeg", 4000, 6000, 3, None),
    "base.jpeg": ("jpeg", 7, 9, 1, None),
    "cut.jpg": ("jpeg", None, None, None, "truncated"),
    "text.png": (None, None, None, None, "unknown"),
}


def test_headers_of_all_kinds(spark, folder):
    got = {r.path.rpartition("/")[2].replace("%20", " "): (r.kind, r.height, r.width, r.channels, r.reason) for r in headers.scan_frame_sizes(spark, folder, recursive=True).collect()}
    assert got == EXPECTED  # the files whose pixels are broken or missing have sizes: nothing was decoded
    assert headers.header(io.BytesIO()) == {"reason": "empty"}  # Spark's listing leaves out empty files
    flat = headers.scan_frame_sizes(spark, folder, "*.jpg")
    assert [r.reason for r in flat.collect()] == ["truncated"]


def test_headers_from_contents(spark, folder):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    got = headers.with_sizes(files, content_col="content")
    assert {r.path.rpartition("/")[2].replace("%20", " "): (r.kind, r.height, r.width, r.channels, r.reason) for r in got.collect()} == EXPECTED
    assert "content" not in got.columns


def test_sizes_are_read_only_where_used(spark, folder):
    found = headers.scan_frame_sizes(spark, folder, recursive=True)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan(found.select("path", "length"))
    assert "content" not in plan(found).split("ReadSchema")[-1]
    small = found.where("length < 100").select("path", "height")
    assert "LessThan(length,100)" in plan(small) and small.count() == 6


def test_missing_file_is_a_reason(spark, folder):
    gone = spark.createDataFrame([(f"file:{folder}/none.png",), (f"file:{folder}/a.png",)], "path string")
    reasons = sorted(str(r.reason) for r in headers.with_sizes(gone).collect())
    assert reasons[0] == "None" and reasons[1].startswith("unreadable")


# --- runs ---

SHAPE = (1100, 23)


def masks(seed, n=3):
    rng = np.random.default_rng(seed)
    out = {i: (rng.random(SHAPE) < rng.choice([0.05, 0.5, 0.95])).astype(np.uint8) for i in range(n)}
    out[n] = np.zeros(SHAPE, np.uint8)
    out[n + 1] = np.ones(SHAPE, np.uint8)
    return out


def tiles(spark, given, side=200):
    rows = [(i, y, x, *a[y : y + side, x : x + side].shape, a[y : y + side, x : x + side].tobytes()) for i, a in given.items() for y in range(0, SHAPE[0], side) for x in range(0, SHAPE[1], side)]
    return spark.createDataFrame([(i, y, x, h, w, bytearray(d)) for i, y, x, h, w, d in rows], "image_id long, y0 int, x0 int, height int, width int, data binary")


def islands(a):
    out = []
    for y in range(a.shape[0]):
        on = np.flatnonzero(np.diff(np.concatenate([[0], a[y].astype(np.int8), [0]])))
        out += [(y, int(b), int(e)) for b, e in zip(on[::2], on[1::2], strict=True)]
    return out


def back(rows, shape=SHAPE):
    """Images from runs, which must be maximal, in order and in their band."""
    out = {}
    for r in rows.collect():
        a = out.setdefault(r.image_id, np.zeros(shape, np.uint8))
        assert [tuple(x) for x in r.runs] == sorted(tuple(x) for x in r.runs) and r.runs
        for y, x0, x1 in r.runs:
            assert y // R.BAND == r.band and x0 < x1 and not a[y, max(0, x0 - 1) : x1 + 1].any()
            a[y, x0:x1] = 1
    return out


def same(got, want):
    return set(got) == {i for i, a in want.items() if a.any()} and all((a == want[i]).all() for i, a in got.items())


@pytest.fixture(scope="module")
def pair(spark):
    a, b = masks(1), masks(2)
    return a, b, R.from_tiles(tiles(spark, a)).cache(), R.from_tiles(tiles(spark, b, 11)).cache()


def test_runs_of_tiles_and_pixels(spark, pair):
    a, _, runs, _ = pair
    assert same(back(runs), a)
    pixels = P.to_pixels(tiles(spark, a))
    assert same(back(R.from_pixels(pixels, F.col("v") == 1)), a)
    assert sorted((r.image_id, r.y, r.x0, r.x1) for r in R.listed(runs).collect()) == sorted((i, *k) for i, m in a.items() for k in islands(m))
    assert same(back(R.from_tiles(R.to_tiles(runs))), a)
    twice = R.from_tiles(tiles(spark, a).unionByName(tiles(spark, a, 77)))
    assert same(back(twice), a)
    assert R.from_tiles(tiles(spark, a).limit(0)).count() == 0


def test_areas_and_boxes(pair):
    a, _, runs, _ = pair
    assert {r.image_id: r.area for r in R.areas(runs).collect()} == {i: int(m.sum()) for i, m in a.items() if m.any()}
    for r in R.boxes(runs).collect():
        y, x = np.nonzero(a[r.image_id])
        assert (r.y0, r.y1, r.x0, r.x1) == (y.min(), y.max() + 1, x.min(), x.max() + 1)


def test_set_operations(pair):
    a, b, left, right = pair
    right = right.where("image_id <> 2")
    b = {i: m * (i != 2) for i, m in b.items()}
    assert same(back(R.union(left, right)), {i: a[i] | b[i] for i in a})
    assert same(back(R.intersection(left, right)), {i: a[i] & b[i] for i in a})
    assert same(back(R.difference(left, right)), {i: a[i] & (1 - b[i]) for i in a})
    for r in R.overlap_counts(left, right).collect():
        x, y = a[r.image_id].astype(bool), b[r.image_id].astype(bool)
        assert (r.tp, r.fp, r.fn) == ((x & y).sum(), (x & ~y).sum(), (~x & y).sum())


@pytest.mark.parametrize(("dy", "dx"), [(0, 0), (1, 2), (512, 0), (700, 5), (-3, -4)])
def test_shift_and_clip(pair, dy, dx):
    a, _, runs, _ = pair
    big = (SHAPE[0] + 800, SHAPE[1] + 9)
    moved = R.shift(runs, F.lit(dy), F.lit(dx))
    frames = runs.select("image_id").distinct().selectExpr("image_id", "0 AS x0", "5 AS y0", "21 AS x1", "1500 AS y1")
    want = {}
    for i, m in a.items():
        out = np.zeros(big, np.uint8)
        y, x = np.nonzero(m)
        keep = (y + dy >= 5) & (y + dy < 1500) & (x + dx >= 0) & (x + dx < 21)
        out[y[keep] + dy, x[keep] + dx] = 1
        want[i] = out
    assert same(back(R.clip(moved, frames), big), want)


def test_runs_shuffle_less_than_tiles(spark, pair):
    """Bytes of a round mask as runs and as a packed tile."""
    y, x = np.indices((400, 400))
    disc = ((y - 200) ** 2 + (x - 200) ** 2 < 150**2).astype(np.uint8)
    assert len(islands(disc)) * 12 < disc.size / 30
