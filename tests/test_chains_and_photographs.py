"""Stencil chains at tile edges, and plans from files to files, against plain numpy."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import fit, stencil
from tessella.plans import photographs, segment
from tessella.sources import images, sinks

RNG = np.random.default_rng(7)
K = [(dy, dx, a, b, float(RNG.integers(-4, 5)) / 4) for dy in (-1, 0, 1) for dx in (-1, 0, 1) for a in range(2) for b in range(3)]
UP = [(dy, dx, a, b, float(RNG.integers(-4, 5)) / 4) for dy in (0, 1) for dx in (0, 1) for a in range(3) for b in range(2)]
MIX = [(a, b, float(RNG.integers(-4, 5)) / 4) for a in range(2) for b in range(2)]


def by_hand(kind, a):
    h, w, _ = a.shape
    if kind == "relu":
        return np.maximum(a, 0)
    if kind == "pool":
        return a[: h // 2 * 2, : w // 2 * 2].reshape(h // 2, 2, w // 2, 2, a.shape[2]).max(axis=(1, 3))
    if kind == "mix":
        out = np.zeros((h, w, 2)) + [1.0, -1.0]
        for i, o, v in MIX:
            out[:, :, o] += a[:, :, i] * v
        return out
    if kind == "up":
        out = np.zeros((2 * h, 2 * w, 2)) + [0.5, 0.25]
        for dy, dx, i, o, v in UP:
            out[dy::2, dx::2, o] += a[:, :, i] * v
        return out
    pad = np.zeros((h + 2, w + 2, a.shape[2]))
    pad[1:-1, 1:-1] = a
    out = np.zeros((h, w, 3)) + [1.0, 0.0, -2.0]
    for dy, dx, i, o, v in K:
        out[:, :, o] += pad[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w, i] * v
    return out


STEPS = {"conv": stencil.conv3(K, [1.0, 0.0, -2.0]), "relu": stencil.relu(), "pool": stencil.pool2(), "up": stencil.upsample2(UP, [0.5, 0.25]), "mix": stencil.mix(MIX, [1.0, -1.0])}
CHAINS = [("conv",), ("pool",), ("up",), ("mix",), ("conv", "relu", "pool", "up", "conv"), ("conv", "up", "conv", "up", "mix"), ("conv", "pool", "pool", "up", "conv", "relu", "up"), ("mix", "conv", "up", "pool", "mix", "conv")]


def tiles_of(spark, frames, side):
    rows = []
    for i, a in frames.items():
        for y in range(0, a.shape[0], side):
            for x in range(0, a.shape[1], side):
                part = np.ascontiguousarray(a[y : y + side, x : x + side])
                rows.append((i, y, x, *part.shape[:2], bytearray(part.tobytes()), *a.shape[:2]))
    return spark.createDataFrame(rows, "image_id long, y0 int, x0 int, height int, width int, data binary, frame_h int, frame_w int")


@pytest.mark.parametrize("names", CHAINS)
def test_chains_at_tile_edges(spark, names):
    planes = 3 if names[0] == "up" else 2
    frames = {i: RNG.integers(0, 256, (h, w, planes), np.uint8) for i, (h, w) in enumerate([(13, 9), (8, 8), (5, 17), (1, 1)])}
    for side, tile in ((4, 4), (7, 3)):
        got = {}
        for r in stencil.stencil_chain(tiles_of(spark, frames, side), [STEPS[n] for n in names], tile).collect():
            got[r.image_id, r.y0, r.x0] = np.frombuffer(bytes(r["values"])).reshape(r.height, r.width, r.planes)
        for i, a in frames.items():
            want = a.astype(float)
            for n in names:
                want = by_hand(n, want)
            own = {k[1:]: v for k, v in got.items() if k[0] == i}
            assert set(own) == {(y, x) for y in range(0, want.shape[0], tile) for x in range(0, want.shape[1], tile)}
            for (y, x), v in own.items():
                assert v.shape == want[y : y + tile, x : x + tile].shape
                assert np.allclose(v, want[y : y + tile, x : x + tile], atol=1e-9)


def test_one_exchange_for_a_chain(spark, tmp_path):
    frames = {1: RNG.integers(0, 256, (40, 40, 2), np.uint8)}
    tiles_of(spark, frames, 16).write.parquet(str(tmp_path / "t"))
    out = stencil.stencil_chain(spark.read.parquet(str(tmp_path / "t")), [STEPS[n] for n in ("conv", "relu", "pool", "up", "conv")], 16)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert stencil.halo([STEPS["conv"], STEPS["conv"]]) == 2 and stencil.halo([STEPS["conv"], STEPS["pool"], STEPS["conv"]]) == 3 and stencil.halo([STEPS["mix"]]) == 0


# --- files ---


def jpegs(spark, folder, photos):
    """Photographs as JPEG files by Java's own writer."""
    jvm = spark._jvm
    os.makedirs(folder, exist_ok=True)
    for name, a in photos.items():
        picture = jvm.java.awt.image.BufferedImage(a.shape[1], a.shape[0], 1)
        for y in range(a.shape[0]):
            for x in range(a.shape[1]):
                r, g, b = (int(v) for v in a[y, x])
                picture.setRGB(x, y, (r << 16 | g << 8 | b))
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        assert jvm.javax.imageio.ImageIO.write(picture, "jpg", jvm.java.io.File(path))


def decoded(spark, folder, pattern="*.png"):
    rows = images.decode_rgb(images.split_frames(images.read_frames(spark, folder, pattern, recursive=True))[0]).collect()
    return {os.path.relpath(r.path.removeprefix("file:").replace("///", "/").replace("%20", " "), folder): np.frombuffer(bytes(r.data), np.uint8).reshape(r.height, r.width, 3) for r in rows}


def test_photographs_in_folders_with_odd_names(spark, tmp_path, monkeypatch):
    """Equal digits, no digits, equal stems in two folders, two suffixes and a broken file; a model of colours; one decode a file."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    names = ["a/IMG_2024_001.jpg", "a/IMG_2024_002.jpg", "b/photo.jpg", "c d/photo.jpg", "c d/photo+.jpg", "none.jpg"]
    photos = {n: RNG.integers(0, 256, (21 + i, 18, 3), np.uint8) for i, n in enumerate(names)}
    jpegs(spark, src, photos)
    (tmp_path / "in" / "broken.jpg").write_bytes(b"\xff\xd8\xff\xe0 broken")
    shown = decoded(spark, src, "*.jpg")  # what the codec made of them
    boxes = [(n.removesuffix(".jpg"), 2.0, 1.0, 15.0, 20.0, 0.9) for n in names[:-1]] + [("broken", 0.0, 0.0, 3.0, 3.0, 0.5)]
    detections = spark.createDataFrame(boxes, "name string, x_min double, y_min double, x_max double, y_max double, conf double")
    calls = []
    plain = images.read_frames
    monkeypatch.setattr(images, "read_frames", lambda *a, **k: calls.append(a) or plain(*a, **k))
    model = lambda: lambda a: (a[:, :, 0].astype(int) > a[:, :, 2]).astype(np.uint8)
    left = segment.segment_files(spark, src, out, detections, model, limit=12, overlap=2, pattern="*.jpg", overlays=True, side_by_side=True, recursive=True, colour=True)
    assert len(calls) == 1
    monkeypatch.undo()
    (tmp_path / "in").rename(tmp_path / "gone")  # nothing is read from the photographs any more
    assert {(os.path.basename(r.path), r.reason) for r in left.collect()} == {("none.jpg", "no_detection"), ("broken.jpg", "undecodable")}
    for kind in ("masks", "overlays", "side_by_side"):
        got = decoded(spark, f"{out}/{kind}")
        assert set(got) == {n.removesuffix(".jpg") + ".png" for n in names[:-1]}
        for n in names[:-1]:
            p = shown.get(n) if n in shown else shown[n.replace("+", "%2B")]
            mask = np.zeros(p.shape[:2], np.uint8)
            mask[1:20, 2:15] = (p[:, :, 0].astype(int) > p[:, :, 2])[1:20, 2:15]
            white = np.repeat(mask[:, :, None] * 255, 3, 2)
            over = p.astype(int)
            over[mask == 1, 1] = np.minimum(over[mask == 1, 1] + 191, 255)
            want = {"masks": white, "overlays": over, "side_by_side": np.concatenate([p, white], axis=1)}[kind]
            assert (got[n.removesuffix(".jpg") + ".png"] == want).all()


def test_same_digits_are_set_aside(spark, tmp_path):
    df = spark.createDataFrame([(n, 4, 4, 1, bytearray(16)) for n in ("x7", "y7", "z8", "w")], "name string, height int, width int, channels int, data binary")
    sinks.write_png(df, str(tmp_path / "in"))
    boxes = spark.createDataFrame([(7, 0.0, 0.0, 4.0, 4.0, 0.5), (8, 0.0, 0.0, 4.0, 4.0, 0.5)], "image_id long, x_min double, y_min double, x_max double, y_max double, conf double")
    left = segment.segment_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), boxes, lambda: lambda a: (a == 0).astype(np.uint8), limit=9, overlap=1)
    assert sorted((r.image_id or 0, r.reason) for r in left.collect()) == [(0, "no_detection"), (7, "same_digits"), (7, "same_digits")]
    assert set(decoded(spark, str(tmp_path / "out" / "masks"))) == {"z8.png"}


def lanczos(n_src, n_dst):
    first, w = fit.line_weights(n_src, n_dst, "lanczos", 0, n_src)
    out = np.zeros((n_dst, n_src))
    out[first : first + len(w)] = w
    return out


@pytest.mark.parametrize("tile", [5, 512])
def test_preparing_pairs(spark, tmp_path, tile):
    target, given = 10, str(tmp_path)
    photo = lambda h, w: RNG.integers(0, 256, (h, w, 3), np.uint8)

    def mask(h, w, box):
        m = np.full((h, w), 255, np.uint8)
        y0, y1, x0, x1 = box
        m[y0:y1, x0:x1] = RNG.integers(0, 255, (y1 - y0, x1 - x0), np.uint8)
        return m

    pairs = {"small": (photo(20, 22), mask(20, 22, (3, 8, 4, 9))), "edge": (photo(12, 12), mask(12, 12, (0, 4, 9, 12))), "wide": (photo(30, 17), mask(30, 17, (2, 25, 3, 8))), "tiny": (photo(4, 5), mask(4, 5, (1, 3, 1, 4)))}
    rows = [(f"images/{n}", *a.shape, bytearray(a.tobytes())) for n, (a, _) in pairs.items()] + [(f"masks/{n}", *m.shape, 1, bytearray(m.tobytes())) for n, (_, m) in pairs.items()]
    rows += [("images/alone", 2, 2, 1, bytearray(4)), ("masks/lone", 2, 2, 1, bytearray(4)), ("images/uneven", 2, 2, 1, bytearray(4)), ("masks/uneven", 2, 3, 1, bytearray(6)), ("images/blank", 3, 3, 1, bytearray(9)), ("masks/blank", 3, 3, 1, bytearray(b"\xff" * 9)), ("images/bad", 3, 3, 1, bytearray(9)), ("images/torn", 3, 3, 1, bytearray(9))]
    sinks.write_png(spark.createDataFrame(rows, "name string, height int, width int, channels int, data binary"), given)
    (tmp_path / "masks" / "bad.png").write_bytes(b"no picture, whatever its name says it is")
    (tmp_path / "masks" / "torn.png").write_bytes(sinks.png(bytes(9), 3, 3, 1)[:44])
    rejected = photographs.prepare_files(spark, f"{given}/images", f"{given}/masks", f"{given}/out", target, tile=tile)
    assert {(r.name, r.reason) for r in rejected.collect()} == {("alone", "no_mask"), ("lone", "no_image"), ("uneven", "size_mismatch"), ("blank", "no_foreground"), ("bad", "undecodable"), ("torn", "undecodable")}
    got = {side: decoded(spark, f"{given}/out/{side}") for side in ("images", "masks")}
    assert set(got["images"]) == set(got["masks"]) == {f"{n}.png" for n in pairs}
    for n, (a, m) in pairs.items():
        y, x = np.nonzero(m != 255)
        y0, y1, x0, x1 = y.min(), y.max() + 1, x.min(), x.max() + 1
        if max(y1 - y0, x1 - x0) > target:
            down, across = lanczos(y1 - y0, target), lanczos(x1 - x0, target)
            want = np.clip(np.floor(np.round(np.einsum("ys,sxp,tx->ytp", down, a[y0:y1, x0:x1].astype(float), across), 6) + 0.5), 0, 255)
            rows_, columns = (((2 * np.arange(target) + 1) * k // (2 * target)) for k in (y1 - y0, x1 - x0))
            want_mask = m[y0:y1, x0:x1][np.ix_(rows_, columns)]
        else:
            grow = lambda a, b, side: (max(0, a - (target - (b - a)) // 2), min(side, b + (target - (b - a)) - (target - (b - a)) // 2))
            (y0, y1), (x0, x1) = grow(y0, y1, a.shape[0]), grow(x0, x1, a.shape[1])
            top, left = (target - (y1 - y0)) // 2, (target - (x1 - x0)) // 2
            want, want_mask = np.zeros((target, target, 3)), np.full((target, target), 255)
            want[top : top + y1 - y0, left : left + x1 - x0] = a[y0:y1, x0:x1]
            want_mask[top : top + y1 - y0, left : left + x1 - x0] = m[y0:y1, x0:x1]
        assert (got["images"][f"{n}.png"] == want).all() and (got["masks"][f"{n}.png"][:, :, 0] == want_mask).all()
