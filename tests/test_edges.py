"""Edge rows of the raster operators."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.functions import scalar as S
from tessella.operators import boxes as B
from tessella.operators import listing as L
from tessella.operators import metrics as M
from tessella.operators import packed as P
from tessella.operators import rasterops as R
from tessella.operators import resample as Z
from tessella.operators import tiling as T
from tessella.sources import images, sinks
from tessella.streaming import arrivals

FRAME = "image_id long, width int, height int"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_path_parts(spark):
    df = spark.createDataFrame([("a/b/x.tar.gz",), ("plain",), ("a/.hidden",), (None,)], "path string")
    got = {r.path: (r.name, r.stem, r.ext, r.moved) for r in L.path_parts(df).collect()}
    assert got["a/b/x.tar.gz"] == ("x.tar.gz", "x.tar", "gz", "out/x.tar.gz")
    assert got["plain"] == ("plain", "plain", "", "out/plain")
    assert got["a/.hidden"][:3] == (".hidden", ".hidden", "")
    assert got[None][:3] == (None, None, None)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_index_is_dense_for_any_partitioning(spark, parts):
    df = spark.range(101).select((F.col("id") * 37 % 101).alias("k")).repartition(parts)
    assert rows(L.indexed(df, "k"), "k", "idx") == [(i, i) for i in range(101)]


def test_index_of_nothing(spark):
    assert L.indexed(spark.range(0), "id").count() == 0


def test_split_sizes(spark):
    for n in (1, 5, 9, 32):
        got = dict(L.split_exact(spark.range(n).withColumnRenamed("id", "image_id")).groupBy("subset").count().collect())
        assert got.get("train", 0) == int(0.8 * n) and got.get("val", 0) == n - int(0.8 * n)


def test_short_last_batch(spark):
    got = dict(L.batch_assign(spark.range(70).withColumnRenamed("id", "image_id"), 32).groupBy("batch_id").count().collect())
    assert got == {0: 32, 1: 32, 2: 6}


def test_unequal_counts_give_no_pairs(spark):
    a = spark.createDataFrame([("1.jpg",), ("2.jpg",)], "path string")
    pairs, guard = L.guarded_pairs(a, a.limit(1), ["path"], ["path"])
    assert pairs.count() == 0 and guard.first().reason == "unequal_counts"
    pairs, guard = L.guarded_pairs(a, a, ["path"], ["path"])
    assert pairs.count() == 2 and guard.first().ok


def test_runs(spark):
    names = ["runs_2024-01-14", "runs_2024-01-17", "runs_2024-1-15", "runs", "runs_weights", "runs_2024-13-01", "runs_2024-02-30"]
    df = spark.createDataFrame([(n,) for n in names], "folder string")
    assert {r.folder for r in L.scan_runs(df).collect()} == {"runs_2024-01-14", "runs_2024-01-17", "runs_2024-1-15"}
    # Today scores 1, as do the day after tomorrow and none other; the smaller name wins.
    assert tuple(L.latest_run(df, "2024-01-15 12:00:00").first()) == ("runs_2024-01-17", 1)
    assert tuple(L.latest_run(df.union(spark.createDataFrame([("z_2024-01-16",)], "folder string")), "2024-01-15 12:00:00").first()) == ("z_2024-01-16", 0)


def test_boxes(spark):
    px = spark.createDataFrame([(1, 2, 3, 0), (1, 4, 7, 10), (2, 0, 0, 255)], "image_id long, y int, x int, v int")
    assert rows(B.mask_bbox(px, "dark"), "image_id", "x0", "y0", "x1", "y1") == [(1, 3, 2, 8, 5)]
    frames = spark.createDataFrame([(1, 10, 10), (2, 10, 10)], FRAME)
    assert rows(B.skip_empty_masks(frames, B.mask_bbox(px, "dark")), "image_id", "reason") == [(2, "no_foreground")]
    with pytest.raises(ValueError):
        B.mask_bbox(px, "other")


def test_extend_is_clamped_without_shifting(spark):
    box = spark.createDataFrame([(1, 20, 20, 0, 5, 3, 9), (2, 20, 20, 4, 4, 13, 13), (3, 8, 8, 2, 2, 4, 4)], "image_id long, width int, height int, x0 int, y0 int, x1 int, y1 int")
    got = rows(B.extend_box(box, 9), "image_id", "x0", "y0", "x1", "y1")
    assert got == [(1, 0, 3, 6, 12), (2, 4, 4, 13, 13), (3, 0, 0, 8, 8)]


def test_detections(spark):
    d = spark.createDataFrame([(1, -1.7, 0.2, 3.9, 4.0, 0.5), (1, 2.0, 2.0, 3.0, 3.0, 0.5), (1, 0.0, 0.0, 1.0, 1.0, 0.1)], "image_id long, x_min double, y_min double, x_max double, y_max double, conf double")
    frames = spark.createDataFrame([(1, 3, 3), (2, 3, 3)], FRAME)
    met = B.no_detection_filter(B.attach_detection(frames, d))
    assert rows(met, "image_id", "reason") == [(1, ""), (2, "no_detection")]
    cut = B.clamp_box(B.trunc_box(met.where("reason = ''")), F.col("width"), F.col("height"))
    assert rows(cut, "x_min", "y_min", "x_max", "y_max") == [(0, 0, 3, 3)]
    with pytest.raises(Exception, match="no detection for image 2"):
        B.no_detection_filter(B.attach_detection(frames, d), strict=True).collect()


def test_routing_at_the_limit(spark):
    df = spark.createDataFrame([(1, 3999, 3999), (2, 4000, 10), (3, 10, 4000)], FRAME)
    assert rows(T.route_by_size(df), "image_id", "route") == [(1, "direct"), (2, "tiled"), (3, "tiled")]


def test_steps_that_are_not_positive(spark):
    df = spark.createDataFrame([(1, 1000, 5000), (2, 900, 5000), (3, 5000, 5000)], FRAME)
    assert {r.image_id for r in T.tile_grid(df, 500).collect()} == {3}
    assert rows(T.bad_tile_steps(df, 500), "image_id") == [(1,), (2,)]


@settings(max_examples=8, deadline=None)
@given(st.integers(8, 30), st.integers(8, 30), st.integers(0, 3))
def test_tiles_cover_every_pixel(spark, h, w, overlap):
    frame = spark.createDataFrame([(1, w, h)], FRAME)
    grid = [tuple(r) for r in T.tile_grid(frame, overlap).select("y0", "x0", "y1", "x1").collect()]
    met = T.assign_tiles(T.frame_grid(frame), overlap)
    got = {(r.y, r.x, r.tile_y0, r.tile_x0) for r in met.collect()}
    assert got == {(y, x, a, b) for a, b, c, d in grid for y in range(a, c) for x in range(b, d)}
    assert len({(y, x) for y, x, _, _ in got}) == h * w


@pytest.mark.parametrize("kind", ["lanczos", "triangle", "linear"])
def test_weights_sum_to_one(spark, kind):
    sizes = spark.createDataFrame([(8, 5), (5, 8), (7, 7), (1, 3), (3, 1)], "n_src int, n_dst int")
    sums = Z.weights(sizes, kind).groupBy("n_src", "n_dst", "dst").agg(F.sum("w").alias("s")).collect()
    assert len(sums) == 5 + 8 + 7 + 3 + 1 and all(abs(r.s - 1) < 1e-9 for r in sums)


def test_fit_is_always_the_target_size(spark):
    boxes = spark.createDataFrame([(1, 30, 30, 0, 0, 20, 3), (2, 6, 6, 1, 1, 3, 3), (3, 30, 30, 5, 5, 14, 14)], "image_id long, width int, height int, x0 int, y0 int, x1 int, y1 int")
    px = T.frame_grid(boxes).select("image_id", "y", "x", ((F.col("y") * 7 + F.col("x")) % 200).alias("v"))
    for kind in ("nearest", "lanczos"):
        out = R.fit_to_target(px, boxes, 9, 255, kind)
        assert rows(out.groupBy("image_id").count(), "image_id", "count") == [(1, 81), (2, 81), (3, 81)]


def test_empty_union_and_missing_class(spark):
    scored = spark.createDataFrame([(1, 0, -1.0, 0), (1, 0, -2.0, 0)], "image_id long, batch_id long, logit double, target int")
    assert M.mean_iou(scored).first().iou == 0
    assert M.generalized_dice(scored).first().dice == 0
    assert M.generalized_dice(scored, classes=2).first().dice == 1
    c = M.accuracy_recall(M.confusion_counts(scored)).first()
    assert c.accuracy == 1 and c.recall is None


def test_mean_of_batch_means(spark):
    scored = spark.createDataFrame([(1, 0, 0.0, 1), (2, 0, 0.0, 1), (3, 1, 50.0, 0)], "image_id long, batch_id long, logit double, target int")
    assert abs(M.bce_loss(scored).first().loss - (np.log(2) + 50) / 2) < 1e-9


def test_bce_of_large_logits(spark):
    df = spark.createDataFrame([(1000.0, 1), (-1000.0, 0), (1000.0, 0)], "z double, t int").select(S.bce(F.col("z"), F.col("t")).alias("l"))
    assert [r.l for r in df.collect()] == [0, 0, 1000]


def packed_frames(spark):
    rng = np.random.default_rng(3)
    data = [(i, h, w, rng.integers(0, 256, (h, w), np.uint8)) for i, h, w in ((1, 13, 9), (2, 4, 4), (3, 8, 17))]
    df = spark.createDataFrame([(i, h, w, 1, bytearray(a.tobytes())) for i, h, w, a in data], "image_id long, height int, width int, channels int, data binary")
    return df, data


def test_packed_equals_long(spark):
    df, data = packed_frames(spark)
    tiles = P.cut_tiles(df, 4)
    long = P.to_pixels(tiles)
    assert rows(long, "image_id", "y", "x", "v") == sorted((i, y, x, int(a[y, x])) for i, h, w, a in data for y in range(h) for x in range(w))
    assert rows(P.mask_bbox(tiles, "bright"), "image_id", "x0", "y0", "x1", "y1") == rows(B.mask_bbox(long, "bright"), "image_id", "x0", "y0", "x1", "y1")
    assert rows(P.to_pixels(P.threshold(tiles)), "image_id", "y", "x", "v") == rows(long.withColumn("v", (F.col("v") >= 128).cast("int")), "image_id", "y", "x", "v")


def test_packed_focal_across_tile_edges(spark):
    df, _ = packed_frames(spark)
    k = np.arange(1, 10).reshape(3, 3) / 45
    tiles = P.cut_tiles(df, 4)
    got = rows(P.to_pixels(P.focal3(tiles, k, 4)), "image_id", "y", "x", "v")
    want = []
    for i, h, w, a in packed_frames(spark)[1]:
        pad = np.pad(a.astype(float), 1)
        out = sum(k[1 + dy, 1 + dx] * pad[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w] for dy in (-1, 0, 1) for dx in (-1, 0, 1))
        want += [(i, y, x, int(np.floor(np.round(out[y, x], 6) + 0.5))) for y in range(h) for x in range(w)]
    assert got == sorted(want)


def test_packed_merge_of_overlapping_tiles(spark):
    a, b = np.full((3, 5), 1, np.uint8), np.full((4, 3), 2, np.uint8)
    df = spark.createDataFrame([(1, 0, 0, 3, 5, bytearray(a.tobytes())), (1, 1, 3, 4, 3, bytearray(b.tobytes()))], "image_id long, y0 int, x0 int, height int, width int, data binary")
    got = {(r.y, r.x): r.v for r in P.to_pixels(P.merge_max(df, 4)).collect() if r.v}
    want = {(y, x): 1 for y in range(3) for x in range(5)} | {(y, x): 2 for y in range(1, 5) for x in range(3, 6)}
    assert got == want


@pytest.mark.parametrize("kind", ["lanczos", "triangle", "linear"])
def test_packed_resize_equals_long(spark, kind):
    """Shares of small tiles against the joins of the long form, growing and shrinking."""
    df, data = packed_frames(spark)
    sizes = spark.createDataFrame([(1, 13, 9, 5, 4), (2, 4, 4, 9, 7), (3, 8, 17, 8, 6)], "image_id long, height int, width int, out_h int, out_w int")
    long = P.to_pixels(P.cut_tiles(df, 4))
    want = rows(Z.resize(long, sizes, kind), "image_id", "y", "x", "v")
    for tile in (3, 512):
        assert rows(P.to_pixels(P.resize(P.cut_tiles(df, 4), sizes, kind, tile)), "image_id", "y", "x", "v") == want
    soft = {(r.image_id, r.y, r.x): r.v for r in Z.resample_join(long, sizes, kind).collect()}
    got = {(r.image_id, r.y, r.x): r.v for r in P.resample(P.cut_tiles(df, 4), sizes, kind, 3).collect()}
    assert got.keys() == soft.keys() and all(abs(got[k] - soft[k]) < 1e-9 for k in soft)


def test_packed_forms_of_tiles_crops_and_pastes(spark):
    df, data = packed_frames(spark)
    frames = spark.createDataFrame([(i, w, h) for i, h, w, _ in data], FRAME)
    tiles, long = P.cut_tiles(df, 4), P.to_pixels(P.cut_tiles(df, 4))
    assert rows(P.to_pixels(P.pack(long, tile=5)), "image_id", "y", "x", "v") == rows(long, "image_id", "y", "x", "v")
    cut = P.cut_overlapping(tiles, frames, 1)
    want = T.assign_tiles(long.join(frames, "image_id"), 1).select("image_id", "tile_y0", "tile_x0", "y", "x", "v")
    assert rows(cut.select("image_id", "y0", "x0", "height", "width"), "image_id", "y0", "x0") == sorted(want.select("image_id", "tile_y0", "tile_x0").distinct().collect())
    assert rows(P.to_pixels(cut), "image_id", "y", "x", "v") == rows(want, "image_id", "y", "x", "v")
    box = spark.createDataFrame([(1, 2, 3, 8, 12), (3, 0, 0, 17, 2)], "image_id long, x0 int, y0 int, x1 int, y1 int")
    cropped = P.crop(tiles, box)
    assert rows(P.to_pixels(cropped), "image_id", "y", "x", "v") == rows(B.crop_by_box(long, box), "image_id", "y", "x", "v")
    pasted = P.paste(cropped, box, frames, 5)
    assert rows(P.to_pixels(pasted), "image_id", "y", "x", "v") == rows(T.paste_to_frame(B.crop_by_box(long, box), box, frames), "image_id", "y", "x", "v")
    masks = P.threshold(tiles)
    shown = {(r.image_id, r.y, r.x): r.v for r in P.to_pixels(P.overlay_green(tiles, masks)).collect()}
    assert all(shown[r.image_id, r.y, r.x] == (min(255, r.v + 191) if r.v >= 128 else r.v) for r in long.collect())


def test_max_pool_of_odd_sides(spark):
    px = spark.createDataFrame([(1, y, x, 0, 10 * y + x) for y in range(5) for x in range(3)], "image_id long, y int, x int, c int, v int")
    assert rows(R.max_pool(px, 5, 3), "y", "x", "v") == [(0, 0, 11), (1, 0, 31)]


def test_every_frame_is_segmented_or_left_out(spark):
    from tessella.plans import segment

    frames = spark.createDataFrame([(i, 10, 10) for i in range(1, 6)], FRAME)
    d = [(1, 1.0, 1.0, 5.0, 6.0, 0.9), (2, -5.0, 2.0, -1.0, 4.0, 0.9), (3, 0.0, 0.0, 10.0, 3.0, 0.9), (4, 0.0, 0.0, 10.0, 10.0, 0.9)]
    detections = spark.createDataFrame(d, "image_id long, x_min double, y_min double, x_max double, y_max double, conf double")
    px = T.frame_grid(frames).select("image_id", "y", "x", ((F.col("y") + F.col("x")) % 3 * 100).cast("int").alias("v"))
    score = lambda p: p.withColumn("pred", (F.col("v") >= 128).cast("int"))
    masks, left_out = segment.segment_pipeline(px, frames, detections, score, limit=8, overlap=2)
    assert rows(left_out, "image_id", "reason") == [(2, "empty_box"), (3, "bad_tile_step"), (5, "no_detection")]
    assert rows(masks.groupBy("image_id").count(), "image_id", "count") == [(1, 100), (4, 100)]
    packed, again = segment.segment_tiles(P.pack(px, tile=4), frames, detections, lambda: lambda a: (a >= 128).astype(np.uint8), limit=8, overlap=2, tile=4)
    assert rows(again, "image_id", "reason") == rows(left_out, "image_id", "reason")
    assert rows(P.to_pixels(packed), "image_id", "y", "x", "v") == rows(masks, "image_id", "y", "x", "v")


def test_segmenting_files(spark, tmp_path):
    """From files to files with all three outputs; a broken file and one without a detection are reported."""
    from tessella.plans import segment

    rng = np.random.default_rng(4)
    photos = {i: rng.integers(0, 256, (12, 9, 3), np.uint8) for i in (1, 2)}
    df = spark.createDataFrame([(f"img_{i}", 12, 9, 3, bytearray(a.tobytes())) for i, a in photos.items()], "name string, height int, width int, channels int, data binary")
    sinks.write_png(df, str(tmp_path / "in"))
    (tmp_path / "in" / "img_3.png").write_bytes(b"\x89PNG broken")
    detections = spark.createDataFrame([(1, 2.0, 1.0, 8.0, 9.0, 0.7)], "image_id long, x_min double, y_min double, x_max double, y_max double, conf double")
    model = lambda: lambda a: (a >= 100).astype(np.uint8)
    left_out = segment.segment_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), detections, model, limit=100, overlap=1, overlays=True, side_by_side=True)
    assert {(r.image_id, r.reason) for r in left_out.collect()} == {(2, "no_detection"), (None, "undecodable")}
    p = photos[1].astype(int)
    mask = ((p @ [19595, 38470, 7471] + 32768) >> 16 >= 100).astype(np.uint8)
    mask[:1] = mask[9:] = mask[:, :2] = mask[:, 8:] = 0
    over = p.copy()
    over[mask == 1, 1] = np.minimum(over[mask == 1, 1] + 191, 255)
    want = {"masks": np.repeat(mask[:, :, None] * 255, 3, 2), "overlays": over, "side_by_side": np.concatenate([p, np.repeat(mask[:, :, None] * 255, 3, 2)], axis=1)}
    for name, a in want.items():
        r = images.decode_rgb(images.with_image_id(images.read_frames(spark, str(tmp_path / "out" / name)))).collect()
        assert [x.image_id for x in r] == [1] and bytes(r[0].data) == a.astype(np.uint8).tobytes()


def test_fit_against_newton_steps(spark, tmp_path):
    """Coefficients, losses of every epoch, and a saved model, against plain numpy."""
    from pyspark.ml.classification import LogisticRegressionModel

    from tessella.operators import model as Model

    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 2))
    y = (rng.random(600) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 1] + 0.3)))).astype(int)
    df = spark.createDataFrame([(int(i // 50), int(i // 200), float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "image_id long, batch_id long, a double, b double, target int")
    design, w = np.hstack([x, np.ones((600, 1))]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ w))
        w -= np.linalg.solve((design.T * (p * (1 - p))) @ design, design.T @ (p - y))
    saved = []
    last, report = Model.train_val_loop(df, df.drop("logit"), ["a", "b"], epochs=12, save=saved.append)
    got = {r.epoch: r for r in report.collect()}
    assert sorted(got) == list(range(1, 13)) and saved == [last]
    assert np.allclose([*last.coefficients, last.intercept], w, atol=1e-3)
    z = design @ w
    assert abs(got[12].train_loss - np.mean(np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - z * y)) < 1e-5
    assert abs(got[12].val_loss - got[12].train_loss) < 1e-5 and got[1].train_loss > got[12].train_loss
    path = sinks.sink_model(last, str(tmp_path / "model"), "2024-01-15")
    again = LogisticRegressionModel.load(path)
    assert again.coefficients == last.coefficients and again.intercept == last.intercept


def test_run_folders_on_storage(spark, tmp_path):
    for name in ("runs_2024-01-14", "runs_2024-01-17", "notes"):
        (tmp_path / "models" / name / "project").mkdir(parents=True)
        (tmp_path / "models" / name / "project" / "w.pt").write_bytes(b"x")
    found = images.scan_folders(spark, str(tmp_path / "models"))
    assert {r.folder for r in found.collect()} == {"runs_2024-01-14", "runs_2024-01-17", "notes"} and L.latest_run(found, "2024-01-15 12:00:00").first().folder == "runs_2024-01-17"


def test_png_round_trip_and_broken_files(spark, tmp_path):
    rgb = np.arange(5 * 3 * 3, dtype=np.uint8)
    gray = np.arange(6, dtype=np.uint8)
    df = spark.createDataFrame([("img_1", 5, 3, 3, bytearray(rgb.tobytes())), ("img_2", 2, 3, 1, bytearray(gray.tobytes()))], "name string, height int, width int, channels int, data binary")
    sinks.write_png(df, str(tmp_path / "out"))
    (tmp_path / "out" / "img_3.png").write_bytes(b"\x89PNG broken")
    good, bad = images.split_frames(images.read_frames(spark, str(tmp_path / "out")))
    assert bad.count() == 1
    got = {r.image_id: bytes(r.data) for r in images.decode_rgb(images.with_image_id(good)).collect()}
    assert got == {1: rgb.tobytes(), 2: np.repeat(gray, 3).tobytes()}
    assert {r.path.rsplit("/", 1)[1] for r in images.scan_recursive(spark, str(tmp_path), "*.png").collect()} == {"img_1.png", "img_2.png", "img_3.png"}
    assert images.scan_multi_ext(spark, str(tmp_path / "out")).where("ext_rank = 2").count() == 3


def test_split_directories(spark, tmp_path):
    for d in ("train", "train_masks", "test", "test_masks"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "a.png").write_bytes(b"x")
    got = images.scan_split_dirs(spark, str(tmp_path))
    assert rows(got, "split", "role") == [("train", "image"), ("train", "mask")]


def test_metrics_sink_appends(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, 0.25), (2, 0.125, 0.1)], "epoch int, train_loss double, val_loss double")
    for _ in range(2):
        sinks.sink_metrics(df, str(tmp_path / "m"))
    assert sinks.read_metrics(spark, str(tmp_path / "m"), "epoch int, train_loss double, val_loss double").count() == 4
    assert [r.line for r in sinks.metric_lines(df).orderBy("epoch").collect()][0] == "1\t0.5000\t0.2500"


def test_arriving_files_are_taken_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.png").write_bytes(b"1")
    run = lambda: arrivals.run_to_end(arrivals.arriving_files(spark, str(tmp_path / "in")).select("path", "length"), str(tmp_path / "out"), str(tmp_path / "cp"))
    run()
    (tmp_path / "in" / "b.png").write_bytes(b"22")
    run()
    assert sorted(r.length for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_planes_are_ordered(spark):
    px = spark.createDataFrame([(1, 0, 1, 0, 255), (1, 0, 0, 1, 51), (1, 0, 0, 0, 0)], "image_id long, y int, x int, c int, v int")
    assert [round(x, 4) for x in R.planes(px).first().plane] == [0, 1, 0.2]
