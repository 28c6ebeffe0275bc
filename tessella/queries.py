"""The registered queries over the derived fixtures, each with the SQL that an independent engine runs for it.

Reals are rounded alike on both sides, since sums of doubles depend on the order."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import session
from .fixtures import fixture, with_fixtures
from .functions import scalar as S
from .operators import boxes as B
from .operators import listing as L
from .operators import metrics as M
from .operators import model as Model
from .operators import packed as P
from .operators import rasterops as R
from .operators import resample as Z
from .operators import runs as Runs
from .operators import stencil as St
from .operators import tiling as T
from .plans import photographs, segment
from .sources import headers, images, sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}
NOW = "2024-01-15 12:00:00"
BATCH = 32


def _query(oracle: str | None = None, *fixtures: str, name: str | None = None):
    """Register a function of fixtures (by parameter order) under its name; with ``fixtures`` given it takes them as frames."""

    def register(f):
        key = name or f.__name__
        _QUERIES[key] = (lambda spark, sf_dir: f(*[fixture(spark, sf_dir, n) for n in fixtures])) if fixtures else f
        if oracle is not None:
            _ORACLE[key] = with_fixtures(oracle, *fixtures)
        return f

    return register


# --- scans and listings ---

_EXT = "regexp_extract(path, '\\.([^./]*)$', 1)"
_STEM = "regexp_extract(path, '([^/]*)\\.[^./]*$', 1)"
_RANK = f"CAST(list_position(['jpg', 'png', 'jpeg'], {_EXT}) AS INTEGER)"


def _files(paths) -> str:
    """A folder of shared storage with a file at every path."""
    root = session.shared_path(paths.sparkSession, "files")
    sinks.write_files(paths.select(F.col("path").alias("name"), F.col("path").cast("binary").alias("data")), root)
    return root


def _short(found, *others: str):
    """Listed files with their path below the written folder."""
    return found.select(*others, F.regexp_extract("path", "/(data/[^/]+/[^/]+)$", 1).alias("path"))


@_query(f"SELECT path FROM paths WHERE role = 'image' AND {_EXT} = 'jpg'", "paths")
def scan_recursive(paths):
    return _short(images.scan_recursive(paths.sparkSession, f"{_files(paths)}/data", "*.jpg")).orderBy("path")


@_query(f"SELECT {_RANK} AS ext_rank, path FROM paths WHERE role = 'image' AND split = 'train' AND {_EXT} IN ('jpg', 'png', 'jpeg')", "paths")
def scan_multi_ext(paths):
    found = images.scan_multi_ext(paths.sparkSession, f"{_files(paths.where("split = 'train'"))}/data/train")
    return _short(found, "ext_rank").orderBy("ext_rank", "path")


@_query("SELECT path FROM paths WHERE role = 'mask' AND split = 'train' AND path LIKE '%.png'", "paths")
def scan_masks(paths):
    return _short(images.scan_masks(paths.sparkSession, f"{_files(paths)}/data/train_masks")).orderBy("path")


@_query("SELECT split, role, path FROM paths WHERE split = 'train'", "paths")
def scan_split_dirs(paths):
    return _short(images.scan_split_dirs(paths.sparkSession, f"{_files(paths)}/data"), "split", "role").orderBy("role", "path")


_RUN_DATE = "CASE WHEN regexp_full_match(split_part(folder, '_', 2), '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') THEN TRY_CAST(split_part(folder, '_', 2) AS DATE) END"


@_query(f"SELECT folder, CAST({_RUN_DATE} AS VARCHAR) AS run_date FROM runs WHERE {_RUN_DATE} IS NOT NULL", "runs")
def scan_runs(runs):
    root = session.shared_path(runs.sparkSession, "run-folders")
    sinks.write_files(runs.select(F.concat("folder", F.lit("/project/weights/best")).alias("name"), F.lit(b"w").alias("data")), root)
    return L.scan_runs(images.scan_folders(runs.sparkSession, root)).select("folder", F.col("run_date").cast("string").alias("run_date"))


@_query(f"SELECT folder FROM runs WHERE {_RUN_DATE} IS NULL", "runs")
def drop_bad_run_names(runs):
    return L.all_runs(runs).where("run_date is null").select("folder")


@_query(f"SELECT path, regexp_extract(path, '([^/]*)$', 1) AS name, {_STEM} AS stem, {_EXT} AS ext, 'out/' || regexp_extract(path, '([^/]*)$', 1) AS moved FROM paths", "paths")
def path_parts(paths):
    return L.path_parts(paths).select("path", "name", "stem", "ext", "moved")


@_query("SELECT path FROM paths", "paths")
def sort_paths(paths):
    return paths.select("path").orderBy("path")


@_query(f"SELECT {_RANK} AS ext_rank, path FROM paths WHERE role = 'image' AND {_EXT} IN ('jpg', 'png', 'jpeg')", "paths")
def sort_ext_major(paths):
    return L.extension_major(paths.where("role = 'image'")).select("ext_rank", "path")


@_query(f"SELECT path FROM paths WHERE {_EXT} = 'jpg' UNION ALL SELECT path FROM paths WHERE {_EXT} = 'png' UNION ALL SELECT path FROM paths WHERE {_EXT} = 'jpeg'", "paths")
def union_listings(paths):
    return L.union_listings(paths).select("path")


_SIDES = f"""WITH i AS (SELECT path, row_number() OVER (ORDER BY {_RANK}, path) - 1 AS idx FROM paths WHERE role = 'image' AND split = 'train' AND {_EXT} IN ('jpg', 'png', 'jpeg')),
m AS (SELECT path, row_number() OVER (ORDER BY path) - 1 AS idx FROM paths WHERE role = 'mask' AND split = 'train')"""


def _sides(paths):
    return L.by_extension(paths.where("role = 'image' and split = 'train'"), L.IMAGE_EXTENSIONS), paths.where("role = 'mask' and split = 'train'")


@_query(f"{_SIDES} SELECT i.idx AS idx, i.path AS image_path, m.path AS mask_path FROM i JOIN m USING (idx)", "paths")
def pair_positional(paths):
    a, b = _sides(paths)
    return L.pair_positional(a, b, [L.ext_rank(), "path"], ["path"])


@_query(f"{_SIDES} SELECT {_STEM.replace('path', 'i.path')} AS stem, i.path AS image_path, m.path AS mask_path FROM i JOIN m ON {_STEM.replace('path', 'i.path')} = {_STEM.replace('path', 'm.path')}", "paths")
def pair_by_stem(paths):
    return L.pair_by_stem(*_sides(paths))


@_query(f"{_SIDES} SELECT *, n_images = n_masks AS ok, CASE WHEN n_images = n_masks THEN '' ELSE 'unequal_counts' END AS reason FROM (SELECT (SELECT count(*) FROM i) AS n_images, (SELECT count(*) FROM m) AS n_masks) n", "paths")
def pair_count_guard(paths):
    return L.pair_count_guard(*_sides(paths))


@_query(f"""WITH p AS (SELECT role, path, {_STEM} AS stem FROM paths WHERE split = 'train')
SELECT role AS side, path FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE b.stem = a.stem AND b.role <> a.role)""", "paths")
def unpaired_files(paths):
    train = paths.where("split = 'train'")
    return L.unpaired_files(train.where("role = 'image'"), train.where("role = 'mask'"))


@_query("SELECT image_id, path, row_number() OVER (ORDER BY path) - 1 AS idx FROM paths WHERE role = 'image'", "paths")
def sample_index(paths):
    return L.indexed(paths.where("role = 'image'"), "path").select("image_id", "path", "idx")


_SPLIT = "SELECT image_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || image_id), image_id) <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'val' END AS subset FROM paths WHERE role = 'image'"


@_query(_SPLIT, "paths")
def split_exact(paths):
    return L.split_exact(paths.where("role = 'image'")).select("image_id", "subset")


@_query(f"""SELECT 0 AS epoch, image_id, CAST((row_number() OVER (ORDER BY image_id) - 1) // {BATCH} AS BIGINT) AS batch_id FROM paths WHERE role = 'image'
UNION ALL SELECT 3 AS epoch, image_id, CAST((row_number() OVER (ORDER BY md5('3:' || image_id), image_id) - 1) // {BATCH} AS BIGINT) FROM paths WHERE role = 'image'""", "paths")
def batch_assign(paths):
    rows = paths.where("role = 'image'").select("image_id")
    parts = [L.batch_assign(rows, BATCH, epoch=e).select(F.lit(e or 0).alias("epoch"), "image_id", "batch_id") for e in (None, 3)]
    return parts[0].unionByName(parts[1])


@_query("SELECT split, count(*) AS n FROM paths WHERE role = 'image' GROUP BY split", "paths")
def frame_count(paths):
    return L.frame_count(paths.where("role = 'image'"))


@_query(f"SELECT CAST(0.0001 AS DOUBLE) AS learning_rate, 32 AS batch_size, 10 AS epochs, count(*) FILTER (subset = 'train') AS train_size, count(*) FILTER (subset = 'val') AS val_size FROM ({_SPLIT}) s", "paths")
def dataset_summary(paths):
    return L.dataset_summary(L.split_exact(paths.where("role = 'image'")), 0.0001, 32, 10)


_DIFF = f"abs(floor((epoch(CAST({_RUN_DATE} AS TIMESTAMP)) - epoch(TIMESTAMP '{NOW}')) / 86400))"


@_query(f"SELECT folder, CAST({_DIFF} AS BIGINT) AS diff FROM runs WHERE {_RUN_DATE} IS NOT NULL ORDER BY diff, folder LIMIT 1", "runs")
def latest_run(runs):
    return L.latest_run(runs, NOW)


@_query(f"""WITH r AS (SELECT folder, CAST({_RUN_DATE} AS TIMESTAMP) AS d FROM runs WHERE {_RUN_DATE} IS NOT NULL),
q AS (SELECT DISTINCT date_trunc('hour', ts) AS ts FROM events),
c AS (SELECT q.ts, r.folder, CAST(abs(floor((epoch(r.d) - epoch(q.ts)) / 86400)) AS BIGINT) AS diff FROM q CROSS JOIN r)
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, folder, diff FROM c QUALIFY row_number() OVER (PARTITION BY ts ORDER BY diff, folder) = 1""", "events", "runs")
def nearest_run(events, runs):
    asked = events.select(F.date_trunc("hour", "ts").alias("ts"))
    return L.nearest_run(asked, runs).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


# --- scalar expressions ---


@_query("SELECT image_id, y, x, CASE WHEN v >= 128 THEN 1 ELSE 0 END AS m, CASE WHEN v >= 128 THEN 255 ELSE 0 END AS stored FROM raster8", "raster8")
def normalize_mask(raster8):
    m = S.normalize_mask(F.col("v"))
    return raster8.select("image_id", "y", "x", m.alias("m"), S.scale_mask(m).alias("stored"))


@_query("SELECT image_id, c, y, x, round(v / 255.0::DOUBLE, 6) AS u FROM rgb_pixels", "rgb_pixels")
def to_unit_scale(rgb):
    return rgb.select("image_id", "c", "y", "x", S.unit_scale_rounded(F.col("v")).alias("u"))


@_query("SELECT image_id, y, x, 2 - c AS c, v FROM rgb_pixels", "rgb_pixels")
def swap_channels(rgb):
    return R.swap_channels(rgb).select("image_id", "y", "x", "c", "v")


@_query("SELECT image_id, y, x, CASE WHEN logit > 0 THEN 1 ELSE 0 END AS pred FROM raster8", "raster8")
def threshold_logit(raster8):
    return raster8.select("image_id", "y", "x", S.threshold_logit(F.col("logit")).alias("pred"))


@_query("SELECT image_id, y, x, CASE WHEN 1 / (1 + exp(-logit)) > 0.5 THEN 1 ELSE 0 END AS pred FROM raster8", "raster8")
def threshold_sigmoid(raster8):
    return raster8.select("image_id", "y", "x", S.threshold_sigmoid(F.col("logit")).alias("pred"))


@_query("SELECT image_id, CAST(trunc(x_min) AS INTEGER) AS x_min, CAST(trunc(y_min) AS INTEGER) AS y_min, CAST(trunc(x_max) AS INTEGER) AS x_max, CAST(trunc(y_max) AS INTEGER) AS y_max, k1, k2, k3 FROM detections", "detections")
def trunc_box(detections):
    return B.trunc_box(detections).select("image_id", "x_min", "y_min", "x_max", "y_max", "k1", "k2", "k3")


@_query("SELECT image_id, y, x, target * 255 AS v FROM raster8", "raster8")
def scale_mask(raster8):
    return raster8.select("image_id", "y", "x", S.scale_mask(F.col("target")).alias("v"))


@_query("SELECT image_id, y, x, greatest(logit, 0) AS v FROM raster8", "raster8")
def relu(raster8):
    return raster8.select("image_id", "y", "x", S.relu(F.col("logit")).alias("v"))


@_query("SELECT event_id, epoch || chr(9) || printf('%.4f', train_loss) AS line FROM epoch_metrics", "epoch_metrics")
def format_metrics(metrics):
    return metrics.select("event_id", F.concat_ws("\t", F.col("epoch").cast("string"), F.format_string("%.4f", "train_loss")).alias("line"))


@_query("SELECT event_id, strftime(ts, '%Y%m%d_%H%M') AS minute_stamp, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS second_stamp FROM events", "events")
def run_stamp(events):
    return events.select("event_id", F.date_format("ts", "yyyyMMdd_HHmm").alias("minute_stamp"), F.date_format("ts", "yyyy-MM-dd_HH-mm-ss").alias("second_stamp"))


@_query("SELECT image_id, y, x, CASE WHEN v >= 128 THEN 0 ELSE 255 END AS v FROM raster8", "raster8")
def compose_transforms(raster8):
    binary = lambda d: d.withColumn("v", S.normalize_mask(F.col("v")))
    turned = lambda d: d.withColumn("v", 1 - F.col("v"))
    out = raster8.select("image_id", "y", "x", "v")
    for step in (binary, turned, lambda d: d.withColumn("v", S.scale_mask(F.col("v")))):
        out = out.transform(step)
    return out


# --- filters ---


@_query("SELECT image_id, y, x FROM mask_pixels WHERE v <> 255", "mask_pixels")
def foreground_filter(pixels):
    return pixels.where(B.foreground(F.col("v"), "dark")).select("image_id", "y", "x")


@_query("SELECT image_id, 'no_foreground' AS reason FROM plots WHERE image_id NOT IN (SELECT image_id FROM mask_pixels WHERE v <> 255)", "plots", "mask_pixels")
def skip_empty_masks(plots, pixels):
    return B.skip_empty_masks(plots, B.mask_bbox(pixels, "dark")).select("image_id", "reason")


@_query(f"SELECT image_id, CASE WHEN {_EXT} NOT IN ('jpg', 'png', 'jpeg') THEN 'bad_extension' ELSE 'no_mask' END AS reason FROM paths WHERE role = 'image' AND ({_EXT} NOT IN ('jpg', 'png', 'jpeg') OR image_id % 29 = 0)", "paths")
def quarantine_errors(paths):
    masks = paths.where("role = 'mask'").select("image_id", F.lit(True).alias("has_mask"))
    frames = paths.where("role = 'image'").join(masks, "image_id", "left")
    _, bad = B.quarantine(frames, [("bad_extension", ~S.extension(F.col("path")).isin(*L.IMAGE_EXTENSIONS)), ("no_mask", F.col("has_mask").isNull())])
    return bad.select("image_id", "reason")


_TOP1 = "SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, k1, k2, k3) AS rn FROM detections QUALIFY rn = 1"


@_query(f"WITH t AS ({_TOP1}), f AS (SELECT DISTINCT l_orderkey AS image_id FROM lineitem) SELECT f.image_id, CASE WHEN t.image_id IS NULL THEN 'no_detection' ELSE '' END AS reason FROM f LEFT JOIN t USING (image_id)", "lineitem", "detections")
def no_detection_filter(lineitem, detections):
    frames = lineitem.select(F.col("l_orderkey").alias("image_id")).distinct()
    return B.no_detection_filter(B.attach_detection(frames, detections, ["k1", "k2", "k3"])).select("image_id", "reason")


@_query("SELECT image_id, CASE WHEN height < 4000 AND width < 4000 THEN 'direct' ELSE 'tiled' END AS route FROM frames_dim", "frames_dim")
def route_by_size(frames):
    return T.route_by_size(frames).select("image_id", "route")


@_query("SELECT image_id, height, width, 1 AS channels, CASE WHEN height < 24 AND width < 24 THEN 'direct' ELSE 'tiled' END AS route FROM plots", "plots", "mask_pixels")
def scan_frame_sizes(plots, masks):
    """Sizes and routes of image files by their headers."""
    spark = plots.sparkSession
    folder = session.shared_path(spark, "sized")
    sinks.write_png(sinks.pack_pixels(masks.withColumn("c", F.lit(0))).withColumn("name", F.format_string("a/img_%08d", "image_id")), folder)
    found = T.route_by_size(headers.scan_frame_sizes(spark, folder, recursive=True), 24)
    return found.select(F.regexp_extract("path", "img_([0-9]+)", 1).cast("long").alias("image_id"), "height", "width", "channels", "route")


# --- joins ---


@_query(f"WITH t AS ({_TOP1}), f AS (SELECT DISTINCT l_orderkey AS image_id FROM lineitem) SELECT f.image_id, round(conf, 6) AS conf, round(x_min, 6) AS x_min, CAST(k1 AS VARCHAR) AS k1, CAST(k2 AS VARCHAR) AS k2, CAST(k3 AS VARCHAR) AS k3 FROM f LEFT JOIN t USING (image_id)", "lineitem", "detections")
def attach_detection(lineitem, detections):
    frames = lineitem.select(F.col("l_orderkey").alias("image_id")).distinct()
    return B.attach_detection(frames, detections, ["k1", "k2", "k3"]).select("image_id", F.round("conf", 6).alias("conf"), F.round("x_min", 6).alias("x_min"), *[F.col(k).cast("string").alias(k) for k in ("k1", "k2", "k3")])


_BOX = "(SELECT image_id, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1 FROM mask_pixels WHERE v <> 255 GROUP BY image_id)"


@_query(f"SELECT p.image_id, y - y0 AS y, x - x0 AS x, c, v FROM rgb_pixels p JOIN {_BOX} b USING (image_id) WHERE x >= x0 AND x < x1 AND y >= y0 AND y < y1", "rgb_pixels", "mask_pixels")
def crop_by_box(rgb, masks):
    return B.crop_by_box(rgb.select("image_id", "y", "x", "c", "v"), B.mask_bbox(masks, "dark")).select("image_id", "y", "x", "c", "v")


_TILES = """(SELECT image_id, CAST(y0 AS INTEGER) AS tile_y0, CAST(x0 AS INTEGER) AS tile_x0, CAST(least(y0 + height // 2, height) AS INTEGER) AS y1, CAST(least(x0 + width // 2, width) AS INTEGER) AS x1
FROM (SELECT *, unnest(range(0, width, width // 2 - 3)) AS x0 FROM (SELECT *, unnest(range(0, height, height // 2 - 3)) AS y0 FROM plots) a) b)"""


@_query(f"SELECT p.image_id, y, x, v, tile_y0, tile_x0 FROM mask_pixels p JOIN {_TILES} t ON p.image_id = t.image_id AND y >= tile_y0 AND y < y1 AND x >= tile_x0 AND x < x1", "mask_pixels", "plots")
def assign_tiles(pixels, plots):
    return T.assign_tiles(pixels, 3).select("image_id", "y", "x", "v", "tile_y0", "tile_x0")


@_query(f"WITH m AS (SELECT p.image_id, y, x, max(CASE WHEN v <> 255 AND (tile_y0 + tile_x0) % 2 = 0 THEN 1 ELSE 0 END) AS pred FROM mask_pixels p JOIN {_TILES} t ON p.image_id = t.image_id AND y >= tile_y0 AND y < y1 AND x >= tile_x0 AND x < x1 GROUP BY ALL) SELECT * FROM m", "mask_pixels", "plots")
def merge_tiles_max(pixels, plots):
    # A tile's verdict depends on the tile, so that overlapping ones differ.
    scored = T.assign_tiles(pixels, 3).withColumn("pred", ((F.col("v") != 255) & ((F.col("tile_y0") + F.col("tile_x0")) % 2 == 0)).cast("int"))
    return T.merge_tiles_max(scored)


@_query(f"WITH m AS (SELECT p.image_id, y, x, max(CASE WHEN v <> 255 AND (tile_y0 + tile_x0) % 2 = 0 THEN 1 ELSE 0 END) AS pred FROM mask_pixels p JOIN {_TILES} t ON p.image_id = t.image_id AND y >= tile_y0 AND y < y1 AND x >= tile_x0 AND x < x1 GROUP BY ALL) SELECT * FROM m", "mask_pixels", "plots")
def merge_tiles_max_packed(pixels, plots):
    tiles = P.cut_overlapping(P.pack(pixels), plots, 3)
    scored = P.map_tiles(tiles, lambda row: [(row[0], row[1], row[2], ((row[3] != 255) & ((row[1] + row[2]) % 2 == 0)).astype("uint8"))])
    return P.to_pixels(P.merge_max(scored, 8)).withColumnRenamed("v", "pred")


@_query(f"SELECT image_id, y, x, CASE WHEN b.image_id IS NOT NULL AND x >= x0 AND x < x1 AND y >= y0 AND y < y1 THEN v ELSE 0 END AS v FROM mask_pixels p LEFT JOIN {_BOX} b USING (image_id)".replace("SELECT image_id, y", "SELECT p.image_id, y"), "mask_pixels", "plots")
def paste_to_frame(pixels, plots):
    box = B.mask_bbox(pixels, "dark")
    return T.paste_to_frame(B.crop_by_box(pixels.select("image_id", "y", "x", "v"), box), box, plots)


@_query("SELECT r.image_id, r.y, r.x, r.c, r.v, CASE WHEN m.v <> 255 THEN 1 ELSE 0 END AS m, least(255, r.v + CASE WHEN m.v <> 255 AND r.c = 1 THEN 191 ELSE 0 END) AS shown FROM rgb_pixels r JOIN mask_pixels m ON r.image_id = m.image_id AND r.y = m.y AND r.x = m.x", "rgb_pixels", "mask_pixels")
def compose_frame_mask(rgb, masks):
    met = R.met(rgb.select("image_id", "y", "x", "c", "v"), _m01(masks), "m")
    return met.select("image_id", "y", "x", "c", "v", "m", R.greener(F.col("v"), F.col("c"), F.col("m")).alias("shown"))


def _m01(masks):
    return masks.select("image_id", "y", "x", B.foreground(F.col("v"), "dark").cast("int").alias("m"))


# --- aggregates ---


@_query(f"SELECT * FROM {_BOX} b", "mask_pixels")
def mask_bbox(pixels):
    return B.mask_bbox(pixels, "dark")


@_query(f"SELECT * FROM {_BOX} b", "mask_pixels")
def mask_bbox_packed(pixels):
    frames = sinks.pack_pixels(pixels.withColumn("c", F.lit(0)))
    return P.mask_bbox(P.cut_tiles(frames, 7), "dark")


_BCE = "greatest(logit, 0) - logit * target + ln(1 + exp(-abs(logit)))"
_B32 = f"(SELECT *, image_id // {BATCH} AS batch_id FROM raster8)"


def _batched(raster8):
    return raster8.withColumn("batch_id", F.floor(F.col("image_id") / BATCH).cast("long"))


@_query(f"SELECT round(avg(l), 6) AS loss FROM (SELECT batch_id, avg({_BCE}) AS l FROM {_B32} r GROUP BY batch_id) b", "raster8")
def bce_loss(raster8):
    return M.bce_loss(_batched(raster8)).select(F.round("loss", 6).alias("loss"))


_CELLS = "count(*) FILTER (logit > 0 AND target = 1) AS tp, count(*) FILTER (logit > 0 AND target <> 1) AS fp, count(*) FILTER (logit <= 0 AND target = 1) AS fn, count(*) FILTER (logit <= 0 AND target <> 1) AS tn"


@_query(f"SELECT image_id, {_CELLS} FROM line_pixels GROUP BY image_id", "line_pixels")
def confusion_counts(pixels):
    return M.confusion_counts(pixels)


@_query(f"SELECT image_id, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 6) AS recall FROM (SELECT image_id, {_CELLS} FROM line_pixels GROUP BY image_id) c", "line_pixels")
def accuracy_recall(pixels):
    return M.accuracy_recall(M.confusion_counts(pixels)).withColumns({"accuracy": F.round("accuracy", 6), "recall": F.round("recall", 6)})


_COUNTS = f"(SELECT batch_id, image_id, {_CELLS} FROM {_B32} r GROUP BY batch_id, image_id)"
_IOU = "CASE WHEN tp + fp + fn > 0 THEN tp / (tp + fp + fn) ELSE 0 END"
_IOU0 = "CASE WHEN tn + fp + fn > 0 THEN tn / (tn + fp + fn) ELSE 0 END"
_DICE = "CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END"


@_query(f"SELECT round(avg(s), 6) AS iou FROM (SELECT batch_id, avg({_IOU}) AS s FROM {_COUNTS} c GROUP BY batch_id) b", "raster8")
def mean_iou(raster8):
    return M.mean_iou(_batched(raster8)).select(F.round("iou", 6).alias("iou"))


@_query(f"SELECT round(avg(s), 6) AS iou FROM (SELECT batch_id, avg(({_IOU} + {_IOU0}) / 2) AS s FROM {_COUNTS} c GROUP BY batch_id) b", "raster8")
def mean_iou_2class(raster8):
    return M.mean_iou(_batched(raster8), classes=2).select(F.round("iou", 6).alias("iou"))


@_query(f"""WITH w AS (SELECT *, CASE WHEN tp + fn > 0 THEN 1.0::DOUBLE / ((tp + fn) * (tp + fn)) END AS a, CASE WHEN tn + fp > 0 THEN 1.0::DOUBLE / ((tn + fp) * (tn + fp)) END AS b FROM {_COUNTS} c),
f AS (SELECT *, coalesce(a, greatest(coalesce(a, 0), coalesce(b, 0))) AS w1, coalesce(b, greatest(coalesce(a, 0), coalesce(b, 0))) AS w0 FROM w),
r AS (SELECT 2 * (w1 * tp + w0 * tn) AS up, w1 * (2 * tp + fp + fn) + w0 * (2 * tn + fp + fn) AS down, {_DICE} AS one FROM f)
SELECT round(avg(one), 6) AS dice, round(avg(CASE WHEN down > 0 THEN up / down ELSE 0 END), 6) AS dice_2class FROM r""", "raster8")
def generalized_dice(raster8):
    return M.both_dice(_batched(raster8)).select(F.round("dice", 6).alias("dice"), F.round("dice_2class", 6).alias("dice_2class"))


_EPOCH_BATCH = f"CASE WHEN split = 'val' THEN (image_id // 5) // {BATCH} ELSE (image_id - image_id // 5) // {BATCH} END"


@_query(f"""WITH i AS (SELECT epoch, split, {_EPOCH_BATCH} AS batch_id, image_id, sum({_BCE}) AS loss, count(*) AS n, {_CELLS} FROM epoch_scores GROUP BY ALL),
b AS (SELECT epoch, split, batch_id, sum(loss) / sum(n) AS loss, avg({_IOU}) AS iou FROM i GROUP BY ALL)
SELECT epoch, round(avg(loss) FILTER (split = 'train'), 6) AS train_loss, round(avg(loss) FILTER (split = 'val'), 6) AS val_loss, round(avg(iou) FILTER (split = 'val'), 6) AS iou,
 round((SELECT avg({_DICE}) FROM i WHERE i.epoch = b.epoch AND split = 'val'), 6) AS dice FROM b GROUP BY epoch""", "epoch_scores")
def epoch_report(scores):
    return _rounded(M.epoch_report(_epoch_batches(scores)))


def _epoch_batches(scores):
    fifth = F.floor(F.col("image_id") / 5)
    batch = F.floor(F.when(F.col("split") == "val", fifth).otherwise(F.col("image_id") - fifth) / BATCH).cast("long")
    return scores.withColumn("batch_id", batch)


def _rounded(report):
    return report.select("epoch", *[F.round(c, 6).alias(c) for c in ("train_loss", "val_loss", "iou", "dice")])


@_query(_ORACLE["epoch_report"])
def metric_state(spark, sf_dir):
    """The same report from kept state: two updates that overlap, one repeated, and a state merged into it."""
    scored = _epoch_batches(fixture(spark, sf_dir, "epoch_scores"))
    state, other = (M.MetricState(spark, session.shared_path(spark, n)).reset() for n in ("state", "other"))
    state.update(scored.where("image_id % 2 = 0")).update(scored.where("image_id % 3 = 0")).update(scored.where("image_id % 2 = 0"))
    return _rounded(state.merge(other.update(scored.where("image_id % 3 > 0"))).compute())


@_query("SELECT image_id, y // 2 AS y, x // 2 AS x, 0 AS c, max(v) AS v FROM raster8 GROUP BY ALL", "raster8")
def max_pool(raster8):
    return R.max_pool(raster8.withColumn("c", F.lit(0)), 8, 8)


@_query(f"SELECT image_id, round(conf, 6) AS conf, round(x_min, 6) AS x_min, round(y_max, 6) AS y_max, k1, k2, k3 FROM ({_TOP1}) t", "detections")
def top1_detection(detections):
    best = B.top1_detection(detections, ["k1", "k2", "k3"])
    return best.select("image_id", *[F.round(c, 6).alias(c) for c in ("conf", "x_min", "y_max")], "k1", "k2", "k3")


@_query("SELECT image_id, y, x, 0 AS c, v FROM raster8 UNION ALL SELECT image_id, y, x, 1 AS c, target * 255 AS v FROM raster8", "raster8")
def concat_channels(raster8):
    a = raster8.select("image_id", "y", "x", F.lit(0).alias("c"), "v")
    b = raster8.select("image_id", "y", "x", F.lit(0).alias("c"), (F.col("target") * 255).alias("v"))
    return R.concat_channels(a, b, 1)


# --- raster operators ---


def _weights_sql(kind: str, n_src: str, n_dst: str, sizes: str) -> str:
    """Weights (n_src, n_dst, src, dst, w) written for the oracle over a table of sizes."""
    reach, widens = Z.KERNELS[kind]
    wide = f"greatest({n_src} / {n_dst}, 1)" if widens else "1.0"
    kernel = f"CASE WHEN abs(t) < 1e-12 THEN 1 WHEN abs(t) >= 3 THEN 0 ELSE 3 * sin(t * {math.pi!r}) * sin(t * {math.pi!r} / 3) / (t * {math.pi!r} * t * {math.pi!r}) END" if kind == "lanczos" else "greatest(1 - abs(t), 0)"
    inside = "WHERE s BETWEEN 0 AND n_src - 1" if widens else ""
    return f"""(SELECT n_src, n_dst, dst, src, k / sum(k) OVER (PARTITION BY n_src, n_dst, dst) AS w FROM (
SELECT n_src, n_dst, dst, least(greatest(s, 0), n_src - 1) AS src, sum({kernel}) AS k FROM (
SELECT *, (s + 0.5::DOUBLE - (dst + 0.5::DOUBLE) * n_src / n_dst) / wide AS t FROM (
SELECT *, unnest(range(-40, n_src + 40)) AS s FROM (SELECT *, unnest(range(0, n_dst)) AS dst FROM (SELECT DISTINCT {n_src} AS n_src, {n_dst} AS n_dst, CAST({wide} AS DOUBLE) AS wide FROM {sizes}) a) b) c) d {inside} GROUP BY ALL) e WHERE abs(k) > 0)"""


def _resize_sql(kind: str, n: int, value: str = "v", as_byte: bool = True) -> str:
    w = _weights_sql(kind, "8", str(n), "(SELECT 1) one")
    out = f"CAST(least(greatest(floor(round(s, 6) + 0.5), 0), 255) AS INTEGER) AS {value}" if as_byte else f"round(s, 6) AS {value}"
    return f"""SELECT image_id, y, x, {out} FROM (SELECT image_id, CAST(b.dst AS INTEGER) AS y, CAST(a.dst AS INTEGER) AS x, sum({value} * a.w * b.w) AS s
FROM raster8 r JOIN {w} a ON r.x = a.src JOIN {w} b ON r.y = b.src GROUP BY ALL) z"""


def _frames8(raster8, n: int):
    return raster8.groupBy("image_id").agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width")).withColumns({"out_h": F.lit(n), "out_w": F.lit(n)})


@_query(_resize_sql("lanczos", 5), "raster8")
def resize_lanczos(raster8):
    return P.to_pixels(P.resize(P.pack(raster8), _frames8(raster8, 5), "lanczos"))


@_query(_resize_sql("triangle", 5), "raster8")
def resize_bilinear_aa(raster8):
    return P.to_pixels(P.resize(P.pack(raster8), _frames8(raster8, 5), "triangle"))


@_query(_resize_sql("linear", 12), "raster8")
def resize_bilinear(raster8):
    return P.to_pixels(P.resize(P.pack(raster8), _frames8(raster8, 12), "linear"))


@_query(_resize_sql("linear", 5, as_byte=False), "raster8")
def resample_join(raster8):
    return P.resample(P.pack(raster8), _frames8(raster8, 5), "linear").withColumn("v", F.round("v", 6))


@_query(_resize_sql("lanczos", 5), "raster8")
def resize_lanczos_long(raster8):
    """The long form, the packed one's yardstick."""
    return Z.resize(raster8, _frames8(raster8, 5), "lanczos")


@_query("SELECT image_id, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, v FROM (SELECT unnest(range(0, 5)) AS y) a, (SELECT unnest(range(0, 5)) AS x) b, (SELECT image_id, y AS sy, x AS sx, v FROM raster8) r WHERE sy = floor((y + 0.5) * 8 / 5) AND sx = floor((x + 0.5) * 8 / 5)", "raster8")
def resize_nearest(raster8):
    return Z.resize_nearest(raster8, _frames8(raster8, 5))


_TARGET5 = _resize_sql("triangle", 5, "target", as_byte=False)


@_query(f"SELECT image_id, y, x, target AS uncut, CAST(floor(target) AS INTEGER) AS target FROM ({_TARGET5}) t", "raster8")
def truncate_target(raster8):
    soft = P.resample(P.pack(raster8, "target"), _frames8(raster8, 5), "triangle").withColumn("uncut", F.round("v", 6))
    return soft.select("image_id", "y", "x", "uncut", F.col("uncut").cast("int").alias("target"))


_EXT9 = f"""(SELECT p.image_id, width, height, x1 - x0 AS w, y1 - y0 AS h, greatest(0, x0 - greatest(9 - (x1 - x0), 0) // 2) AS x0, least(width, x1 + greatest(9 - (x1 - x0), 0) - greatest(9 - (x1 - x0), 0) // 2) AS x1,
greatest(0, y0 - greatest(9 - (y1 - y0), 0) // 2) AS y0, least(height, y1 + greatest(9 - (y1 - y0), 0) - greatest(9 - (y1 - y0), 0) // 2) AS y1 FROM plots p JOIN {_BOX} b USING (image_id))"""


@_query(f"SELECT image_id, x0, y0, x1, y1 FROM {_EXT9} e", "plots", "mask_pixels")
def extend_box(plots, masks):
    box = B.mask_bbox(masks, "dark").join(plots.select("image_id", "width", "height"), "image_id")
    return B.extend_box(box, 9).select("image_id", "x0", "y0", "x1", "y1")


_GRID9 = "(SELECT unnest(range(0, 9)) AS y) gy, (SELECT unnest(range(0, 9)) AS x) gx"
_PAD9 = f"""SELECT e.image_id, CAST(gy.y AS INTEGER) AS y, CAST(gx.x AS INTEGER) AS x, coalesce(m.v, 255) AS v FROM {_EXT9} e, {_GRID9}
LEFT JOIN mask_pixels m ON m.image_id = e.image_id AND m.x = gx.x - (9 - (e.x1 - e.x0)) // 2 + e.x0 AND m.y = gy.y - (9 - (e.y1 - e.y0)) // 2 + e.y0 AND m.x >= e.x0 AND m.x < e.x1 AND m.y >= e.y0 AND m.y < e.y1
WHERE e.w <= 9 AND e.h <= 9"""


@_query(_PAD9, "plots", "mask_pixels")
def center_pad(plots, masks):
    box = B.mask_bbox(masks, "dark").join(plots.select("image_id", "width", "height"), "image_id").where("x1 - x0 <= 9 and y1 - y0 <= 9")
    return R.center_pad(masks, B.extend_box(box, 9), 9, 255)


@_query(f"""{_PAD9} UNION ALL SELECT e.image_id, CAST(gy.y AS INTEGER), CAST(gx.x AS INTEGER), m.v FROM (SELECT * FROM {_BOX} b WHERE x1 - x0 > 9 OR y1 - y0 > 9) e, {_GRID9}
JOIN mask_pixels m ON m.image_id = e.image_id AND m.x = e.x0 + floor((gx.x + 0.5) * (e.x1 - e.x0) / 9) AND m.y = e.y0 + floor((gy.y + 0.5) * (e.y1 - e.y0) / 9)""", "plots", "mask_pixels")
def fit_to_target(plots, masks):
    box = B.mask_bbox(masks, "dark").join(plots.select("image_id", "width", "height"), "image_id")
    return R.fit_to_target(masks, box, 9, 255)


@_query("""SELECT image_id, CAST(y0 AS INTEGER) AS y0, CAST(x0 AS INTEGER) AS x0, CAST(least(y0 + height // 2, height) AS INTEGER) AS y1, CAST(least(x0 + width // 2, width) AS INTEGER) AS x1
FROM (SELECT *, unnest(range(0, width, width // 2 - 500)) AS x0 FROM (SELECT *, unnest(range(0, height, height // 2 - 500)) AS y0 FROM frames_dim WHERE height // 2 > 500 AND width // 2 > 500) a) b""", "frames_dim")
def tile_grid(frames):
    return T.tile_grid(frames, 500)


@_query("SELECT image_id, 'bad_tile_step' AS reason FROM frames_dim WHERE height // 2 <= 500 OR width // 2 <= 500", "frames_dim")
def bad_tile_steps(frames):
    return T.bad_tile_steps(frames, 500).select("image_id", "reason")


_OVER = "(SELECT r.image_id, r.y, r.x, r.c, r.width, r.height, least(255, r.v + CASE WHEN m.v <> 255 AND r.c = 1 THEN 191 ELSE 0 END) AS v FROM rgb_pixels r JOIN mask_pixels m ON r.image_id = m.image_id AND r.y = m.y AND r.x = m.x)"


@_query(f"""SELECT image_id, c, y, x, CAST(least(greatest(floor(round(s, 6) + 0.5), 0), 255) AS INTEGER) AS v FROM (
SELECT o.image_id, o.c, CAST(b.dst AS INTEGER) AS y, CAST(a.dst AS INTEGER) AS x, sum(o.v * a.w * b.w) AS s FROM {_OVER} o
JOIN {_weights_sql("linear", "width", "width // 10", "plots")} a ON o.width = a.n_src AND o.x = a.src JOIN {_weights_sql("linear", "height", "height // 10", "plots")} b ON o.height = b.n_src AND o.y = b.src GROUP BY ALL) z""", "rgb_pixels", "mask_pixels", "plots")
def overlay_mask(rgb, masks, plots):
    # Each channel is a plane of its own; only the green ones meet the mask, tile by tile.
    of_plane = lambda c: (F.col("image_id") * 3 + c).alias("image_id")
    planes = P.pack(rgb.select(of_plane(F.col("c")), "y", "x", "v"))
    green = P.overlay_green(planes, P.pack(_m01(masks).select(of_plane(F.lit(1)), "y", "x", "m"), "m"))
    sizes = plots.select(F.explode(F.array(*[(F.col("image_id") * 3 + c) for c in range(3)])).alias("image_id"), "height", "width", F.floor(F.col("height") / 10).cast("int").alias("out_h"), F.floor(F.col("width") / 10).cast("int").alias("out_w"))
    small = P.to_pixels(P.resize(green, sizes, "linear"))
    return small.select(F.floor(F.col("image_id") / 3).cast("long").alias("image_id"), (F.col("image_id") % 3).cast("int").alias("c"), "y", "x", "v")


@_query("SELECT image_id, y, x, c, v FROM rgb_pixels UNION ALL SELECT image_id, y, x + width, CAST(c AS INTEGER), CASE WHEN v <> 255 THEN 255 ELSE 0 END FROM (SELECT *, unnest(range(0, 3)) AS c FROM mask_pixels) m", "rgb_pixels", "mask_pixels")
def side_by_side(rgb, masks):
    return R.side_by_side(rgb, _m01(masks))


_KERNEL3 = [(dy, dx, 0, o, (dy * 3 + dx + 5) * (1 if o == 0 else -1) / 8) for o in (0, 1) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
_BIAS2 = [0.5, -0.25]


def _values(rows, names: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"{v!r}" for v in r) + ")" for r in rows) + f") k({names})"


@_query(f"""SELECT image_id, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, CAST(c AS INTEGER) AS c, round(s + CASE c WHEN 0 THEN 0.5 ELSE -0.25 END, 6) AS v FROM (
SELECT image_id, y - dy AS y, x - dx AS x, co AS c, sum(v * CAST(w AS DOUBLE)) AS s FROM raster8, {_values(_KERNEL3, "dy, dx, ci, co, w")} GROUP BY ALL) z WHERE y BETWEEN 0 AND 7 AND x BETWEEN 0 AND 7""", "raster8")
def focal_conv3(raster8):
    return R.focal_conv3(raster8.withColumn("c", F.lit(0)), _KERNEL3, _BIAS2, 8, 8).withColumn("v", F.round("v", 6))


_BLUR = [[(dy * 3 + dx + 5) / 64 for dx in (-1, 0, 1)] for dy in (-1, 0, 1)]


@_query(f"""SELECT image_id, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, CAST(least(greatest(floor(round(s, 6) + 0.5), 0), 255) AS INTEGER) AS v FROM (
SELECT image_id, y - dy AS y, x - dx AS x, sum(v * CAST(w AS DOUBLE)) AS s FROM raster8, {_values([(dy, dx, _BLUR[dy + 1][dx + 1]) for dy in (-1, 0, 1) for dx in (-1, 0, 1)], "dy, dx, w")} GROUP BY ALL) z WHERE y BETWEEN 0 AND 7 AND x BETWEEN 0 AND 7""", "raster8")
def focal_conv3_packed(raster8):
    # Tiles of three pixels, so that every frame has edges between tiles.
    return P.to_pixels(P.focal3(P.pack(raster8, tile=3), np.array(_BLUR), 3))


_MIX = [(0, 0, 0.5), (1, 0, 0.25), (2, 0, -0.125), (0, 1, 1.0), (2, 1, -0.5)]


@_query(f"""SELECT image_id, y, x, CAST(c AS INTEGER) AS c, round(s + CASE c WHEN 0 THEN 0.5 ELSE -0.25 END, 6) AS v FROM (
SELECT image_id, y, x, co AS c, sum(v * CAST(w AS DOUBLE)) AS s FROM rgb_pixels r JOIN {_values(_MIX, "ci, co, w")} ON r.c = ci GROUP BY ALL) z""", "rgb_pixels")
def channel_mix(rgb):
    return R.channel_mix(rgb, _MIX, _BIAS2).withColumn("v", F.round("v", 6))


_UP = [(dy, dx, 0, 0, (1 + 2 * dy + dx) / 4) for dy in (0, 1) for dx in (0, 1)]


@_query(f"SELECT image_id, CAST(2 * y + dy AS INTEGER) AS y, CAST(2 * x + dx AS INTEGER) AS x, 0 AS c, round(v * CAST(w AS DOUBLE) + 0.5, 6) AS v FROM raster8, {_values(_UP, 'dy, dx, ci, co, w')}", "raster8")
def upsample2_kernel(raster8):
    return R.upsample2_kernel(raster8.withColumn("c", F.lit(0)), _UP, [0.5]).withColumn("v", F.round("v", 6))


_UP2 = [(dy, dx, ci, co, (1 + 2 * dy + dx - ci + 2 * co) / 8) for dy in (0, 1) for dx in (0, 1) for ci in (0, 1) for co in (0, 1)]
_MIX2 = [(0, 0, 0.5), (1, 0, -0.25), (0, 1, 0.75), (1, 1, 1.0), (1, 2, -0.5)]


_BIASED = "s + CASE c WHEN 0 THEN 0.5 ELSE -0.25 END"


@_query(f"""WITH conv AS (SELECT image_id, y, x, c, greatest({_BIASED}, 0) AS v FROM (SELECT image_id, y - dy AS y, x - dx AS x, co AS c, sum(v * CAST(w AS DOUBLE)) AS s
  FROM raster8, {_values(_KERNEL3, "dy, dx, ci, co, w")} GROUP BY ALL) a WHERE y BETWEEN 0 AND 7 AND x BETWEEN 0 AND 7
), pool AS (SELECT image_id, y // 2 AS y, x // 2 AS x, c, max(v) AS v FROM conv GROUP BY ALL
), up AS (SELECT image_id, y, x, c, {_BIASED} AS v FROM (SELECT image_id, 2 * y + dy AS y, 2 * x + dx AS x, co AS c, sum(v * CAST(w AS DOUBLE)) AS s FROM pool JOIN {_values(_UP2, "dy, dx, ci, co, w")} ON c = ci GROUP BY ALL) a
), conv2 AS (SELECT image_id, y, x, c, {_BIASED} AS v FROM (SELECT image_id, y - dy AS y, x - dx AS x, co AS c, sum(v * CAST(w AS DOUBLE)) AS s
  FROM up JOIN {_values(_KERNEL3, "dy, dx, ci, co, w")} ON c = ci GROUP BY ALL) a WHERE y BETWEEN 0 AND 7 AND x BETWEEN 0 AND 7)
SELECT image_id, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, CAST(c AS INTEGER) AS c, round(s + CASE c WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 ELSE -1.0 END, 6) AS v
FROM (SELECT image_id, y, x, co AS c, sum(v * CAST(w AS DOUBLE)) AS s FROM conv2 JOIN {_values(_MIX2, "ci, co, w")} ON c = ci GROUP BY ALL) m""", "raster8")
def stencil_chain(raster8):
    """Convolution, activation, pooling, upsampling, convolution and mixing in one exchange; tiles of three, so every frame has edges."""
    chain = [St.conv3(_KERNEL3, _BIAS2), St.relu(), St.pool2(), St.upsample2(_UP2, _BIAS2), St.conv3([(*k[:2], 0, *k[3:]) for k in _KERNEL3], _BIAS2), St.mix(_MIX2, [1.0, 0.0, -1.0])]
    tiles = P.pack(raster8, tile=3).withColumns({"frame_h": F.lit(8), "frame_w": F.lit(8)})
    return St.to_values(St.stencil_chain(tiles, chain, 3)).withColumn("v", F.round("v", 6))


# --- masks as runs ---


def _islands_sql(pixels: str) -> str:
    return f"SELECT image_id, y, min(x) AS x0, max(x) + 1 AS x1 FROM (SELECT *, x - row_number() OVER (PARTITION BY image_id, y ORDER BY x) AS g FROM {pixels}) i GROUP BY image_id, y, g"


_dark = lambda a: a != 255


@_query(_islands_sql("(SELECT image_id, y, x FROM mask_pixels WHERE v <> 255)"), "mask_pixels")
def mask_runs(pixels):
    return Runs.listed(Runs.from_tiles(P.pack(pixels, tile=7), _dark))


@_query(_islands_sql(f"(SELECT DISTINCT p.image_id, y, x FROM mask_pixels p JOIN {_TILES} t ON p.image_id = t.image_id AND y >= tile_y0 AND y < y1 AND x >= tile_x0 AND x < x1 WHERE v <> 255 AND (tile_y0 + tile_x0) % 2 = 0)"), "mask_pixels", "plots")
def merge_runs(pixels, plots):
    """``merge_tiles_max`` for binary tiles, as a union of their runs."""
    tiles = P.cut_overlapping(P.pack(pixels), plots, 3)
    scored = P.map_tiles(tiles, lambda row: [(row[0], row[1], row[2], ((row[3] != 255) & ((row[1] + row[2]) % 2 == 0)).astype("uint8"))])
    return Runs.listed(Runs.from_tiles(scored))


@_query("""SELECT image_id, tp, fp, fn, round(tp * 1.0::DOUBLE / (tp + fp + fn), 6) AS iou FROM (
SELECT image_id, count(*) FILTER (a AND b) AS tp, count(*) FILTER (a AND NOT b) AS fp, count(*) FILTER (b AND NOT a) AS fn FROM (
SELECT t.image_id, coalesce(s.v <> 255, false) AS a, t.v <> 255 AS b FROM mask_pixels t LEFT JOIN mask_pixels s ON s.image_id = t.image_id AND s.y = t.y - 1 AND s.x = t.x - 2) p GROUP BY image_id) c WHERE tp + fp + fn > 0""", "mask_pixels", "plots")
def iou_runs(pixels, plots):
    """A mask against itself, moved and cut to the frame."""
    target = Runs.from_pixels(pixels, B.foreground(F.col("v"), "dark"))
    frames = plots.select("image_id", F.lit(0).alias("x0"), F.lit(0).alias("y0"), F.col("width").alias("x1"), F.col("height").alias("y1"))
    counts = Runs.overlap_counts(Runs.clip(Runs.shift(target, F.lit(1), F.lit(2)), frames), target)
    return counts.select("image_id", "tp", "fp", "fn", F.round(M.iou(*[F.col(c).cast("double") for c in ("tp", "fp", "fn")]), 6).alias("iou"))


# --- models and whole plans ---


@_query("SELECT image_id, CAST(p AS INTEGER) AS p, 0.5::DOUBLE * v - 0.25::DOUBLE * target + 0.125::DOUBLE AS logit FROM (SELECT image_id, y * 8 + x AS p, v, target FROM raster8) r", "raster8")
def score_frames(raster8):
    # Bytes and dyadic weights, so that single precision is exact.
    cells = raster8.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct((F.col("y") * 8 + F.col("x")).alias("p"), F.col("v").cast("float").alias("a"), F.col("target").cast("float").alias("b")))).alias("cells"))
    plane = cells.select("image_id", F.concat(F.transform("cells", lambda c: c["a"]), F.transform("cells", lambda c: c["b"])).alias("plane"))
    scored = Model.score_frames(plane, Model.linear_model([0.5, -0.25], 0.125), [2, 64])
    return scored.select("image_id", F.posexplode("logits").alias("p", "l")).select("image_id", "p", F.col("l").cast("double").alias("logit"))


def _plot_detections(plots):
    near = plots.where("r >= 0").select("image_id", (F.col("cx") - 4.3).alias("x_min"), (F.col("cy") - 4.7).alias("y_min"), (F.col("cx") + 9.9).alias("x_max"), (F.col("cy") + 8.2).alias("y_max"), F.lit(0.75).alias("conf"))
    far = near.select("image_id", (F.col("x_min") + 1).alias("x_min"), "y_min", "x_max", "y_max", F.lit(0.5).alias("conf"))
    return near.unionByName(far)


@_query("""SELECT p.image_id, y, x, CASE WHEN v <> 255 AND x >= greatest(CAST(trunc(cx - 4.3) AS INTEGER), 0) AND x < CAST(trunc(cx + 9.9) AS INTEGER) AND y >= greatest(CAST(trunc(cy - 4.7) AS INTEGER), 0) AND y < CAST(trunc(cy + 8.2) AS INTEGER) THEN 1 ELSE 0 END AS v
FROM mask_pixels m JOIN plots p USING (image_id) WHERE r >= 0""", "plots", "mask_pixels")
def segment_pipeline(plots, masks):
    score = lambda d: d.withColumn("pred", B.foreground(F.col("v"), "dark").cast("int"))
    return segment.segment_pipeline(masks, plots.select("image_id", "width", "height"), _plot_detections(plots), score, limit=12, overlap=1)[0]


_SEGMENTED = _ORACLE["segment_pipeline"]
_FOUND = {"limit": 12, "overlap": 1}


def segment_pipeline_packed(spark, sf_dir):
    """The same plan on packed tiles, each scored whole by a model made once per worker."""
    plots, masks = fixture(spark, sf_dir, "plots"), fixture(spark, sf_dir, "mask_pixels")
    out, _ = segment.segment_tiles(P.pack(masks, tile=8), plots.select("image_id", "width", "height"), _plot_detections(plots), _dark_model, tile=8, **_FOUND)
    return P.to_pixels(out)


def segment_files(spark, sf_dir):
    """From image files to mask files: listing, decoding, segmenting, writing, and reading the masks back."""
    plots, masks = fixture(spark, sf_dir, "plots"), fixture(spark, sf_dir, "mask_pixels")
    folder, out = session.shared_path(spark, "photos"), session.shared_path(spark, "segmented")
    sinks.write_png(sinks.pack_pixels(masks.withColumn("c", F.lit(0))).withColumn("name", F.format_string("img_%08d", "image_id")), folder)
    segment.segment_files(spark, folder, out, _plot_detections(plots), _dark_model, **_FOUND)
    shown = images.with_image_id(images.read_frames(spark, f"{out}/masks"))
    return images.to_pixels(shown, ["image_id"]).select("image_id", "y", "x", (F.col("v") / 255).cast("int").alias("v"))


def _dark_model():
    """A model of planes: 1 where a byte isn't background."""
    return lambda plane: (plane != 255).astype(np.uint8)


for _f in (segment_pipeline_packed, segment_files):
    _QUERIES[_f.__name__], _ORACLE[_f.__name__] = _f, _SEGMENTED

_LARGE9 = f"(SELECT * FROM {_BOX} b WHERE x1 - x0 > 9 OR y1 - y0 > 9)"


@_query(f"""SELECT 'mask' AS side, image_id, y, x, 0 AS c, v FROM ({_PAD9} UNION ALL
SELECT e.image_id, CAST(gy.y AS INTEGER), CAST(gx.x AS INTEGER), m.v FROM {_LARGE9} e, {_GRID9}
JOIN mask_pixels m ON m.image_id = e.image_id AND m.x = e.x0 + floor((gx.x + 0.5) * (e.x1 - e.x0) / 9) AND m.y = e.y0 + floor((gy.y + 0.5) * (e.y1 - e.y0) / 9)) a
UNION ALL
SELECT 'image', e.image_id, CAST(gy.y AS INTEGER), CAST(gx.x AS INTEGER), CAST(ch.c AS INTEGER), coalesce(m.v, 0) FROM {_EXT9} e, {_GRID9}, (SELECT unnest(range(0, 3)) AS c) ch
LEFT JOIN rgb_pixels m ON m.image_id = e.image_id AND m.c = ch.c AND m.x = gx.x - (9 - (e.x1 - e.x0)) // 2 + e.x0 AND m.y = gy.y - (9 - (e.y1 - e.y0)) // 2 + e.y0 AND m.x >= e.x0 AND m.x < e.x1 AND m.y >= e.y0 AND m.y < e.y1
WHERE e.w <= 9 AND e.h <= 9
UNION ALL
SELECT 'image', image_id, y, x, c, CAST(least(greatest(floor(round(s, 6) + 0.5), 0), 255) AS INTEGER) FROM (
SELECT o.image_id, o.c, CAST(b.dst AS INTEGER) AS y, CAST(a.dst AS INTEGER) AS x, sum(o.v * a.w * b.w) AS s FROM (
SELECT r.image_id, c, y - y0 AS y, x - x0 AS x, v, x1 - x0 AS w, y1 - y0 AS h FROM rgb_pixels r JOIN {_LARGE9} e USING (image_id) WHERE x >= x0 AND x < x1 AND y >= y0 AND y < y1) o
JOIN {_weights_sql("lanczos", "(x1 - x0)", "9", _LARGE9)} a ON o.w = a.n_src AND o.x = a.src JOIN {_weights_sql("lanczos", "(y1 - y0)", "9", _LARGE9)} b ON o.h = b.n_src AND o.y = b.src GROUP BY ALL) z""", "plots", "mask_pixels", "rgb_pixels")
def prepare_files(plots, masks, rgb):
    """From a folder of photographs and one of masks to pairs of the target size; tiles of 7, so that every frame has several."""
    spark = plots.sparkSession
    given, out = session.shared_path(spark, "pairs"), session.shared_path(spark, "prepared")
    named = lambda df: df.withColumn("name", F.format_string("img_%08d", "image_id"))
    sinks.write_png(named(sinks.pack_pixels(rgb)), f"{given}/images")
    sinks.write_png(named(sinks.pack_pixels(masks.withColumn("c", F.lit(0)))), f"{given}/masks")
    photographs.prepare_files(spark, f"{given}/images", f"{given}/masks", out, 9, "*.png", tile=7)
    read = lambda side: images.with_image_id(images.read_frames(spark, f"{out}/{side}s")).withColumn("side", F.lit(side))
    return images.to_pixels(images.decode_rgb(read("image")), ["side", "image_id"]).unionByName(images.to_pixels(read("mask"), ["side", "image_id"]))

_FEATURES = ["logit", "v"]


@_query(None, "raster8")
def fit_pixel_classifier(raster8):
    model = Model.fit_pixel_classifier(raster8, _FEATURES)
    return Model.score_pixels(model, raster8, _FEATURES, "fitted").select("image_id", "y", "x", "fitted")


@_query(None, "raster8")
def train_val_loop(raster8):
    rows = _batched(raster8)
    return Model.train_val_loop(rows.where("image_id % 5 <> 4"), rows.where("image_id % 5 = 4").drop("logit").withColumn("logit", F.col("v") / 255.0 - 0.5), ["v"])[1]


@_query(None, "raster8")
def train_batches(raster8):
    """Batches of a hundred and twenty-eight images."""
    rows = raster8.withColumns({"batch_id": F.floor(F.col("image_id") / 128).cast("long"), "share": F.col("v") / 255.0})
    folder = session.shared_path(raster8.sparkSession, "training")
    return Model.train_batches(rows.where("image_id % 5 <> 4"), rows.where("image_id % 5 = 4"), ["share", "logit"], folder, 3, 0.05)[1]


# --- sinks, read back ---


def _written(frames: DataFrame, kind: str) -> DataFrame:
    """The frames as PNG files, read back through the image source as long pixels."""
    spark = frames.sparkSession
    folder = session.shared_path(spark, kind)
    sinks.write_png(frames.withColumn("name", F.format_string("img_%08d", "image_id")), folder)
    good, _ = images.split_frames(images.read_frames(spark, folder))
    return images.to_pixels(images.decode_rgb(images.with_image_id(good)), ["image_id"])


@_query("SELECT image_id, y, x, c, v FROM rgb_pixels", "rgb_pixels")
def decode_rgb(rgb):
    return _written(sinks.pack_pixels(rgb), "decode")


@_query("SELECT image_id, y, x, CAST((r * 19595 + g * 38470 + b * 7471 + 32768) >> 16 AS INTEGER) AS v FROM (SELECT image_id, y, x, max(v) FILTER (c = 0) AS r, max(v) FILTER (c = 1) AS g, max(v) FILTER (c = 2) AS b FROM rgb_pixels GROUP BY ALL) p", "rgb_pixels")
def decode_gray(rgb):
    return R.decode_gray(rgb)


@_query("SELECT image_id, y, x, CAST(c AS INTEGER) AS c, CASE WHEN v <> 255 THEN 255 ELSE 0 END AS v FROM (SELECT *, unnest(range(0, 3)) AS c FROM mask_pixels) m", "mask_pixels")
def sink_mask_png(masks):
    spark = masks.sparkSession
    folder = session.shared_path(spark, "masks")
    packed = sinks.pack_pixels(_m01(masks).withColumn("c", F.lit(0)), "m").withColumn("stem", F.format_string("img_%08d", "image_id"))
    sinks.sink_mask_png(packed, folder, "stem")
    return images.to_pixels(images.decode_rgb(images.with_image_id(images.read_frames(spark, folder))), ["image_id"])


@_query(f"SELECT image_id, y, x, c, v FROM {_OVER} o", "rgb_pixels", "mask_pixels")
def sink_overlay_png(rgb, masks):
    return _written(sinks.pack_pixels(R.overlay_green(rgb.select("image_id", "y", "x", "c", "v"), _m01(masks))), "overlay")


@_query("SELECT image_id, y, x, c, v FROM rgb_pixels UNION ALL SELECT image_id, y, x + width, CAST(c AS INTEGER), CASE WHEN v <> 255 THEN 255 ELSE 0 END FROM (SELECT *, unnest(range(0, 3)) AS c FROM mask_pixels) m", "rgb_pixels", "mask_pixels")
def sink_side_by_side_png(rgb, masks):
    return _written(sinks.pack_pixels(R.side_by_side(rgb, _m01(masks))), "side")


@_query("SELECT 'image' AS side, image_id, y, x, c, v FROM rgb_pixels UNION ALL SELECT 'mask', image_id, y, x, CAST(c AS INTEGER), v FROM (SELECT *, unnest(range(0, 3)) AS c FROM mask_pixels) m", "rgb_pixels", "mask_pixels")
def sink_pairs(rgb, masks):
    a = _written(sinks.pack_pixels(rgb), "pair-images").withColumn("side", F.lit("image"))
    b = _written(sinks.pack_pixels(masks.withColumn("c", F.lit(0))), "pair-masks").withColumn("side", F.lit("mask"))
    return a.unionByName(b)


@_query("SELECT epoch, CAST(printf('%.4f', avg(train_loss)) AS DOUBLE) AS train_loss FROM epoch_metrics GROUP BY epoch", "epoch_metrics")
def sink_metrics(metrics):
    spark = metrics.sparkSession
    folder = session.shared_path(spark, "metrics")
    sinks.sink_metrics(metrics.groupBy("epoch").agg(F.avg("train_loss").alias("train_loss")), folder)
    return sinks.read_metrics(spark, folder, "epoch int, train_loss double")


@_query(f"SELECT 32 AS batch_size, count(*) FILTER (subset = 'train') AS train_size, count(*) FILTER (subset = 'val') AS val_size FROM ({_SPLIT}) s", "paths")
def sink_run_summary(paths):
    spark = paths.sparkSession
    folder = session.shared_path(spark, "summary")
    sinks.sink_run_summary(L.dataset_summary(L.split_exact(paths.where("role = 'image'")), 0.0001, 32, 10), folder)
    return spark.read.schema("batch_size int, train_size long, val_size long").json(folder)


@_query(None, "raster8")
def sink_model(raster8):
    from pyspark.ml.classification import LogisticRegressionModel

    spark = raster8.sparkSession
    model = Model.fit_pixel_classifier(raster8, _FEATURES, 5)
    path = sinks.sink_model(model, session.shared_path(spark, "model"), "2024-01-15")
    again = LogisticRegressionModel.load(path)
    return Model.score_pixels(again, raster8, _FEATURES, "fitted").select("image_id", "y", "x", "fitted")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
