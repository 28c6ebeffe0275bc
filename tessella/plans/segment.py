"""Whole plans composed of operators: batch inference on large frames, and pair preparation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import boxes as B
from ..operators import packed as P
from ..operators import tiling as T
from ..operators.rasterops import fit_to_target
from ..session import materialise
from ..sources import sinks
from .photographs import decode_tiles, list_photographs


def _boxed(frames: DataFrame, detections: DataFrame, limit: int, overlap: int, tie_break: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(box of each frame to segment, size and route of its crop, frames left out with the reason), from metadata alone.

    A frame is left out if it has no detection, if its box is empty once cut to the frame, or if its tiles' step isn't positive."""
    attached = B.no_detection_filter(B.attach_detection(frames, detections, tie_break))
    cut = B.clamp_box(B.trunc_box(attached.where("reason = ''")), F.col("width"), F.col("height"))
    cut = cut.select("image_id", F.col("x_min").alias("x0"), F.col("y_min").alias("y0"), F.col("x_max").alias("x1"), F.col("y_max").alias("y1"))
    some = (F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0"))
    sizes = T.route_by_size(cut.where(some).select("image_id", (F.col("x1") - F.col("x0")).alias("width"), (F.col("y1") - F.col("y0")).alias("height")), limit)
    bad = T.bad_tile_steps(sizes.where("route = 'tiled'"), overlap).select("image_id", "reason")
    left_out = attached.where("reason <> ''").select("image_id", "reason").unionByName(cut.where(~some).select("image_id", F.lit("empty_box").alias("reason"))).unionByName(bad)
    sizes = sizes.join(bad.select("image_id"), "image_id", "left_anti")
    return cut.where(some).join(sizes.select("image_id"), "image_id"), sizes, left_out


def segment_pipeline(pixels: DataFrame, frames: DataFrame, detections: DataFrame, score: Callable[[DataFrame], DataFrame], limit: int, overlap: int, tie_break: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(full-frame masks (image_id, y, x, v), frames left out with the reason); every frame is in just one of them.

    Best box per frame, crop, route by size, score directly or tile by tile, merge by maximum, paste into the frame.
    ``score`` adds ``pred`` (0/1) to pixels (image_id, y, x, v). One lazy plan, nothing collected."""
    box, sizes, left_out = _boxed(frames, detections, limit, overlap, tie_break)
    crops = B.crop_by_box(pixels.select("image_id", "y", "x", "v"), box).join(sizes, "image_id")
    direct = score(crops.where("route = 'direct'").select("image_id", "y", "x", "v")).select("image_id", "y", "x", "pred")
    tiled = T.assign_tiles(crops.where("route = 'tiled'").select("image_id", "width", "height", "y", "x", "v"), overlap)
    merged = T.merge_tiles_max(score(tiled).select("image_id", "y", "x", "pred"))
    masks = T.paste_to_frame(direct.unionByName(merged), box, frames.join(box.select("image_id"), "image_id", "left_semi"), "pred").withColumnRenamed("pred", "v")
    return masks, left_out


def segment_tiles(tiles: DataFrame, frames: DataFrame, detections: DataFrame, make_predict: Callable, limit: int = 4000, overlap: int = 500, tie_break: Sequence[str] = (), tile: int = P.TILE) -> tuple[DataFrame, DataFrame]:
    """``segment_pipeline`` on packed tiles of the fixed grid: (tiles of full-frame masks, frames left out with the reason).

    The model (``make_predict()``, from a plane of bytes to one of 0/1) gets crops under ``limit`` whole and larger ones in
    overlapping tiles of half their sides. A row is never larger than a crop under the limit or a half of a larger one."""
    box, sizes, left_out = _boxed(frames, detections, limit, overlap, tie_break)
    return _segmented(tiles, frames.join(box.select("image_id"), "image_id", "left_semi"), box, sizes, make_predict, limit, overlap, tile), left_out


def _segmented(tiles: DataFrame, frames: DataFrame, box: DataFrame, sizes: DataFrame, make_predict: Callable, limit: int, overlap: int, tile: int) -> DataFrame:
    crops = P.crop(tiles, box)
    of = lambda route: crops.join(sizes.where(F.col("route") == route).select("image_id"), "image_id", "left_semi")
    direct = P.merge_max(of("direct"), limit)  # a crop under the limit lies in one cell of so large a grid
    tiled = P.cut_overlapping(of("tiled"), sizes.where("route = 'tiled'"), overlap)
    merged = P.merge_max(P.score(direct.unionByName(tiled), make_predict), tile)
    return P.paste(merged, box, frames, tile)


def segment_files(spark: SparkSession, folder: str, out: str, detections: DataFrame, make_predict: Callable, limit: int = 4000, overlap: int = 500, pattern: str = "*.png", masks: bool = True, overlays: bool = False, side_by_side: bool = False, recursive: bool = False, colour: bool = False) -> DataFrame:
    """The plan from image files to files: (image_id, path, reason) of the photographs left out.

    ``detections`` name their photograph by ``path`` (as listed), by ``name`` (the path below the folder without its suffix) or by
    ``image_id`` (the first digits of the file's name; of several files with the same digits none is taken). Sizes and routes come from
    headers, so that only photographs with a box are decoded, each once, into written tiles; all outputs are made of these.
    The model gets gray planes, or RGB with ``colour``. ``out`` gets ``masks`` (black and white), ``overlays`` (green over the
    photograph) and ``side_by_side``, as switched on, each file under its photograph's name below the folder."""
    listed = list_photographs(spark, folder, pattern, recursive).withColumnRenamed("image_id", "_id")
    by = next(c for c in ("path", "name", "image_id") if c in detections.columns)
    digits = F.expr("try_cast(regexp_extract(element_at(split(name, '/'), -1), '([0-9]+)', 1) AS bigint)")
    listed = listed.withColumn("image_id", digits if by == "image_id" else F.lit(None).cast("long"))
    if by == "image_id":
        alike = F.count("*").over(Window.partitionBy("image_id"))
        listed = listed.withColumn("reason", F.coalesce("reason", F.when(F.col("image_id").isNotNull() & (alike > 1), F.lit("same_digits"))))
    listed = materialise(listed.withColumn("same", F.col("reason") == "same_digits"), "listed")
    good = listed.where("reason IS NULL").select(F.col("_id"), F.col(by).alias("_by"), "name", "path", "height", "width")
    boxes = detections.select(*[c for c in detections.columns if c != by], F.col(by).alias("_by")).join(good.select("_id", "_by"), "_by").drop("_by", "image_id").withColumnRenamed("_id", "image_id")
    frames = good.select(F.col("_id").alias("image_id"), "name", "path", "height", "width")
    box, sizes, left_out = _boxed(frames.select("image_id", "height", "width"), boxes, limit, overlap, ())
    box, sizes, left_out = (materialise(x, n) for x, n in ((box, "boxes"), (sizes, "sizes"), (left_out, "left-out")))
    tiles, broken = decode_tiles(spark, folder, frames.join(box.select("image_id"), "image_id", "left_semi"), pattern, recursive)
    seen = tiles if colour else P.planes(tiles, P.gray)
    shown = frames.join(box.select("image_id"), "image_id", "left_semi").join(broken, "image_id", "left_anti")
    found = materialise(_segmented(seen, shown, box, sizes, make_predict, limit, overlap, P.TILE), "masks")
    named = shown.select("image_id", "name", "height", "width")

    def write(parts: DataFrame, kind: str) -> None:
        sinks.write_png(P.whole(parts).join(named.select("image_id", "name"), "image_id"), f"{out}/{kind}")

    if masks:
        write(P.planes(found, lambda a: a * np.uint8(255)), "masks")
    if overlays:
        write(P.overlay_tiles(tiles, found), "overlays")
    if side_by_side:
        right = P.planes(found, lambda a: np.repeat((a * np.uint8(255))[:, :, None], 3, axis=2)).join(named.select("image_id", F.col("width").alias("_w")), "image_id")
        write(tiles.unionByName(right.withColumn("x0", F.col("x0") + F.col("_w")).drop("_w")), "side_by_side")
    gone = left_out.unionByName(broken.withColumn("reason", F.lit("undecodable"))).join(listed.select(F.col("_id").alias("image_id"), F.col("image_id").alias("own"), "path"), "image_id")
    unread = listed.where("reason IS NOT NULL").select("image_id", "path", F.when(F.col("same"), F.col("reason")).otherwise("undecodable").alias("reason"))
    result = gone.select(F.col("own").alias("image_id"), "path", "reason").unionByName(unread)
    return result.withColumn("image_id", F.when(F.col("reason") != "undecodable", F.col("image_id")))


def prepare_pairs(images: DataFrame, masks: DataFrame, frames: DataFrame, target: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(image pixels by channel, mask pixels, skipped frames): every pair at target by target."""
    box = B.mask_bbox(masks, "dark")
    sized = box.join(frames.select("image_id", "width", "height"), "image_id")
    out_mask = fit_to_target(masks, sized, target, 255)
    planes = None
    for c in range(3):
        part = fit_to_target(images.where(F.col("c") == c), sized, target, 0, "lanczos").withColumn("c", F.lit(c))
        planes = part if planes is None else planes.unionByName(part)
    return planes, out_mask, B.skip_empty_masks(frames, box)
