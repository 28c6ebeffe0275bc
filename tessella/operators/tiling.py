"""Routing by size, overlapping tiles, merging and pasting back. Grids come from metadata; pixels are met by arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C


def route_by_size(frames: DataFrame, limit: int = 4000) -> DataFrame:
    """``route``: direct if both sides are under the limit, else tiled."""
    return frames.withColumn("route", F.when((F.col("height") < limit) & (F.col("width") < limit), "direct").otherwise("tiled"))


def with_steps(frames: DataFrame, overlap: int) -> DataFrame:
    """``tile_h``, ``tile_w`` (half of each side) and the steps between tiles."""
    half = lambda c: F.floor(F.col(c) / 2).cast("int")
    return frames.withColumns({"tile_h": half("height"), "tile_w": half("width"), "step_h": half("height") - overlap, "step_w": half("width") - overlap})


def bad_tile_steps(frames: DataFrame, overlap: int) -> DataFrame:
    """Frames that can't be tiled since a step isn't positive, with the reason."""
    return with_steps(frames, overlap).where("step_h <= 0 or step_w <= 0").withColumn("reason", F.lit("bad_tile_step"))


def tile_grid(frames: DataFrame, overlap: int = 500) -> DataFrame:
    """(image_id, y0, x0, y1, x1) of every tile; frames with a step that isn't positive have none."""
    sized = with_steps(frames, overlap).where("step_h > 0 and step_w > 0 and height > 0 and width > 0")
    rows = sized.withColumn("y0", F.explode(F.sequence(F.lit(0), F.col("height") - 1, F.col("step_h"))))
    rows = rows.withColumn("x0", F.explode(F.sequence(F.lit(0), F.col("width") - 1, F.col("step_w"))))
    return rows.select("image_id", "y0", "x0", F.least(F.col("y0") + F.col("tile_h"), F.col("height")).alias("y1"), F.least(F.col("x0") + F.col("tile_w"), F.col("width")).alias("x1"))


def _covering(rows: DataFrame, at: str, tile: str, step: str, into: str) -> DataFrame:
    """A row for each tile that covers a place: multiples of the step from place - tile + 1 to place."""
    rows = rows.withColumns({"_first": F.expr(f"cast(greatest(0, ({at} - {tile} + {step}) div {step}) AS int)"), "_last": F.expr(f"cast({at} div {step} AS int)")})
    rows = rows.where("_first <= _last").withColumn("_i", F.explode(F.sequence("_first", "_last")))
    return rows.withColumn(into, F.col("_i") * F.col(step)).drop("_first", "_last", "_i")


def assign_tiles(pixels: DataFrame, overlap: int) -> DataFrame:
    """A row for each pixel and tile that covers it (tile_y0, tile_x0), for pixels that carry width and height.

    The tiles of a pixel are computed, not joined."""
    sized = with_steps(pixels, overlap).where("step_h > 0 and step_w > 0")
    rows = _covering(_covering(sized, "y", "tile_h", "step_h", "tile_y0"), "x", "tile_w", "step_w", "tile_x0")
    return rows.drop("tile_h", "tile_w", "step_h", "step_w")


def merge_tiles_max(predictions: DataFrame, value: str = "pred", keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """Overlapping predictions in frame coordinates to one by the maximum, at least 0. Whole numbers meet by place as chunks."""
    kind = predictions.schema[value].dataType.simpleString()
    if list(keys) == ["image_id"] and kind in ("int", "bigint") and C.fits(predictions, ["image_id", "y", "x"]):

        def most(places: list[np.ndarray], number: np.ndarray, v: np.ndarray) -> list[pa.Array]:
            out = np.zeros(len(places[0]), np.int64)
            np.maximum.at(out, number, v)
            return [C.array(out, C.pa_types([kind])[0])]

        return C.by_place(predictions.select("image_id", "y", "x", value), [value], most, [f"{value} {kind}"])
    return predictions.groupBy(*keys, "y", "x").agg(F.greatest(F.max(value), F.lit(0)).alias(value))


def frame_grid(frames: DataFrame) -> DataFrame:
    """Every place (image_id, y, x) of frames with width and height."""
    rows = frames.where("height > 0 and width > 0").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("height") - 1)))
    return rows.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))


def paste_to_frame(crops: DataFrame, boxes: DataFrame, frames: DataFrame, value: str = "v", empty: int = 0) -> DataFrame:
    """(image_id, y, x, value): the crop's pixels at their box in a frame that is empty elsewhere."""
    if C.fits(crops, ["image_id", "y", "x", value]):
        moves = boxes.select("image_id", *[F.lit(n).cast("long").alias(k) for k, n in (("y0", -(1 << 62)), ("x0", -(1 << 62)), ("y1", 1 << 62), ("x1", 1 << 62))], F.col("y0").alias("dy"), F.col("x0").alias("dx"))
        return C.placed(crops, moves, frames.select("image_id", "height", "width"), value, empty)
    moved = crops.join(boxes.select("image_id", "x0", "y0"), "image_id").select("image_id", (F.col("y") + F.col("y0")).alias("y"), (F.col("x") + F.col("x0")).alias("x"), F.col(value).alias("_v"))
    grid = frame_grid(frames.select("image_id", "width", "height")).select("image_id", "y", "x")
    return grid.join(moved, ["image_id", "y", "x"], "left").select("image_id", "y", "x", F.coalesce("_v", F.lit(empty)).alias(value))
