"""Boxes over frames. Boxes are half-open: x0 <= x < x1."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chunks as C


def foreground(v: Column, convention: str) -> Column:
    """Whether a mask byte is foreground. ``dark``: everything but 255 (preparation); ``bright``: 128 and more (training)."""
    if convention == "dark":
        return v != 255
    if convention == "bright":
        return v >= 128
    raise ValueError("foreground convention is dark or bright")


def mask_bbox(pixels: DataFrame, convention: str, keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """Box of the foreground of each frame; frames without any have no row."""
    kept = pixels.where(foreground(F.col("v"), convention))
    return kept.groupBy(*keys).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1"))


def skip_empty_masks(frames: DataFrame, boxes: DataFrame, keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """Frames that have no box, with the reason."""
    return frames.join(boxes, list(keys), "left_anti").withColumn("reason", F.lit("no_foreground"))


def _wider(low: str, high: str, side: str, target: int) -> tuple[Column, Column]:
    extra = F.greatest(F.lit(target) - (F.col(high) - F.col(low)), F.lit(0))
    before = F.floor(extra / 2).cast("int")
    return F.greatest(F.lit(0), F.col(low) - before), F.least(F.col(side), F.col(high) + (extra - before))


def extend_box(boxes: DataFrame, target: int | tuple[int, int]) -> DataFrame:
    """Boxes of frames (width, height) made up to the target, half of what lacks on either side (the odd one behind).

    What falls outside the frame is lost, not moved to the other side. A side at or over the target stays."""
    tw, th = (target, target) if isinstance(target, int) else target
    x0, x1 = _wider("x0", "x1", "width", tw)
    y0, y1 = _wider("y0", "y1", "height", th)
    return boxes.withColumns({"x0": x0, "y0": y0, "x1": x1, "y1": y1})


def pad_offsets(boxes: DataFrame, target: int | tuple[int, int]) -> DataFrame:
    """``off_x`` and ``off_y``: where a smaller box goes on a canvas of the target size, in the middle."""
    tw, th = (target, target) if isinstance(target, int) else target
    return boxes.withColumns({"off_x": F.floor((F.lit(tw) - (F.col("x1") - F.col("x0"))) / 2).cast("int"), "off_y": F.floor((F.lit(th) - (F.col("y1") - F.col("y0"))) / 2).cast("int")})


def trunc_box(detections: DataFrame) -> DataFrame:
    """Real box sides cut to integers, toward zero."""
    return detections.withColumns({c: F.col(c).cast("int") for c in ("x_min", "y_min", "x_max", "y_max")})


def clamp_box(boxes: DataFrame, width: Column, height: Column) -> DataFrame:
    """Boxes cut to the frame, so that pasting back always fits."""
    inside = lambda c, most: F.least(F.greatest(F.col(c), F.lit(0)), most)
    return boxes.withColumns({"x_min": inside("x_min", width), "x_max": inside("x_max", width), "y_min": inside("y_min", height), "y_max": inside("y_max", height)})


def top1_detection(detections: DataFrame, tie_break: Sequence[str] = (), keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """The most confident box of each frame; ties go to the smallest of ``tie_break``, then of the box itself.

    A partial aggregate, so a frame with very many boxes is reduced before the shuffle."""
    sides = ["x_min", "y_min", "x_max", "y_max"]
    rank = F.struct((-F.col("conf")).alias("_c"), *[F.col(c) for c in tie_break], *[F.col(c) for c in sides])
    rest = [c for c in detections.columns if c not in keys]
    best = detections.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def attach_detection(frames: DataFrame, detections: DataFrame, tie_break: Sequence[str] = (), keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """Every frame with its best box, nulls where it has none."""
    return frames.join(top1_detection(detections, tie_break, keys), list(keys), "left")


def no_detection_filter(attached: DataFrame, strict: bool = False) -> DataFrame:
    """``reason``: no_detection where a frame has no box, else empty; with ``strict`` such a frame fails the job."""
    missing = F.col("conf").isNull()
    reason = F.when(missing, F.raise_error(F.concat(F.lit("no detection for image "), F.col("image_id").cast("string")))) if strict else F.when(missing, F.lit("no_detection"))
    return attached.withColumn("reason", reason.otherwise(F.lit("")))


def crop_by_box(pixels: DataFrame, boxes: DataFrame, keys: Sequence[str] = ("image_id",), shift: bool = True) -> DataFrame:
    """Pixels inside their frame's box (x0, y0, x1, y1), counted from its corner if ``shift``.

    Pixels travel as chunks if all their columns are numbers."""
    rest = [c for c in pixels.columns if c not in keys]
    if len(keys) > 1 or not C.fits(pixels, pixels.columns) or not C.fits(boxes, ["x0", "y0", "x1", "y1"]):
        met = pixels.join(boxes.select(*keys, "x0", "y0", "x1", "y1").hint("merge"), list(keys))
        inside = met.where((F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1")))
        if shift:
            inside = inside.withColumns({"x": F.col("x") - F.col("x0"), "y": F.col("y") - F.col("y0")})
        return inside.drop("x0", "y0", "x1", "y1")
    kinds = [pixels.schema[c].dataType.simpleString() for c in (*keys, *rest)]
    out, iy, ix = C.pa_types(kinds), rest.index("y"), rest.index("x")

    def cut(ids: np.ndarray, g: np.ndarray, columns: list[np.ndarray], sides: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x0, y0, x1, y1 = (s[g] for s in sides)
        y, x = columns[iy], columns[ix]
        inside = np.flatnonzero((x >= x0) & (x < x1) & (y >= y0) & (y < y1))
        if len(inside):
            part = [c[inside] for c in columns]
            if shift:
                part[iy], part[ix] = part[iy] - y0[inside], part[ix] - x0[inside]
            yield pa.RecordBatch.from_arrays([C.array(c, k) for c, k in zip([ids[g[inside]], *part], out, strict=True)], [*keys, *rest])

    schema = ", ".join(f"`{n}` {'double' if k.startswith('decimal') else k}" for n, k in zip((*keys, *rest), kinds, strict=True))
    made = C.boxed(pixels, boxes, rest, ["x0", "y0", "x1", "y1"], cut, schema, keys)
    return made.select(*[F.col(n).cast(k) if k.startswith("decimal") else F.col(n) for n, k in zip((*keys, *rest), kinds, strict=True)])


def quarantine(frames: DataFrame, checks: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the first reason that applies)."""
    reason = F.lit(None).cast("string")
    for name, failed in reversed(checks):
        reason = F.when(failed, name).otherwise(reason)
    marked = frames.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")
