"""Operators on pixels in the long form (image_id, y, x, c, v)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from . import chunks as C
from .boxes import crop_by_box, extend_box, pad_offsets
from .chunks import met
from .resample import resize


def swap_channels(pixels: DataFrame) -> DataFrame:
    """BGR to RGB and back."""
    return pixels.withColumn("c", 2 - F.col("c"))


def decode_gray(pixels: DataFrame) -> DataFrame:
    """(image_id, y, x, v): luma of RGB pixels, pixels meet by place as chunks."""
    if not C.fits(pixels, ["image_id", "y", "x", "c", "v"]) or isinstance(pixels.schema["v"].dataType, C._REAL):
        at = lambda c: F.max(F.when(F.col("c") == c, F.col("v")))
        return pixels.groupBy("image_id", "y", "x").agg(S.luma(at(0), at(1), at(2)).cast("int").alias("v"))

    def luma(places: list[np.ndarray], number: np.ndarray, c: np.ndarray, v: np.ndarray) -> list[pa.Array]:
        most = np.full((3, len(places[0])), C.NULL)
        rgb = (c >= 0) & (c < 3)
        np.maximum.at(most, (c[rgb], number[rgb]), v[rgb])
        known = (most != C.NULL).all(axis=0)
        r, g, b = np.where(known, most, 0)
        return [C.array(np.where(known, (r * 19595 + g * 38470 + b * 7471 + 32768) >> 16, C.NULL), pa.int32())]

    return C.by_place(pixels.select("image_id", "y", "x", "c", "v"), ["c", "v"], luma, ["v int"])


def planes(pixels: DataFrame) -> DataFrame:
    """(image_id, plane): values in [0, 1] ordered by channel, row and column; one frame's worth per row."""
    cell = F.struct("c", "y", "x", S.unit_scale(F.col("v")).alias("u"))
    return pixels.groupBy("image_id").agg(F.array_sort(F.collect_list(cell)).alias("_p")).select("image_id", F.transform("_p", lambda p: p["u"].cast("float")).alias("plane"))


def concat_channels(a: DataFrame, b: DataFrame, channels_of_a: int) -> DataFrame:
    return a.unionByName(b.withColumn("c", F.col("c") + channels_of_a))


def max_pool(pixels: DataFrame, height: int, width: int, value: str = "v") -> DataFrame:
    """Maximum of 2x2 blocks; an odd last row or column is dropped."""
    whole = pixels.where((F.col("y") < height // 2 * 2) & (F.col("x") < width // 2 * 2))
    return whole.groupBy("image_id", F.floor(F.col("y") / 2).cast("int").alias("y"), F.floor(F.col("x") / 2).cast("int").alias("x"), "c").agg(F.max(value).alias(value))


Cells = Sequence[tuple[int, int, int, int, float]]


def _weighted(channels: Sequence[int], cells: Cells, c_out: int):
    """Sum of the channels (columns ``_0``, ``_1``, ...) by the weights of cells for one output channel."""
    total = F.lit(0.0)
    for _, _, a, b, w in cells:
        if b == c_out:
            total = total + F.col(f"_{channels.index(a)}") * float(w)
    return total


def _by_place(pixels: DataFrame, channels: Sequence[int], value: str) -> DataFrame:
    """(image_id, y, x, _0, _1, ...): a column for each channel, 0 where a place lacks one. One row a place from here on."""
    own = pixels.where(F.col("c").isin(*channels)).select("image_id", "y", "x", "c", F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias(value))
    if C.fits(pixels, ["image_id", "y", "x", "c", value]):

        def sums(places: list[np.ndarray], number: np.ndarray, c: np.ndarray, v: np.ndarray) -> list[pa.Array]:
            return [pa.array(np.bincount(number[c == k], v[c == k], len(places[0]))) for k in channels]

        return C.by_place(own, ["c", value], sums, [f"_{i} double" for i in range(len(channels))])
    return own.groupBy("image_id", "y", "x").agg(*[F.coalesce(F.sum(F.when(F.col("c") == c, F.col(value).cast("double"))), F.lit(0.0)).alias(f"_{i}") for i, c in enumerate(channels)])


def _kernel_sums(pixels: DataFrame, cells: Cells, value: str):
    """Places with their channels as columns, and an array with a struct (dy, dx, c, s) for each place and output channel fed."""
    channels = sorted({a for _, _, a, _, _ in cells})
    targets = sorted({(dy, dx, b) for dy, dx, _, b, _ in cells})
    structs = [F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(b).alias("c"), _weighted(channels, [k for k in cells if k[:2] == (dy, dx)], b).alias("s")) for dy, dx, b in targets]
    return _by_place(pixels, channels, value).select("image_id", "y", "x", F.inline(F.array(*structs)))


def _bias(bias: Sequence[float], c_out: str = "c"):
    return F.get(F.array(*[F.lit(float(b)) for b in bias]), F.col(c_out))


def focal_conv3(pixels: DataFrame, kernel: Cells, bias: Sequence[float], height: int, width: int, value: str = "v") -> DataFrame:
    """Weighted sum over neighbours and channels with zero padding: cells are (dy, dx, c_in, c_out, w), dy and dx from -1 to 1.

    Places that have a pixel are given. Pixels are dealt by image once; a place looks left and right in its line, then up and
    down in its column, by windows that need no other shuffle. Photographs go through ``packed.focal3``."""
    channels, outputs = sorted({a for _, _, a, _, _ in kernel}), sorted({b for _, _, _, b, _ in kernel})
    rows = _by_place(pixels.repartition("image_id"), channels, value)
    line, column = Window.partitionBy("image_id", "y").orderBy("x"), Window.partitionBy("image_id", "x").orderBy("y")
    beside = {(i, dx): F.last(f"_{i}").over(line.rangeBetween(dx, dx)) if dx else F.col(f"_{i}") for i in range(len(channels)) for dx in (-1, 0, 1)}
    rows = rows.select("image_id", "y", "x", F.struct(*[F.coalesce(v, F.lit(0.0)).alias(f"v{i}_{dx + 1}") for (i, dx), v in beside.items()]).alias("_r1"))
    rows = rows.select("*", *[F.last("_r1").over(column.rangeBetween(dy, dy)).alias(f"_r{dy + 1}") for dy in (-1, 1)])
    read = lambda dy, dx, a: F.coalesce(F.col(f"_r{dy + 1}")[f"v{channels.index(a)}_{dx + 1}"], F.lit(0.0))
    sums = [F.struct(F.lit(b).alias("c"), sum((read(dy, dx, a) * float(w) for dy, dx, a, o, w in kernel if o == b), F.lit(0.0)).alias("_s")) for b in outputs]
    inside = rows.where((F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width))
    return inside.select("image_id", "y", "x", F.inline(F.array(*sums))).select("image_id", "y", "x", "c", (F.col("_s") + _bias(bias)).alias(value))


def channel_mix(pixels: DataFrame, mix: Sequence[tuple[int, int, float]], bias: Sequence[float], value: str = "v") -> DataFrame:
    """Weighted sum over the channels of each place: (c_in, c_out, w)."""
    summed = _kernel_sums(pixels, [(0, 0, a, b, w) for a, b, w in mix], value)
    return summed.select("image_id", "y", "x", "c", (F.col("s") + _bias(bias)).alias(value))


def upsample2_kernel(pixels: DataFrame, kernel: Cells, bias: Sequence[float], value: str = "v") -> DataFrame:
    """Each pixel becomes a 2x2 block weighted by position; cells are (dy, dx, c_in, c_out, w), dy and dx 0 or 1."""
    sent = _kernel_sums(pixels, kernel, value)
    return sent.select("image_id", (2 * F.col("y") + F.col("dy")).alias("y"), (2 * F.col("x") + F.col("dx")).alias("x"), "c", (F.col("s") + _bias(bias)).alias(value))


def greener(v: Column, c: Column, m: Column, strength: int = 191) -> Column:
    """A channel's value with green raised by ``strength`` (and capped) where the mask isn't 0."""
    return F.when((m != 0) & (c == 1), F.least(F.lit(255), v + strength)).otherwise(v)


def overlay_green(rgb: DataFrame, mask: DataFrame, strength: int = 191) -> DataFrame:
    """``greener`` for every pixel with a mask (image_id, y, x, m)."""
    return met(rgb, mask, "m").withColumn("v", greener(F.col("v"), F.col("c"), F.col("m"), strength)).drop("m")


def overlay_mask(rgb: DataFrame, mask: DataFrame, frames: DataFrame, shrink: int = 10) -> DataFrame:
    """The green overlay, shrunk to a ``shrink``-th of each side. Frames smaller than that vanish."""
    sized = frames.withColumns({"out_h": F.floor(F.col("height") / shrink).cast("int"), "out_w": F.floor(F.col("width") / shrink).cast("int")}).where("out_h > 0 and out_w > 0")
    return resize(overlay_green(rgb, mask), sized, "linear", others=("c",))


def side_by_side(rgb: DataFrame, mask: DataFrame) -> DataFrame:
    """The frame on the left, its mask (0/1 as black and white, three channels) on the right; rgb carries ``width``."""
    left = rgb.select("image_id", "y", "x", "c", "v")
    widths = rgb.select("image_id", "y", "x", "c", "width")
    right = met(widths, mask, "m").select("image_id", "y", (F.col("x") + F.col("width")).alias("x"), "c", (F.col("m") * 255).cast("int").alias("v"))
    return left.unionByName(right)


def center_pad(pixels: DataFrame, boxes: DataFrame, target: int, fill: int) -> DataFrame:
    """(image_id, y, x, v): the box's pixels in the middle of a canvas of the target size, ``fill`` around them."""
    put = pad_offsets(boxes, target).withColumns({"dy": F.col("off_y") - F.col("y0"), "dx": F.col("off_x") - F.col("x0")})
    return C.placed(pixels, put, boxes.select("image_id", F.lit(target).alias("height"), F.lit(target).alias("width")), "v", fill)


def fit_to_target(pixels: DataFrame, boxes: DataFrame, target: int, fill: int, kind: str = "nearest") -> DataFrame:
    """(image_id, y, x, v) of exactly target by target: the whole preparation rule.

    ``boxes`` carries the foreground box and the frame's width and height. A box with a side over the target is stretched
    (``kind``: nearest for masks, lanczos for images); any other is extended within the frame and padded with ``fill``."""
    over = ((F.col("x1") - F.col("x0")) > target) | ((F.col("y1") - F.col("y0")) > target)
    if kind == "nearest":
        sides = ["image_id", "x0", "y0", "x1", "y1"]
        small = pad_offsets(extend_box(boxes.where(~over), target), target).select(*sides, (F.col("off_y") - F.col("y0")).alias("dy"), (F.col("off_x") - F.col("x0")).alias("dx"), F.lit(False).alias("stretch"))
        put = small.unionByName(boxes.where(over).select(*sides, F.lit(0).alias("dy"), F.lit(0).alias("dx"), F.lit(True).alias("stretch"))).withColumn("target", F.lit(target))
        square = boxes.select("image_id", F.lit(target).alias("height"), F.lit(target).alias("width"), (~over).alias("filled"))
        return C.placed(pixels, put, square, "v", fill, stretch=True)
    padded = center_pad(pixels, extend_box(boxes.where(~over), target), target, fill)
    large = boxes.where(over)
    cut = crop_by_box(pixels.select("image_id", "y", "x", "v"), large)
    sizes = large.select("image_id", (F.col("y1") - F.col("y0")).alias("height"), (F.col("x1") - F.col("x0")).alias("width"), F.lit(target).alias("out_h"), F.lit(target).alias("out_w"))
    stretched = resize(cut, sizes, kind)
    return padded.unionByName(stretched.select("image_id", "y", "x", "v"))
