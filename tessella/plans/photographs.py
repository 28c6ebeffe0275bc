"""Folders of photographs as tables: listed with ids and sizes from headers, and decoded once into written tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import listing as L
from ..operators import packed as P
from ..operators.fit import fit_tiles
from ..session import attach, materialise
from ..sources import headers, images, sinks


def _key(path: Column, quoted: bool = False) -> Column:
    """A path as listings spell it; the image source's are URIs, with signs quoted."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if quoted else path
    return F.regexp_replace(plain, "^file:/+", "file:/")


def list_photographs(spark: SparkSession, folder: str, pattern: str, recursive: bool = False) -> DataFrame:
    """(image_id, path, name, kind, height, width, channels, reason): a row a file, sizes and reasons from the headers.

    ``image_id`` is the place in the order of paths, whatever the names. ``name`` is the path below the folder without its suffix,
    or with it where two files would share a name."""
    found = headers.scan_frame_sizes(spark, folder, pattern, recursive).withColumn("_key", _key(F.col("path")))
    below = F.regexp_replace(F.lit("/" + folder.removeprefix("file:").strip("/") + "/"), "^//+", "/")
    rest = F.expr("substring(_key, locate(_below, _key) + length(_below))")
    found = found.withColumn("_below", below).withColumn("_rest", rest).withColumn("name", F.regexp_replace("_rest", "\\.[^./]*$", ""))
    alike = F.count("*").over(Window.partitionBy("name"))
    found = found.withColumn("name", F.when(alike > 1, F.col("_rest")).otherwise(F.col("name")))
    ordered = L.indexed(found.select("path", "name", "kind", "height", "width", "channels", "reason"), "path", into="image_id")
    return ordered.select("image_id", "path", "name", "kind", "height", "width", "channels", "reason")


def decode_tiles(spark: SparkSession, folder: str, frames: DataFrame, pattern: str, recursive: bool = False, tile: int = P.TILE) -> tuple[DataFrame, DataFrame]:
    """(RGB tiles of ``frames`` (image_id, path, height, width), (image_id) of those that can't be decoded).

    Each file is decoded once and its tiles are written; whatever is made of a photograph is made of them. A file whose pixels
    aren't of the size in its header counts as broken."""
    attach(spark)
    wanted = frames.select(_key(F.col("path")).alias("_key"), "image_id", F.col("height").alias("_h"), F.col("width").alias("_w"))
    rows = images.read_frames(spark, folder, pattern, recursive).withColumn("_key", _key(F.col("path"), quoted=True)).join(wanted, "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from P.batches_of(cut_from(batch))

    def cut_from(batch: pa.RecordBatch) -> Iterator[P.Row]:
        n = [batch.column(k).to_pylist() for k in ("image_id", "height", "width", "channels", "_h", "_w")]
        for i, h, w, c, hh, ww, raw in zip(*n, batch.column("data"), strict=True):
            if (h, w) != (hh, ww) or not raw.is_valid or c not in (1, 3, 4):
                yield i, 0, 0, np.empty((0, 0), np.uint8)
                continue
            a = np.frombuffer(raw.as_buffer(), np.uint8).reshape(h, w, c)
            a = np.repeat(a, 3, axis=2) if c == 1 else a[:, :, 2::-1]
            for top in range(0, h, tile):
                for left in range(0, w, tile):
                    yield i, top, left, a[top : top + tile, left : left + tile]

    cut = materialise(rows.select("image_id", "height", "width", "channels", "_h", "_w", "data").mapInArrow(run, P.TILE_SQL), "photographs")
    return cut.where("height > 0"), cut.where("height = 0").select("image_id")


def pair_files(images_listed: DataFrame, masks_listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(image_id, name, path, mask_path, height, width of the pairs, (name, reason) of the rest), from listings with sizes.

    An image and its mask have the same name. What lacks its other half, can't be told a size or differs in size is set aside."""
    a = images_listed.select("image_id", "name", "path", "height", "width", F.col("reason").alias("_ra"))
    b = masks_listed.select("name", F.col("path").alias("mask_path"), F.col("height").alias("_h"), F.col("width").alias("_w"), F.col("reason").alias("_rb"))
    unequal = (F.col("height") != F.col("_h")) | (F.col("width") != F.col("_w"))
    reason = F.when(F.col("path").isNull(), "no_image").when(F.col("mask_path").isNull(), "no_mask").when(F.col("_ra").isNotNull() | F.col("_rb").isNotNull(), "undecodable").when(unequal, "size_mismatch")
    met = materialise(a.join(b, "name", "full").withColumn("reason", reason), "pairs")
    return met.where("reason IS NULL").select("image_id", "name", "path", "mask_path", "height", "width"), met.where("reason IS NOT NULL").select("name", "reason")


def with_mask(tiles: DataFrame, masks: DataFrame) -> DataFrame:
    """RGB tiles and their mask's tiles at the same place as tiles of four planes; a mask in colour counts by its luma."""
    attach(tiles.sparkSession)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for rgb, mask in batches:
            both = zip(rgb, mask, strict=True)
            of = lambda x: np.frombuffer(x.as_buffer(), np.uint8).reshape(1, -1, 3)
            yield pa.array([np.concatenate([of(a), P.gray(of(b))[:, :, None]], axis=2).tobytes() for a, b in both], pa.binary())

    place = ["image_id", "y0", "x0", "height", "width"]
    met = tiles.join(masks.select(*place, F.col("data").alias("_m")).hint("merge"), place)
    return met.select(*place, F.arrow_udf(run, "binary")(F.col("data"), F.col("_m")).alias("data"))


def prepare_files(spark: SparkSession, image_folder: str, mask_folder: str, out: str, target: int = 1024, image_pattern: str = "*.{jpg,jpeg,png}", mask_pattern: str = "*.png", recursive: bool = False, fill: int = 0, fill_mask: int = 255, tile: int = P.TILE) -> DataFrame:
    """Pairs of photographs and masks (255 is background) at target by target, under ``out/images`` and ``out/masks``: (name, reason)
    of the files that are set aside.

    Pairs are checked by name and header before anything is decoded: ``no_image``, ``no_mask``, ``undecodable``, ``size_mismatch``; masks
    without foreground are ``no_foreground``. Image and mask travel as one tile of four planes, so that cropping, stretching and
    padding happen to both in one exchange."""
    found = list_photographs(spark, image_folder, image_pattern, recursive)
    pairs, rejected = pair_files(found, list_photographs(spark, mask_folder, mask_pattern, recursive))
    rgb, bad = decode_tiles(spark, image_folder, pairs, image_pattern, recursive, tile)
    mask, bad_mask = decode_tiles(spark, mask_folder, pairs.drop("path").withColumnRenamed("mask_path", "path"), mask_pattern, recursive, tile)
    both = materialise(with_mask(rgb, mask), "paired")
    box = materialise(P.mask_bbox(P.planes(both, lambda a: a[:, :, 3]), "dark").join(pairs.select("image_id", "height", "width"), "image_id"), "foreground")
    fitted = materialise(fit_tiles(both, box, target, fill, fill_mask, tile=tile), "fitted")
    names = pairs.select("image_id", "name")
    sinks.write_png(P.whole(P.planes(fitted, lambda a: a[:, :, :3])).join(names, "image_id"), f"{out}/images")
    sinks.write_png(P.whole(P.planes(fitted, lambda a: a[:, :, 3])).join(names, "image_id"), f"{out}/masks")
    broken = materialise(bad.unionByName(bad_mask).distinct(), "broken")
    empty = names.join(box, "image_id", "left_anti").join(broken, "image_id", "left_anti").select("name", F.lit("no_foreground").alias("reason"))
    return rejected.unionByName(names.join(broken, "image_id").select("name", F.lit("undecodable").alias("reason"))).unionByName(empty)
