"""Image files in: listing by Spark's own file sources, decoding by its image source, unpacking in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import packed as P
from ..operators.listing import IMAGE_EXTENSIONS, ext_rank
from ..session import attach


def _fewer(files: DataFrame) -> DataFrame:
    """Files in tasks of some hundred, or of some 32 MB: the source counts each as 4 MB at least, which makes a task of four small ones."""
    plan = files._jdf.queryExecution()
    parts, size = plan.toRdd().getNumPartitions(), int(str(plan.optimizedPlan().stats().sizeInBytes()))
    wanted = max(4 * files.sparkSession.sparkContext.defaultParallelism, size >> 25, parts // 64)
    return files.coalesce(wanted) if wanted < parts else files


def scan_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """(path, length, modified) of files below a folder; contents aren't read, and the suffix is matched with its case."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(root)
    return _fewer(files.select("path", "length", "modificationTime")).select("path", "length", F.col("modificationTime").alias("modified"))


def scan_recursive(spark: SparkSession, root: str, pattern: str = "*.jpg") -> DataFrame:
    return scan_files(spark, root, pattern, recursive=True)


def scan_multi_ext(spark: SparkSession, root: str, extensions: Sequence[str] = IMAGE_EXTENSIONS) -> DataFrame:
    """Listing of several suffixes with ``ext_rank``; order by rank and path for one listing after the other."""
    return scan_files(spark, root, "*.{" + ",".join(extensions) + "}").withColumn("ext_rank", ext_rank(extensions))


def scan_masks(spark: SparkSession, root: str) -> DataFrame:
    return scan_files(spark, root, "*.png")


def scan_folders(spark: SparkSession, root: str) -> DataFrame:
    """(folder) of the folders right below ``root`` that hold a file at any depth, such as the runs of a model folder."""
    below = F.regexp_extract("path", "/" + re.escape(root.rstrip("/").rsplit("/", 1)[1]) + "/([^/]+)/", 1)
    return scan_files(spark, root, recursive=True).select(below.alias("folder")).where("folder <> ''").distinct()


def scan_split_dirs(spark: SparkSession, root: str, test: bool = False) -> DataFrame:
    """Files of ``train`` and ``train_masks`` (or of the test folders), with ``split`` and ``role``."""
    split = "test" if test else "train"
    files = scan_files(spark, f"{root}/{split}{{,_masks}}")
    role = F.when(F.element_at(F.split("path", "/"), -2).endswith("_masks"), "mask").otherwise("image")
    return files.withColumns({"split": F.lit(split), "role": role})


def read_frames(spark: SparkSession, root: str, pattern: str = "*.png", recursive: bool = False) -> DataFrame:
    """(path, height, width, channels, mode, data) of decoded files; a broken one has mode -1 and no data."""
    rows = spark.read.format("image").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(root)
    return _fewer(rows).select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"), F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"), F.col("image.mode").alias("mode"), F.col("image.data").alias("data"))


def split_frames(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decoded frames, rejected paths with the reason)."""
    return frames.where("mode >= 0"), frames.where("mode < 0").select("path", F.lit("undecodable").alias("reason"))


def decode_rgb(frames: DataFrame, data_col: str = "data") -> DataFrame:
    """``data`` as packed RGB rows: BGR is turned round, alpha dropped, gray repeated."""
    attach(frames.sparkSession)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for data, channels in batches:
            out = []
            for raw, n in zip(data, channels.to_pylist(), strict=True):
                if not raw.is_valid:
                    out.append(None)
                    continue
                a = np.frombuffer(raw.as_buffer(), np.uint8).reshape(-1, n)
                out.append((np.repeat(a, 3, axis=1) if n == 1 else a[:, 2::-1]).tobytes())
            yield pa.array(out, pa.binary())

    return frames.withColumn(data_col, F.arrow_udf(run, "binary")(F.col(data_col), F.col("channels"))).withColumn("channels", F.lit(3))


def _bytes(packed: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint8) for x in packed]


def gray_plane(rgb: Column) -> Column:
    """Packed RGB to packed gray, by the luma of ``decode_gray``."""

    def run(data: pa.Array) -> pa.Array:
        weights = np.array([19595, 38470, 7471])
        return pa.array([((x.reshape(-1, 3) @ weights + 32768) >> 16).astype(np.uint8).tobytes() for x in _bytes(data)], pa.binary())

    return F.arrow_udf(run, "binary")(rgb)


def green_over(rgb: Column, mask: Column, strength: int = 191) -> Column:
    """Packed RGB with green raised (and capped) under a packed 0/1 mask."""

    def run(data: pa.Array, masks: pa.Array) -> pa.Array:
        out = []
        for x, m in zip(_bytes(data), _bytes(masks), strict=True):
            x = x.reshape(-1, 3).astype(np.int32)
            x[m != 0, 1] = np.minimum(x[m != 0, 1] + strength, 255)
            out.append(x.astype(np.uint8).tobytes())
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, "binary")(rgb, mask)


def beside(rgb: Column, mask: Column, width: Column) -> Column:
    """Packed RGB of twice the width: the frame, and its mask in black and white on the right."""

    def run(data: pa.Array, masks: pa.Array, widths: pa.Array) -> pa.Array:
        out = []
        for x, m, w in zip(_bytes(data), _bytes(masks), widths.to_pylist(), strict=True):
            right = np.repeat((m * np.uint8(255)).reshape(-1, w, 1), 3, axis=2)
            out.append(np.concatenate([x.reshape(-1, w, 3), right], axis=1).tobytes())
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, "binary")(rgb, mask, width)


def to_pixels(frames: DataFrame, keys: Sequence[str] = ("path",)) -> DataFrame:
    """Packed frames to long pixels (keys, y, x, c, v). Meant for small rasters; large ones stay packed."""
    attach(frames.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw, ends = P._raw(batch.column("data")), P._offsets(batch.column("data"))
            size = np.diff(ends)
            h, w, n = (np.where(size > 0, batch.column(k).fill_null(0).to_numpy(), 0).astype(np.int64) for k in ("height", "width", "channels"))
            if (h * w * n != size).any():
                raise ValueError("a frame's data isn't of its size")
            for some, row, (y, x, c) in P.spread(h, w, n):
                pixels = [pa.array(k.astype(np.int32)) for k in (y, x, c, raw[ends[some.start] : ends[some.stop]])]
                yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(row)) for k in keys], *pixels], [*keys, "y", "x", "c", "v"])

    schema = ", ".join([*[f"`{k}` {frames.schema[k].dataType.simpleString()}" for k in keys], "y int", "x int", "c int", "v int"])
    return frames.select(*keys, "height", "width", "channels", "data").mapInArrow(run, schema)


def with_image_id(frames: DataFrame, path_col: str = "path") -> DataFrame:
    """``image_id``: the digits of the file's stem."""
    return frames.withColumn("image_id", F.regexp_extract(S.stem(F.col(path_col)), "([0-9]+)", 1).cast("long"))
