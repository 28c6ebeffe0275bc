"""Sinks: PNG files through a data source writer, metrics as tab-separated text, summaries as JSON, models, packed pairs."""

from __future__ import annotations

import json
import os
import shutil
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators import chunks as C
from ..operators.packed import filled
from ..session import attach


def png(data: bytes, height: int, width: int, channels: int) -> bytes:
    """A PNG file of 8-bit gray (1) or RGB (3) rows."""
    rows = np.frombuffer(data, np.uint8).reshape(height, width * channels)
    plain = np.zeros((height, width * channels + 1), np.uint8)  # filter 0 before each row
    plain[:, 1:] = rows
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(plain.tobytes(), 6)) + chunk(b"IEND", b"")


@dataclass
class _Written(WriterCommitMessage):
    attempt: int
    n: int


class _FileWriter(DataSourceArrowWriter):
    """Tasks write below a hidden folder of the run, each attempt in its own; the commit moves the files of the attempts that
    count into place and then publishes the run in ``_manifest.json``. What a broken run has written is never seen.

    With ``overwrite``, the commit takes out what the folder had before; otherwise only files of the same name are replaced. The
    folder must be mounted on the driver and all executors, as any shared storage reached by path."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.run = path.removeprefix("file://"), overwrite, uuid.uuid4().hex

    @property
    def stage(self) -> str:
        return f"{self.path}/_staging-{self.run}"

    def make_folders(self, name: str) -> None:
        """The folders of a name below the run's own, which is the driver's to make: a task that outlives its run fails here."""
        at = self.stage
        for part in name.split("/")[:-1]:
            at = f"{at}/{part}"
            try:
                os.mkdir(at)
            except FileExistsError:
                pass

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        attempt, n = TaskContext.get().taskAttemptId(), 0
        for batch in batches:
            for name, data in zip(batch.column("name").to_pylist(), batch.column("data"), strict=True):
                self.make_folders(f"{attempt}/{name}")
                with open(f"{self.stage}/{attempt}/{name}", "wb") as f:
                    f.write(data.as_buffer())
                n += 1
        return _Written(attempt, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        os.makedirs(self.path, exist_ok=True)
        if self.overwrite:
            for entry in os.scandir(self.path):
                if not entry.name.startswith("_staging-"):
                    shutil.rmtree(entry.path) if entry.is_dir(follow_symlinks=False) else os.remove(entry.path)
        files = 0
        for message in messages:
            top = f"{self.stage}/{message.attempt}" if isinstance(message, _Written) else ""
            for folder, _, names in os.walk(top) if top else ():
                target = os.path.normpath(f"{self.path}/{os.path.relpath(folder, top)}")
                os.makedirs(target, exist_ok=True)
                for name in names:
                    os.replace(f"{folder}/{name}", f"{target}/{name}")
                files += len(names)
        draft = f"{self.stage}.json"
        with open(draft, "w") as f:
            json.dump({"run": self.run, "files": files}, f)
        os.replace(draft, f"{self.path}/{MANIFEST}")
        shutil.rmtree(self.stage, ignore_errors=True)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        # Other tasks may still write, and fill a folder while it is being emptied. They can't make the run's own folder anew.
        end = time.monotonic() + ABORT_SECONDS
        while os.path.exists(self.stage) and time.monotonic() < end:
            shutil.rmtree(self.stage, ignore_errors=True)
            time.sleep(0.01)


#: How long an ended run waits for its last tasks to stop writing.
ABORT_SECONDS = 60
#: Names the last run that was published in a folder of files, and how many files it wrote.
MANIFEST = "_manifest.json"


def published(folder: str) -> dict[str, object] | None:
    """The last run published in a folder of files, or None."""
    try:
        with open(f"{folder.removeprefix('file://')}/{MANIFEST}") as f:
            return json.load(f)
    except FileNotFoundError:
        return None


class FileSource(DataSource):
    """``df.write.format("tessella_files").mode("append").save(folder)`` for rows (name, data), a file each; or ``overwrite``."""

    @classmethod
    def name(cls) -> str:
        return "tessella_files"

    def schema(self) -> str:
        return "name string, data binary"

    def writer(self, schema, overwrite: bool) -> _FileWriter:
        made = _FileWriter(self.options["path"], overwrite)
        os.makedirs(made.stage)
        return made


def write_files(rows: DataFrame, folder: str, mode: str = "append") -> None:
    """Rows (name, data) as files; a name may have folders in it. ``mode``: append, or overwrite the folder's files."""
    attach(rows.sparkSession)
    rows.sparkSession.dataSource.register(FileSource)
    rows.select("name", "data").write.format("tessella_files").mode(mode).save(folder)


def write_png(frames: DataFrame, folder: str, mode: str = "append") -> None:
    """Frames (name, height, width, channels, data as packed rows) as ``<name>.png``."""
    attach(frames.sparkSession)

    def run(data: pa.Array, height: pa.Array, width: pa.Array, channels: pa.Array) -> pa.Array:
        sizes = zip(height.to_pylist(), width.to_pylist(), channels.to_pylist(), strict=True)
        return pa.array([png(x.as_buffer(), *size) for x, size in zip(data, sizes, strict=True)], pa.binary())

    file = F.arrow_udf(run, "binary")(F.col("data"), F.col("height"), F.col("width"), F.col("channels"))
    write_files(frames.select(F.concat("name", F.lit(".png")).alias("name"), file.alias("data")), folder, mode)


def pack_pixels(pixels: DataFrame, value: str = "v", key: str = "image_id") -> DataFrame:
    """Long pixels (key, y, x, c, value) to packed frames (key, height, width, channels, data). One frame's pixels make a row."""

    def run(groups: list[np.ndarray], sides: list[C.Flat]) -> Iterator[pa.RecordBatch]:
        f = sides[0]
        for some, (h, w, n), offsets, data in filled(f.g, *f.columns[:2], f.columns[3], len(groups[0]), f.columns[2]):
            columns = [C.array(groups[0][some], pa.int64()), *[pa.array(k.astype(np.int32)) for k in (h, w, n)], C.binaries(offsets, data)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "height", "width", "channels", "data"])

    rows = pixels.select(F.col(key).cast("long").alias("key"), *[F.col(k).cast("int").alias(k) for k in ("y", "x", "c")], F.col(value).cast("int").alias("v"))
    return C.gathered([C.chunked(rows, ["key"], ["y", "x", "c", "v"])], run, "key long, height int, width int, channels int, data binary").withColumnRenamed("key", key)


def sink_mask_png(masks: DataFrame, folder: str, name_col: str = "name") -> None:
    """Packed 0/1 masks as black and white files."""
    write_png(_scaled(masks).withColumn("name", F.col(name_col)), folder)


def _scaled(masks: DataFrame) -> DataFrame:
    attach(masks.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([(np.frombuffer(x.as_buffer(), np.uint8) * np.uint8(255)).tobytes() for x in batch], pa.binary())

    return masks.withColumn("data", F.arrow_udf(run, "binary")(F.col("data")))


def sink_pairs(images: DataFrame, masks: DataFrame, image_folder: str, mask_folder: str) -> None:
    """Prepared frames and their masks under their own names."""
    write_png(images, image_folder)
    write_png(masks, mask_folder)


def metric_lines(metrics: DataFrame) -> DataFrame:
    """(epoch, line): tab-separated text with four decimals."""
    numbers = [F.format_string("%.4f", F.col(c)) for c in metrics.columns if c != "epoch"]
    return metrics.select("epoch", F.concat_ws("\t", F.col("epoch").cast("string"), *numbers).alias("line"))


def sink_metrics(metrics: DataFrame, folder: str) -> None:
    """A tab-separated file with a header per write; later writes are added beside earlier ones."""
    text = metrics.select("epoch", *[F.format_string("%.4f", F.col(c)).alias(c) for c in metrics.columns if c != "epoch"])
    text.orderBy("epoch").coalesce(1).write.mode("append").option("sep", "\t").option("header", True).csv(folder)


def sink_run_summary(summary: DataFrame, folder: str) -> None:
    summary.coalesce(1).write.mode("overwrite").json(folder)


def run_folder(root: str, stamp: str) -> str:
    """Folder of a run's weights; a second run of the same stamp takes the same one."""
    return f"{root}/runs_{stamp}/project/weights"


def sink_model(model, root: str, stamp: str) -> str:
    path = run_folder(root, stamp)
    model.write().overwrite().save(path)
    return path


def read_metrics(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).schema(schema).csv(folder)
