"""Sizes of image files from their headers: a few bytes a file are read, and no pixel is decoded."""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import attach
from .images import scan_files

_HEAD = "kind string, height int, width int, channels int, bits int, reason string"
_FORM = pa.struct([("kind", pa.string()), *[(k, pa.int32()) for k in ("height", "width", "channels", "bits")], ("reason", pa.string())])
#: Channels by PNG colour type: gray, RGB, palette (decoded as RGB), gray with alpha, RGB with alpha.
_PNG_CHANNELS = {0: 1, 2: 3, 3: 3, 4: 2, 6: 4}
#: JPEG frame headers: 0xC0 to 0xCF but for tables (C4), extensions (C8) and arithmetic conditioning (CC).
_JPEG_FRAMES = set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def header(file) -> dict[str, object]:
    """Kind, height, width, channels and bits of an open PNG or JPEG file, or the reason why they can't be told.

    JPEG segments are passed over by their lengths, so that only their heads are read."""
    start = file.read(33)
    if not start:
        return {"reason": "empty"}
    if start[:8] == b"\x89PNG\r\n\x1a\n":
        if len(start) < 33 or start[12:16] != b"IHDR":
            return {"kind": "png", "reason": "truncated"}
        width, height, bits, colour = struct.unpack(">IIBB", start[16:26])
        if colour not in _PNG_CHANNELS or not 0 < width < 1 << 31 or not 0 < height < 1 << 31:
            return {"kind": "png", "reason": "malformed"}
        return {"kind": "png", "height": height, "width": width, "channels": _PNG_CHANNELS[colour], "bits": bits}
    if start[:3] != b"\xff\xd8\xff":
        return {"reason": "unknown"}
    at = 2
    while True:
        file.seek(at)
        head = file.read(10)
        if len(head) < 4:
            return {"kind": "jpeg", "reason": "truncated"}
        if head[0] != 0xFF:
            return {"kind": "jpeg", "reason": "malformed"}
        code = head[1]
        if code == 0xFF:  # a fill byte
            at += 1
        elif code == 0x01 or 0xD0 <= code <= 0xD7:  # markers without a length
            at += 2
        elif code in _JPEG_FRAMES:
            if len(head) < 10:
                return {"kind": "jpeg", "reason": "truncated"}
            bits, height, width, channels = struct.unpack(">BHHB", head[4:10])
            if not height or not width:
                return {"kind": "jpeg", "reason": "malformed"}
            return {"kind": "jpeg", "height": height, "width": width, "channels": channels, "bits": bits}
        elif code in (0xD9, 0xDA):  # the scan or the end before any frame
            return {"kind": "jpeg", "reason": "malformed"}
        else:
            at += 2 + struct.unpack(">H", head[2:4])[0]


def _opened(path: str):
    """The file of a path as Spark lists it, with spaces and signs as they are; ``file:/x`` and ``file:///x`` are the same."""
    if path.startswith(("file:/", "/")):
        store, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        store, inner = fs.FileSystem.from_uri(quote(path, safe="/:@?=&"))
    return store.open_input_file(inner)


def with_sizes(files: DataFrame, path_col: str = "path", content_col: str | None = None) -> DataFrame:
    """``files`` with kind, height, width, channels, bits and reason (null where the header tells all).

    Headers are read by path in the tasks, or from ``content_col`` where only Spark can read the store. A plan that doesn't use
    these columns reads nothing."""
    attach(files.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for x in batch:
                try:
                    with io.BytesIO(x.as_py()) if content_col else _opened(x.as_py()) as file:
                        out.append(header(file))
                except (OSError, pa.ArrowException) as e:
                    out.append({"reason": f"unreadable: {type(e).__name__}"})
            yield pa.array(out, _FORM)

    head = F.arrow_udf(run, _HEAD)(F.col(content_col or path_col))
    kept = [c for c in files.columns if c not in (*_FORM.names, content_col)]
    return files.select(*kept, head.alias("_head")).select(*kept, *[F.col("_head")[n].alias(n) for n in _FORM.names])


def scan_frame_sizes(spark: SparkSession, root: str, pattern: str = "*.{jpg,jpeg,png}", recursive: bool = False) -> DataFrame:
    """(path, length, modified, kind, height, width, channels, bits, reason) of the image files in a folder.

    Conditions on path, length and time are settled by the listing, before any file is opened."""
    return with_sizes(scan_files(spark, root, pattern, recursive))
