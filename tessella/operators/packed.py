"""Packed tiles (image_id, y0, x0, height, width, data): numpy kernels over Arrow batches with the long form's semantics.

A tile is at most TILE pixels a side, so a row's size is bounded whatever the photograph's. It has one plane or several, as its data's
length tells: a kernel gets (height, width) or (height, width, planes)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import attach
from . import chunks as C
from .resample import KERNELS
from .tiling import with_steps

TILE = 512
TILE_SQL = "image_id long, y0 int, x0 int, height int, width int, data binary"
_FIELDS = [("image_id", pa.int64()), ("y0", pa.int32()), ("x0", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("data", pa.binary())]
Row = tuple[int, int, int, np.ndarray]


def _offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def _raw(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)


def _rows(batch: pa.RecordBatch) -> Iterator[Row]:
    ids, y0, x0, h, w = (batch.column(n).to_pylist() for n in ("image_id", "y0", "x0", "height", "width"))
    raw, ends = _raw(batch.column("data")), _offsets(batch.column("data")).tolist()
    for i in range(batch.num_rows):
        a = raw[ends[i] : ends[i + 1]]
        yield ids[i], y0[i], x0[i], a.reshape((h[i], w[i]) if len(a) == h[i] * w[i] else (h[i], w[i], -1))


def batch_of(rows: list[Row]) -> pa.RecordBatch:
    cells = [(i, y, x, a.shape[0], a.shape[1], np.ascontiguousarray(a).tobytes()) for i, y, x, a in rows]
    columns = list(zip(*cells, strict=True)) if cells else [[]] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], [n for n, _ in _FIELDS])


def batches_of(rows: Iterator[Row]) -> Iterator[pa.RecordBatch]:
    """Rows by some thousand or some megabytes."""
    out: list[Row] = []
    held = 0
    for row in rows:
        out.append(row)
        held += row[3].size
        if len(out) >= 4096 or held >= 1 << 22:
            yield batch_of(out)
            out, held = [], 0
    if out:
        yield batch_of(out)


def map_tiles(tiles: DataFrame, kernel: Callable[[Row], Iterator[Row]]) -> DataFrame:
    """Each tile to any number of tiles."""
    attach(tiles.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from batches_of(made for row in _rows(batch) for made in kernel(row))

    return tiles.select(*[n for n, _ in _FIELDS]).mapInArrow(run, TILE_SQL)


def _grouped(sent: DataFrame, join: Callable[[tuple[int, int, int], Iterator[Row]], Row | None]) -> DataFrame:
    """One tile of all parts (tiles with gy and gx) of a grid cell; the cells follow each other in a task's stream."""

    def kernel(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, gy, gx = (C.numbers(batch.column(k))[starts].tolist() for k in ("image_id", "gy", "gx"))
        counts, rows = np.diff(np.append(starts, batch.num_rows)).tolist(), _rows(batch)
        made = (join(key, islice(rows, n)) for key, n in zip(zip(ids, gy, gx, strict=True), counts, strict=True))
        yield from batches_of(m for m in made if m is not None)

    return C.by_key(sent, ["image_id", "gy", "gx"], kernel, TILE_SQL)


def cut_tiles(frames: DataFrame, tile: int = TILE) -> DataFrame:
    """Packed frames to tiles that don't overlap, with as many planes."""

    def kernel(row: Row) -> Iterator[Row]:
        i, y, x, a = row
        for top in range(0, a.shape[0], tile):
            for left in range(0, a.shape[1], tile):
                yield i, y + top, x + left, a[top : top + tile, left : left + tile]

    return map_tiles(frames.withColumns({"y0": F.lit(0), "x0": F.lit(0)}), kernel)


def filled(which: np.ndarray, y: np.ndarray, x: np.ndarray, v: np.ndarray, n: int, plane: np.ndarray | None = None) -> Iterator[tuple[slice, list[np.ndarray], np.ndarray, np.ndarray]]:
    """(tiles, their sides, offsets, bytes) of values by the number of their tile, 0 where none is; some megabytes at a time.

    Rows come in the order of tiles. A tile reaches from 0 to its last values."""
    starts = np.searchsorted(which, np.arange(n))
    last = [np.maximum.reduceat(k, starts) + 1 for k in (y, x, *([] if plane is None else [plane]))]
    planes = last[2] if plane is not None else np.ones(n, np.int64)
    ends = np.append(0, np.cumsum(last[0] * last[1] * planes))
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + (1 << 24), "right")) - 1)
        rows = slice(starts[a], starts[b] if b < n else len(which))
        t = which[rows]
        at = (y[rows] * last[1][t] + x[rows]) * planes[t] + (0 if plane is None else plane[rows])
        out = np.zeros(ends[b] - ends[a], np.uint8)
        out[ends[t] - ends[a] + at] = v[rows].astype(np.uint8)
        yield slice(a, b), [k[a:b] for k in last], ends[a : b + 1] - ends[a], out
        a = b


def pack(pixels: DataFrame, value: str = "v", tile: int = TILE) -> DataFrame:
    """Long one-channel pixels to tiles of the fixed grid. They are dealt by cells of some tiles, at most TILE a side."""
    many = max(1, TILE // tile)
    cell = tile * many

    def run(groups: list[np.ndarray], sides: list[C.Flat]) -> Iterator[pa.RecordBatch]:
        f = sides[0]
        y, x, v = f.columns
        gy, gx = y // tile, x // tile
        which = (f.g * many + gy - groups[1][f.g] * many) * many + gx - groups[2][f.g] * many
        if len(which) > 1 and (which[1:] < which[:-1]).any():
            order = np.argsort(which, kind="stable")
            which, y, x, v, gy, gx, g = (k[order] for k in (which, y, x, v, gy, gx, f.g))
        else:
            g = f.g
        first = C.starts_of([which])
        number = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(which))))
        ids, y0, x0 = groups[0][g[first]], gy[first] * tile, gx[first] * tile
        for some, (h, w), offsets, data in filled(number, y - gy * tile, x - gx * tile, v, len(first)):
            columns = [C.array(ids[some], pa.int64()), *[pa.array(k.astype(np.int32)) for k in (y0[some], x0[some], h, w)], C.binaries(offsets, data)]
            yield pa.RecordBatch.from_arrays(columns, [n for n, _ in _FIELDS])

    rows = pixels.select(F.col("image_id").cast("long").alias("image_id"), F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col(value).cast("int").alias("v"))
    rows = rows.withColumns({f"_c{k}": F.floor(F.col(k) / cell) for k in ("y", "x")})
    return C.gathered([C.chunked(rows, ["image_id", "_cy", "_cx"], ["y", "x", "v"])], run, TILE_SQL)


def mask_bbox(tiles: DataFrame, convention: str) -> DataFrame:
    """(image_id, x0, y0, x1, y1): each tile gives its own box, the frame's is their hull."""
    if convention not in ("dark", "bright"):
        raise ValueError("foreground convention is dark or bright")
    attach(tiles.sparkSession)
    dark = convention == "dark"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, y, x, a in _rows(batch):
                hit = a != 255 if dark else a >= 128
                rows, columns = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
                if len(rows):
                    out.append((i, x + int(columns[0]), y + int(rows[0]), x + int(columns[-1]) + 1, y + int(rows[-1]) + 1))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.int32()) for c in columns[1:]]], ["image_id", "x0", "y0", "x1", "y1"])

    parts = tiles.select(*[n for n, _ in _FIELDS]).mapInArrow(run, "image_id long, x0 int, y0 int, x1 int, y1 int")
    return parts.groupBy("image_id").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def crop(tiles: DataFrame, boxes: DataFrame) -> DataFrame:
    """The parts of tiles inside their frame's box (x0, y0, x1, y1), counted from its corner."""
    attach(tiles.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [batch.column(k).to_pylist() for k in ("b_y0", "b_x0", "b_y1", "b_x1")]
            out = []
            for (i, y, x, a), y0, x0, y1, x1 in zip(_rows(batch), *n, strict=True):
                t, l_ = max(y, y0), max(x, x0)
                part = a[t - y : max(0, y1 - y), l_ - x : max(0, x1 - x)]
                if part.size:
                    out.append((i, t - y0, l_ - x0, part))
            yield batch_of(out)

    met = tiles.select(*[n for n, _ in _FIELDS]).join(boxes.select("image_id", *[F.col(k).alias(f"b_{k}") for k in ("y0", "x0", "y1", "x1")]).hint("merge"), "image_id")
    return met.mapInArrow(run, TILE_SQL)


def score(tiles: DataFrame, make_predict: Callable[[], Callable[[np.ndarray], np.ndarray]]) -> DataFrame:
    """Each tile's mask by a model of planes, which a task makes once."""
    made: list[Callable[[np.ndarray], np.ndarray]] = []

    def kernel(row: Row) -> Iterator[Row]:
        if not made:
            made.append(make_predict())
        i, y, x, a = row
        yield i, y, x, made[0](a)

    return map_tiles(tiles, kernel)


def whole(tiles: DataFrame) -> DataFrame:
    """(image_id, height, width, channels, data): one row a frame, for sinks whose files are frames."""

    def frames(out: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        sides = [pa.array([(*a.shape, 1)[k] for _, a in out], pa.int32()) for k in range(3)]
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), *sides, pa.array([a.tobytes() for _, a in out], pa.binary())], ["image_id", "height", "width", "channels", "data"])

    def kernel(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows, counts = _rows(batch), np.diff(np.append(starts, batch.num_rows)).tolist()
        out, held = [], 0
        for n in counts:
            parts = list(islice(rows, n))
            a = np.zeros((max(y + p.shape[0] for _, y, _, p in parts), max(x + p.shape[1] for _, _, x, p in parts), *parts[0][3].shape[2:]), np.uint8)
            for _, y, x, p in parts:
                a[y : y + p.shape[0], x : x + p.shape[1]] = p
            out.append((parts[0][0], a))
            held += a.size
            if len(out) >= 4096 or held >= 1 << 22:
                yield frames(out)
                out, held = [], 0
        if out:
            yield frames(out)

    return C.by_key(tiles.select(*[n for n, _ in _FIELDS]), ["image_id"], kernel, "image_id long, height int, width int, channels int, data binary")


def planes(tiles: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Tiles with other planes, made from all of a tile's: a choice of them, gray, or a mask."""

    def kernel(row: Row) -> Iterator[Row]:
        i, y, x, a = row
        yield i, y, x, of(a)

    return map_tiles(tiles, kernel)


def gray(a: np.ndarray) -> np.ndarray:
    """The luma of an RGB plane, as in ``rasterops.decode_gray``."""
    return ((a[:, :, :3] @ np.array([19595, 38470, 7471]) + 32768) >> 16).astype(np.uint8)


def cut_overlapping(tiles: DataFrame, frames: DataFrame, overlap: int) -> DataFrame:
    """Tiles of the fixed grid to the overlapping tiles of ``tiling.tile_grid``: each is put together from the parts that the
    fixed tiles send it. A group is one overlapping tile; frames whose step isn't positive have none."""
    attach(tiles.sparkSession)
    sized = with_steps(frames.select("image_id", "height", "width"), overlap).where("step_h > 0 and step_w > 0")
    sized = sized.select("image_id", F.col("height").alias("n_h"), F.col("width").alias("n_w"), "tile_h", "tile_w", "step_h", "step_w")
    first = lambda at, side, step: ((at - side) // step + 1) * step if at >= side else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [batch.column(k).to_pylist() for k in ("n_h", "n_w", "tile_h", "tile_w", "step_h", "step_w")]
            made, cells, held = [], [], 0
            for (i, y, x, a), nh, nw, th, tw, sh, sw in zip(_rows(batch), *n, strict=True):
                for top in range(first(y, th, sh), min(y + a.shape[0], nh), sh):
                    for left in range(first(x, tw, sw), min(x + a.shape[1], nw), sw):
                        t, l_ = max(top, y), max(left, x)
                        part = a[t - y : min(top + th, nh) - y, l_ - x : min(left + tw, nw) - x]
                        if part.size:
                            made.append((i, t, l_, part))
                            cells.append((top, left))
                            held += part.size
                if len(made) >= 4096 or held >= 1 << 22:
                    yield _sent(made, cells)
                    made, cells, held = [], [], 0
            if made:
                yield _sent(made, cells)

    def join(key: tuple[int, int, int], rows: Iterator[Row]) -> Row:
        i, top, left = key
        parts = list(rows)
        if len(parts) == 1 and parts[0][1:3] == (top, left):
            return parts[0]
        cell = np.zeros((max(y + a.shape[0] for _, y, _, a in parts) - top, max(x + a.shape[1] for _, _, x, a in parts) - left, *parts[0][3].shape[2:]), np.uint8)
        for _, y, x, a in parts:
            cell[y - top : y - top + a.shape[0], x - left : x - left + a.shape[1]] = a
        return i, top, left, cell

    sent = tiles.select(*[n for n, _ in _FIELDS]).join(sized.hint("merge"), "image_id").mapInArrow(run, TILE_SQL + ", gy int, gx int")
    return _grouped(sent, join)


def _sent(made: list[Row], cells: list[tuple[int, int]]) -> pa.RecordBatch:
    """Tiles with the grid cell that each goes to."""
    out = batch_of(made)
    return pa.RecordBatch.from_arrays([*out.columns, *[pa.array([c[k] for c in cells], pa.int32()) for k in (0, 1)]], [*out.schema.names, "gy", "gx"])


def threshold(tiles: DataFrame, at: int = 128) -> DataFrame:
    """Bytes to 0/1 masks."""

    def kernel(row: Row) -> Iterator[Row]:
        i, y, x, a = row
        yield i, y, x, (a >= at).astype(np.uint8)

    return map_tiles(tiles, kernel)


def _send(tiles: DataFrame, parts: Callable[[Row], Iterator[tuple[int, int, Row]]]) -> DataFrame:
    """Parts of tiles with the grid cell (gy, gx) that they go to."""
    attach(tiles.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, cells, held = [], [], 0
            for row in _rows(batch):
                for gy, gx, part in parts(row):
                    made.append(part)
                    cells.append((gy, gx))
                    held += part[3].size
                if len(made) >= 4096 or held >= 1 << 22:
                    yield _sent(made, cells)
                    made, cells, held = [], [], 0
            if made:
                yield _sent(made, cells)

    return tiles.select(*[n for n, _ in _FIELDS]).mapInArrow(run, TILE_SQL + ", gy int, gx int")


def merge_max(tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """Overlapping tiles to tiles on the fixed grid, by the maximum. Parts are cut at the grid before the shuffle; each
    group is one grid cell, and its parts are taken one after the other."""

    def parts(row: Row) -> Iterator[tuple[int, int, Row]]:
        i, y, x, a = row
        for top in range(y // tile * tile, y + a.shape[0], tile):
            for left in range(x // tile * tile, x + a.shape[1], tile):
                t, l_ = max(top, y), max(left, x)
                yield top // tile, left // tile, (i, t, l_, a[t - y : top + tile - y, l_ - x : left + tile - x])

    def merge(key: tuple[int, int, int], rows: Iterator[Row]) -> Row:
        i, gy, gx = key
        parts = [(y - gy * tile, x - gx * tile, a) for _, y, x, a in rows]
        cell = np.zeros((max(t + a.shape[0] for t, _, a in parts), max(l_ + a.shape[1] for _, l_, a in parts), *parts[0][2].shape[2:]), np.uint8)
        for t, l_, a in parts:
            view = cell[t : t + a.shape[0], l_ : l_ + a.shape[1]]
            np.maximum(view, a, out=view)
        return i, gy * tile, gx * tile, cell

    return _grouped(_send(tiles, parts), merge)


def focal3(tiles: DataFrame, kernel3: np.ndarray, tile: int = TILE) -> DataFrame:
    """3x3 weighted sum with zero padding, rounded to bytes. Tiles of the fixed grid send one-pixel edges to their neighbours."""

    def parts(row: Row) -> Iterator[tuple[int, int, Row]]:
        i, y, x, a = row
        rows = {-1: (a[:1], 0), 0: (a, 0), 1: (a[-1:], a.shape[0] - 1)}
        for dy, (band, down) in rows.items():
            columns = {-1: (band[:, :1], 0), 0: (band, 0), 1: (band[:, -1:], a.shape[1] - 1)}
            for dx, (part, over) in columns.items():
                yield y // tile + dy, x // tile + dx, (i, y + down, x + over, part)

    def apply(key: tuple[int, int, int], rows: Iterator[Row]) -> Row | None:
        i, gy, gx = key
        pad = np.zeros((tile + 2, tile + 2))
        h = w = 0
        for _, y, x, a in rows:
            t, l_ = y - gy * tile + 1, x - gx * tile + 1
            if 0 <= t <= tile + 1 and 0 <= l_ <= tile + 1:  # a short tile's edge isn't next to its neighbour's cell
                pad[t : t + a.shape[0], l_ : l_ + a.shape[1]] = a
            if (y // tile, x // tile) == (gy, gx):
                h, w = a.shape
        if not h:
            return None
        out = sum(kernel3[1 + dy, 1 + dx] * pad[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w] for dy in (-1, 0, 1) for dx in (-1, 0, 1))
        return i, gy * tile, gx * tile, np.clip(np.floor(np.round(out, 6) + 0.5), 0, 255).astype(np.uint8)

    return _grouped(_send(tiles, parts), apply)


def spread(heights: np.ndarray, widths: np.ndarray, channels: np.ndarray | int, most: int = 1 << 18) -> Iterator[tuple[slice, np.ndarray, list[np.ndarray]]]:
    """(rows, the row of each pixel, its y, x and channel) of packed rasters one after the other, some hundred thousand at a time."""
    channels = np.broadcast_to(channels, heights.shape)
    ends = np.append(0, np.cumsum(heights * widths * channels))
    a = 0
    while a < len(heights):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
        row = np.repeat(np.arange(a, b), np.diff(ends[a : b + 1]))
        at, c = np.divmod(np.arange(ends[a], ends[b]) - ends[row], channels[row])
        yield slice(a, b), row, [*np.divmod(at, widths[row]), c]
        a = b


def to_pixels(tiles: DataFrame) -> DataFrame:
    """(image_id, y, x, v) of tiles: the long form, for small rasters and tests."""
    attach(tiles.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, y0, x0, h, w = (C.numbers(batch.column(n)).astype(np.int64) for n in ("image_id", "y0", "x0", "height", "width"))
            raw, ends = _raw(batch.column("data")), _offsets(batch.column("data"))
            if (h * w != np.diff(ends)).any():
                raise ValueError("tiles of one plane are wanted")
            for some, row, (y, x, _) in spread(h, w, 1):
                v = raw[ends[some.start] : ends[some.stop]]
                yield pa.RecordBatch.from_arrays([C.array(ids[row], pa.int64()), *[pa.array(k.astype(np.int32)) for k in (y + y0[row], x + x0[row], v)]], ["image_id", "y", "x", "v"])

    return tiles.select(*[n for n, _ in _FIELDS]).mapInArrow(run, "image_id long, y int, x int, v int")


@lru_cache(maxsize=4096)
def line_weights(n_src: int, n_dst: int, kind: str, begin: int, end: int) -> tuple[int, np.ndarray]:
    """(first output, weights by output and source) of the outputs that sources from ``begin`` to ``end`` feed.

    The same weights as ``resample.weights``: half-pixel centres, sums of 1 over all sources of an output."""
    reach, widens = KERNELS[kind]
    scale = n_src / n_dst
    wide = max(scale, 1.0) if widens else 1.0
    first = max(0, math.floor((begin - reach * wide) / scale - 0.5) - 1)
    last = min(n_dst, math.ceil((end + reach * wide) / scale - 0.5) + 2)
    centre = (np.arange(first, last) + 0.5) * scale
    at = np.floor(centre - 0.5 - reach * wide).astype(np.int64)[:, None] + np.arange(2 * math.ceil(reach * wide) + 3)
    t = (at + 0.5 - centre[:, None]) / wide
    if kind == "lanczos":
        k = np.where(np.abs(t) < 1e-12, 1.0, np.where(np.abs(t) >= 3, 0.0, np.sinc(t) * np.sinc(t / 3)))
    else:
        k = np.maximum(1 - np.abs(t), 0)
    if widens:
        k[(at < 0) | (at >= n_src)] = 0
    at = np.clip(at, 0, n_src - 1)
    k /= k.sum(axis=1, keepdims=True)
    out = np.zeros((last - first, end - begin))
    here = (at >= begin) & (at < end)
    np.add.at(out, (np.nonzero(here)[0], at[here] - begin), k[here])
    fed = np.flatnonzero(out.any(axis=1))
    if not len(fed):
        return first, out[:0]
    return first + int(fed[0]), out[fed[0] : fed[-1] + 1]


_SHARE_SQL = "image_id long, gy int, gx int, y int, x int, h int, w int, data binary"


def _shares(tiles: DataFrame, sizes: DataFrame, kind: str, tile: int) -> DataFrame:
    """What each tile adds to the outputs (doubles), cut at the output's grid."""
    attach(tiles.sparkSession)

    def made(cells: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), *[pa.int32()] * 6, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*cells, strict=True), kinds, strict=True)], ["image_id", "gy", "gx", "y", "x", "h", "w", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [batch.column(k).to_pylist() for k in ("n_h", "n_w", "out_h", "out_w")]
            cells, held = [], 0
            for (i, y, x, a), h, w, oh, ow in zip(_rows(batch), *n, strict=True):
                top, down = line_weights(h, oh, kind, y, y + a.shape[0])
                left, across = line_weights(w, ow, kind, x, x + a.shape[1])
                part = down @ a.astype(float) @ across.T
                for gy in range(top // tile, -(-(top + part.shape[0]) // tile)):
                    for gx in range(left // tile, -(-(left + part.shape[1]) // tile)):
                        t, l_ = max(top, gy * tile), max(left, gx * tile)
                        cut = np.ascontiguousarray(part[t - top : (gy + 1) * tile - top, l_ - left : (gx + 1) * tile - left])
                        cells.append((i, gy, gx, t, l_, *cut.shape, cut.tobytes()))
                        held += cut.nbytes
                if len(cells) >= 4096 or held >= 1 << 22:
                    yield made(cells)
                    cells, held = [], 0
            if cells:
                yield made(cells)

    sized = sizes.where("height > 0 and width > 0 and out_h > 0 and out_w > 0").select("image_id", F.col("height").alias("n_h"), F.col("width").alias("n_w"), "out_h", "out_w")
    return tiles.select(*[n for n, _ in _FIELDS]).join(sized.hint("merge"), "image_id").mapInArrow(run, _SHARE_SQL)


def _summed(shares: DataFrame, tile: int, made: Callable[[list[tuple[int, int, int, np.ndarray]]], pa.RecordBatch], schema: str) -> DataFrame:
    """``made`` of output tiles (image_id, y0, x0, sums), some thousand or some megabytes at a time."""

    def kernel(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, gy, gx, y, x, h, w = (C.numbers(batch.column(k)).tolist() for k in ("image_id", "gy", "gx", "y", "x", "h", "w"))
        raw, at = _raw(batch.column("data")), _offsets(batch.column("data")).tolist()
        share = lambda r: np.frombuffer(raw[at[r] : at[r + 1]].tobytes()).reshape(h[r], w[r])
        out, held = [], 0
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
            top, left = gy[a] * tile, gx[a] * tile
            if b - a == 1 and (y[a], x[a]) == (top, left):
                total = share(a)
            else:
                total = np.zeros((max(y[r] + h[r] for r in range(a, b)) - top, max(x[r] + w[r] for r in range(a, b)) - left))
                for r in range(a, b):
                    total[y[r] - top : y[r] - top + h[r], x[r] - left : x[r] - left + w[r]] += share(r)
            out.append((ids[a], top, left, total))
            held += total.nbytes
            if len(out) >= 4096 or held >= 1 << 23:
                yield made(out)
                out, held = [], 0
        if out:
            yield made(out)

    return C.by_key(shares, ["image_id", "gy", "gx"], kernel, schema)


def resample(tiles: DataFrame, sizes: DataFrame, kind: str, tile: int = TILE) -> DataFrame:
    """(image_id, y, x, v as double) of frames (image_id, height, width, out_h, out_w): for soft targets and small outputs."""

    def made(out: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
        ids, y0, x0 = (np.array([o[k] for o in out], np.int64) for k in range(3))
        h, w = (np.array([o[3].shape[k] for o in out], np.int64) for k in (0, 1))
        row = np.repeat(np.arange(len(out)), h * w)
        y, x = np.divmod(np.arange(len(row)) - np.repeat(np.cumsum(h * w) - h * w, h * w), w[row])
        return pa.RecordBatch.from_arrays([C.array(ids[row], pa.int64()), *[pa.array(k.astype(np.int32)) for k in (y + y0[row], x + x0[row])], pa.array(np.concatenate([o[3].ravel() for o in out]))], ["image_id", "y", "x", "v"])

    return _summed(_shares(tiles, sizes, kind, tile), tile, made, "image_id long, y int, x int, v double")


def resize(tiles: DataFrame, sizes: DataFrame, kind: str, tile: int = TILE) -> DataFrame:
    """Tiles of the resized frames, in bytes. Each tile adds its share to the outputs that it feeds, weighted in numpy by its
    place; shares are summed by output tile and rounded once. Only small outputs and tile edges are shuffled on shrinking."""

    def made(out: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
        return batch_of([(i, y, x, np.clip(np.floor(np.round(a, 6) + 0.5), 0, 255).astype(np.uint8)) for i, y, x, a in out])

    return _summed(_shares(tiles, sizes, kind, tile), tile, made, TILE_SQL)


def overlay_green(green: DataFrame, mask: DataFrame, strength: int = 191) -> DataFrame:
    """Green planes raised by ``strength`` (and capped) where the mask's tile at the same place isn't 0. Other planes stay."""
    attach(green.sparkSession)

    def run(planes: pa.Array, masks: pa.Array) -> pa.Array:
        out = []
        for g, m in zip(planes, masks, strict=True):
            g = np.frombuffer(g.as_buffer(), np.uint8)
            hit = np.frombuffer(m.as_buffer(), np.uint8) != 0 if m.is_valid else np.zeros(len(g), bool)
            out.append(np.where(hit, np.minimum(g.astype(np.int32) + strength, 255), g).astype(np.uint8).tobytes())
        return pa.array(out, pa.binary())

    place = ["image_id", "y0", "x0", "height", "width"]
    met = green.join(mask.select(*place, F.col("data").alias("_m")).hint("merge"), place, "left")
    return met.select(*place, F.arrow_udf(run, "binary")(F.col("data"), F.col("_m")).alias("data"))


def overlay_tiles(rgb: DataFrame, mask: DataFrame, strength: int = 191) -> DataFrame:
    """RGB tiles with green raised (and capped) where the mask's tile at the same place isn't 0."""
    attach(rgb.sparkSession)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for planes, masks in batches:
            out = []
            for p, m in zip(planes, masks, strict=True):
                a = np.frombuffer(p.as_buffer(), np.uint8).reshape(-1, 3).copy()
                if m.is_valid:
                    hit = np.frombuffer(m.as_buffer(), np.uint8) != 0
                    a[hit, 1] = np.minimum(a[hit, 1].astype(np.int32) + strength, 255)
                out.append(a.tobytes())
            yield pa.array(out, pa.binary())

    place = ["image_id", "y0", "x0", "height", "width"]
    met = rgb.join(mask.select(*place, F.col("data").alias("_m")).hint("merge"), place, "left")
    return met.select(*place, F.arrow_udf(run, "binary")(F.col("data"), F.col("_m")).alias("data"))


def paste(tiles: DataFrame, boxes: DataFrame, frames: DataFrame, tile: int = TILE, empty: int = 0) -> DataFrame:
    """A crop's tiles at their box (x0, y0) in a frame (width, height) that is ``empty`` elsewhere; also pads to a canvas.

    The frame's empty tiles come from its size, and meet the moved parts on the fixed grid."""
    moved = tiles.join(boxes.select("image_id", F.col("y0").alias("_y"), F.col("x0").alias("_x")).hint("merge"), "image_id")
    moved = moved.select("image_id", (F.col("y0") + F.col("_y")).alias("y0"), (F.col("x0") + F.col("_x")).alias("x0"), "height", "width", "data").withColumn("over", F.lit(1))
    grid = frames.where("height > 0 and width > 0").select("image_id", F.col("height").alias("_h"), F.col("width").alias("_w"))
    for k, side in (("y0", "_h"), ("x0", "_w")):
        grid = grid.withColumn(k, F.explode(F.sequence(F.lit(0), F.col(side) - 1, F.lit(tile))))
    grid = grid.select("image_id", "y0", "x0", F.least(F.lit(tile), F.col("_h") - F.col("y0")).alias("height"), F.least(F.lit(tile), F.col("_w") - F.col("x0")).alias("width"), F.lit(None).cast("binary").alias("data"), F.lit(0).alias("over"))
    attach(tiles.sparkSession)
    fields = [*_FIELDS, ("over", pa.int32())]

    def rows_of(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), [*[k for _, k in fields], pa.int32(), pa.int32()], strict=True)], [*[n for n, _ in fields], "gy", "gx"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, held = [], 0
            for r in batch.to_pylist():
                if not r["over"]:
                    made.append((*[r[k] for k, _ in fields], r["y0"] // tile, r["x0"] // tile))
                else:
                    a, y, x = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"]), r["y0"], r["x0"]
                    held += a.size
                    for top in range(y // tile * tile, y + a.shape[0], tile):
                        for left in range(x // tile * tile, x + a.shape[1], tile):
                            t, l_ = max(top, y), max(left, x)
                            part = np.ascontiguousarray(a[t - y : top + tile - y, l_ - x : left + tile - x])
                            made.append((r["image_id"], t, l_, *part.shape, part.tobytes(), 1, top // tile, left // tile))
                if len(made) >= 4096 or held >= 1 << 22:
                    yield rows_of(made)
                    made, held = [], 0
            if made:
                yield rows_of(made)

    def merge(rows: list[dict]) -> Row | None:
        base = next((r for r in rows if not r["over"]), None)
        if base is None:  # outside the frame
            return None
        cell = np.full((base["height"], base["width"]), empty, np.uint8)
        for r in rows:
            if r["over"]:
                y, x = r["y0"] - base["y0"], r["x0"] - base["x0"]
                view = cell[y : y + r["height"], x : x + r["width"]]
                view[:] = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"])[: view.shape[0], : view.shape[1]]
        return base["image_id"], base["y0"], base["x0"], cell

    def kernel(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows, ends = batch.to_pylist(), [*starts[1:].tolist(), batch.num_rows]
        made = (merge(rows[a:b]) for a, b in zip(starts.tolist(), ends, strict=True))
        yield from batches_of(m for m in made if m is not None)

    both = moved.unionByName(grid).mapInArrow(cut, TILE_SQL + ", over int, gy int, gx int")
    return C.by_key(both, ["image_id", "gy", "gx"], kernel, TILE_SQL)
