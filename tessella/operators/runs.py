"""Binary masks as runs: a row (image_id, band, runs) has the foreground of a band of BAND lines as maximal horizontal stretches.

``runs`` is an array of (y, x0, x1), half-open, ordered by y and x0, none touching another; bands without any have no row. Areas,
boxes, shifts and clips work on the array in built-in functions; unions, intersections and differences sweep over the stretches'
ends in numpy. Nothing is expanded to pixels, and a row holds no more than a band's stretches, whatever the photograph's size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import attach
from .chunks import array, numbers, starts_of
from .packed import _FIELDS, _offsets, _raw, _rows, spread

BAND = 512
#: Stretches that are swept together.
SWEPT = 1 << 17
_RUNS = "array<struct<y:int,x0:int,x1:int>>"
_FORM = pa.list_(pa.struct([(k, pa.int32()) for k in ("y", "x0", "x1")]))


def _swept(row: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray, weight: np.ndarray, need: int) -> tuple[np.ndarray, ...]:
    """(row, y, x0, x1): for each row the maximal stretches where the weights of those that cover a place come to ``need``."""
    line, begin = np.lexsort((y, row)), np.zeros(len(y), np.int64)
    begin[1:] = (np.diff(row[line]) != 0) | (np.diff(y[line]) != 0)
    number = np.empty(len(y), np.int64)
    number[line] = np.cumsum(begin)
    rows, lines = row[line][begin.astype(bool) | (np.arange(len(y)) == 0)], y[line][begin.astype(bool) | (np.arange(len(y)) == 0)]
    place = lambda x: (number << 32) + (x.astype(np.int64) + (1 << 31))
    at, step = np.concatenate([place(x0), place(x1)]), np.concatenate([weight, -weight])
    order = np.lexsort((-step, at))  # what is added counts before what is taken, so that touching stretches become one
    at, high = at[order], np.cumsum(step[order]) >= need
    begin = np.flatnonzero(high & ~np.append(False, high[:-1]))
    end = np.flatnonzero(~high & np.append(False, high[:-1]))
    a, b = at[begin], at[end]
    some = a < b
    a, b = a[some], b[some]
    back = lambda p: ((p & 0xFFFFFFFF) - (1 << 31)).astype(np.int32)
    return rows[a >> 32], lines[a >> 32].astype(np.int32), back(a), back(b)


def _list(offsets: Sequence[int], parts: Sequence[tuple[np.ndarray, ...]]) -> pa.Array:
    columns = [np.concatenate(c) if c else np.empty(0, np.int32) for c in (zip(*parts, strict=True) if parts else [()] * 3)]
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32)), pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], ["y", "x0", "x1"]))


def combined(columns: Sequence[str | Column], weights: Sequence[int], need: int) -> Column:
    """Runs where the weights of the columns that cover a place come to ``need``; a null column covers nothing."""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            given, parts, ends = [], [], [0]
            for c in batch if isinstance(batch, tuple) else (batch,):
                offsets = np.append(0, np.cumsum(np.nan_to_num(c.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)))
                flat = c.flatten()
                given.append((offsets, *[flat.field(k).to_numpy(zero_copy_only=False) for k in ("y", "x0", "x1")]))
            total = sum(g[0] for g in given)
            a = 0
            while a < len(total) - 1:  # rows together, as many as have some hundred thousand stretches
                b = max(a + 1, int(np.searchsorted(total, total[a] + SWEPT, "right")) - 1)
                cut = [[np.repeat(np.arange(b - a), np.diff(g[0][a : b + 1])), *[g[k][g[0][a] : g[0][b]] for k in (1, 2, 3)]] for g in given]
                weight = np.concatenate([np.full(len(c[0]), w, np.int64) for c, w in zip(cut, weights, strict=True)])
                row, *swept = _swept(*[np.concatenate([c[k] for c in cut]) for k in range(4)], weight, need)
                parts.append(tuple(swept))
                ends.extend((ends[-1] + np.searchsorted(row, np.arange(b - a), "right")).tolist())
                a = b
            yield _list(ends, parts)

    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if len(cols) == 1:
        return F.arrow_udf(_one(run), _RUNS)(cols[0])
    return F.arrow_udf(run, _RUNS)(*cols)


def _one(run: Callable) -> Callable:
    def alone(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run((b,) for b in batches)

    return alone


def merged(rows: DataFrame) -> DataFrame:
    """Union of all rows of an image and band: of overlapping tiles, or of several masks."""
    attach(rows.sparkSession)
    return rows.groupBy("image_id", "band").agg(F.flatten(F.collect_list("runs")).alias("_all")).select("image_id", "band", combined(["_all"], [1], 1).alias("runs"))


def from_tiles(tiles: DataFrame, hit: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Runs of packed tiles, which may overlap or touch. ``hit``: which bytes are foreground (else those that aren't 0).

    A tile is turned into runs where it is, so runs and not pixels are shuffled."""
    attach(tiles.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, y0, x0, h, w = (numbers(batch.column(n)).astype(np.int64) for n in ("image_id", "y0", "x0", "height", "width"))
            raw, ends = _raw(batch.column("data")), _offsets(batch.column("data"))
            one = (h * w == np.diff(ends)).all()
            for some, row, (y, x, _) in spread(h, w, 1):
                if one:
                    a = raw[ends[some.start] : ends[some.stop]].reshape(1, -1)
                    on = (hit(a) if hit else a != 0).ravel() != 0
                else:  # several planes: the test is of whole tiles
                    on = np.concatenate([(hit(a) if hit else a != 0).ravel() != 0 for _, _, _, a in _rows(batch.slice(some.start, some.stop - some.start))])
                left, right = on & ((x == 0) | ~np.append(False, on[:-1])), on & ((x == w[row] - 1) | ~np.append(on[1:], False))
                begin, end = np.flatnonzero(left), np.flatnonzero(right)
                t = row[begin]
                line, a, b = y[begin] + y0[t], x[begin] + x0[t], x[end] + x0[t] + 1
                band = line // BAND
                first = starts_of([t, band])
                columns = [array(ids[t][first], pa.int64()), pa.array(band[first].astype(np.int32)), _list(np.append(first, len(t)), [tuple(k.astype(np.int32) for k in (line, a, b))])]
                yield pa.RecordBatch.from_arrays(columns, ["image_id", "band", "runs"])

    return merged(tiles.select(*[n for n, _ in _FIELDS]).mapInArrow(run, f"image_id long, band int, runs {_RUNS}"))


def from_pixels(pixels: DataFrame, hit: Column) -> DataFrame:
    """Runs of long pixels: islands of places without a gap, one shuffle by line."""
    kept = pixels.where(hit).select("image_id", "y", "x").withColumn("_g", F.col("x") - F.row_number().over(Window.partitionBy("image_id", "y").orderBy("x")))
    islands = kept.groupBy("image_id", "y", "_g").agg(F.min("x").cast("int").alias("x0"), (F.max("x") + 1).cast("int").alias("x1"))
    cell = F.struct(F.col("y").cast("int").alias("y"), "x0", "x1")
    return islands.groupBy("image_id", F.floor(F.col("y") / BAND).cast("int").alias("band")).agg(F.array_sort(F.collect_list(cell)).alias("runs"))


def listed(rows: DataFrame) -> DataFrame:
    """(image_id, y, x0, x1): a row a stretch."""
    return rows.select("image_id", F.inline("runs"))


def area(runs: str | Column = "runs") -> Column:
    """Pixels of a row's stretches; 0 of a null."""
    return F.coalesce(F.aggregate(F.col(runs) if isinstance(runs, str) else runs, F.lit(0).cast("long"), lambda n, r: n + r["x1"] - r["x0"]), F.lit(0).cast("long"))


def areas(rows: DataFrame) -> DataFrame:
    """(image_id, area): a sum over bands; the foreground filter is ``area > 0``, and an image without any has no row."""
    return rows.groupBy("image_id").agg(F.sum(area()).alias("area"))


def boxes(rows: DataFrame) -> DataFrame:
    """(image_id, x0, y0, x1, y1): the hull of the bands' own boxes."""
    least = lambda k: F.array_min(F.transform("runs", lambda r: r[k]))
    most = lambda k: F.array_max(F.transform("runs", lambda r: r[k]))
    return rows.where(F.size("runs") > 0).groupBy("image_id").agg(F.min(least("x0")).alias("x0"), F.min(least("y")).alias("y0"), F.max(most("x1")).alias("x1"), (F.max(most("y")) + 1).alias("y1"))


def shift(rows: DataFrame, dy: str | Column, dx: str | Column) -> DataFrame:
    """Runs moved by columns of their row; a row's stretches then lie in two bands at most, which meet their other half."""
    y, x = (F.col(c) if isinstance(c, str) else c for c in (dy, dx))
    moved = rows.withColumns({"_y": y.cast("int"), "_x": x.cast("int")})
    moved = moved.withColumn("_runs", F.expr("transform(runs, r -> named_struct('y', r.y + _y, 'x0', r.x0 + _x, 'x1', r.x1 + _x))"))
    first = F.floor((F.col("band") * BAND + F.col("_y")) / BAND).cast("int")
    halves = moved.withColumn("_band", F.explode(F.array(first, first + 1)))
    halves = halves.select("image_id", F.col("_band").alias("band"), F.expr(f"filter(_runs, r -> floor(r.y / {BAND}) = _band)").alias("runs")).where(F.size("runs") > 0)
    return halves.groupBy("image_id", "band").agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"))


def clip(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Runs cut to their image's box (x0, y0, x1, y1); images without a box are left out, like bands outside it."""
    met = rows.join(frames.select("image_id", *[F.col(k).alias(f"_{k}") for k in ("x0", "y0", "x1", "y1")]), "image_id")
    met = met.where((F.col("band") + 1) * BAND > F.col("_y0")).where(F.col("band") * BAND < F.col("_y1"))
    cut = F.expr("filter(transform(filter(runs, r -> r.y >= _y0 AND r.y < _y1), r -> named_struct('y', r.y, 'x0', greatest(r.x0, _x0), 'x1', least(r.x1, _x1))), r -> r.x0 < r.x1)")
    return met.select("image_id", "band", cut.alias("runs")).where(F.size("runs") > 0)


def _met(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    attach(a.sparkSession)
    return a.select("image_id", "band", F.col("runs").alias("_a")).join(b.select("image_id", "band", F.col("runs").alias("_b")), ["image_id", "band"], how)


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return _met(a, b, "full").select("image_id", "band", combined(["_a", "_b"], [1, 1], 1).alias("runs"))


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return _met(a, b, "inner").select("image_id", "band", combined(["_a", "_b"], [1, 1], 2).alias("runs")).where(F.size("runs") > 0)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """What is in a and not in b."""
    return _met(a, b, "left").select("image_id", "band", combined(["_a", "_b"], [1, -1], 1).alias("runs")).where(F.size("runs") > 0)


def overlap_counts(pred: DataFrame, target: DataFrame) -> DataFrame:
    """(image_id, tp, fp, fn) of masks as runs, for ``metrics.iou`` and ``metrics.dice``; images without foreground in either have no row."""
    met = _met(pred, target, "full").withColumn("_c", combined(["_a", "_b"], [1, 1], 2))
    sums = met.groupBy("image_id").agg(F.sum(area("_c")).alias("tp"), F.sum(area("_a")).alias("_p"), F.sum(area("_b")).alias("_t"))
    return sums.select("image_id", "tp", (F.col("_p") - F.col("tp")).alias("fp"), (F.col("_t") - F.col("tp")).alias("fn"))


def to_tiles(rows: DataFrame) -> DataFrame:
    """Packed 0/1 tiles, one for each row's own hull: for pasting, drawing and files."""
    attach(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, runs in zip(batch.column("image_id").to_pylist(), batch.column("runs"), strict=True):
                y, x0, x1 = (runs.values.field(k).to_numpy() for k in ("y", "x0", "x1"))
                top, left = int(y.min()), int(x0.min())
                edge = np.zeros((int(y.max()) - top + 1, int(x1.max()) - left + 1), np.int8)
                edge[y - top, x0 - left] += 1
                edge[y - top, x1 - left] -= 1
                cell = np.cumsum(edge, axis=1, dtype=np.int8)[:, :-1].astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip((i, top, left, *cell.shape, cell.tobytes()), _FIELDS, strict=True)], [n for n, _ in _FIELDS])

    return rows.where(F.size("runs") > 0).select("image_id", "runs").mapInArrow(run, "image_id long, y0 int, x0 int, height int, width int, data binary")
