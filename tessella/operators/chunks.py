"""Rows that travel as chunks: neighbouring rows of a key become one row (keys, n, a binary column for each column) before an exchange.

A long pixel is some fifty bytes in an exchange and a few in a chunk. After it, all chunks of a key are met again in windows of bounded
size, as flat arrays over many keys at once, so that neither the planner's guess of a table's size nor the number of keys matters."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType

from ..session import attach

#: Rows (of the long form) that a task holds as arrays at a time, and bytes of packed rows.
WINDOW, WINDOW_BYTES = 1 << 18, 1 << 24
#: Stands for null among integers.
NULL = -(1 << 63)
_WHOLE, _REAL = (ByteType, ShortType, IntegerType, LongType), (FloatType, DoubleType, DecimalType)


def fits(rows: DataFrame, columns: Sequence[str]) -> bool:
    """Whether the columns are numbers, which chunks can hold."""
    return all(isinstance(rows.schema[c].dataType, _WHOLE + _REAL) for c in columns)


@dataclass
class Chunks:
    """``frame``: (keys, n, _0, _1, ...), the columns as packed arrays; ``real``: which of them are reals."""

    frame: DataFrame
    keys: list[str]
    real: list[bool]


@dataclass
class Flat:
    """Rows of some chunks: ``g`` is the number of each row's key in the window (or of its chunk), ``columns`` their values."""

    g: np.ndarray
    columns: list[np.ndarray]


def numbers(a: pa.Array) -> np.ndarray:
    """Values of a column: NULL for an integer that is null, NaN for a real one."""
    if a.null_count and pa.types.is_integer(a.type):
        return a.cast(pa.int64()).fill_null(NULL).to_numpy()
    return a.to_numpy(zero_copy_only=False)


def array(v: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The reverse: integers are cast as Spark does, NULL becomes null."""
    if v.dtype == np.int64 and v.dtype.kind == "i" and len(v) and v.min() == NULL:
        none = v == NULL
        return pa.array(np.where(none, 0, v).astype(kind.to_pandas_dtype()), kind, mask=none)
    return pa.array(v.astype(kind.to_pandas_dtype(), copy=False), kind)


def binaries(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _narrow(v: np.ndarray) -> np.ndarray:
    if v.dtype.kind == "f":
        return v.astype(np.float64)
    low, high = v.min(), v.max()
    for kind in (np.uint8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return v.astype(kind)
    return v.astype(np.int64)


def starts_of(keys: Sequence[np.ndarray]) -> np.ndarray:
    """Where a row's key differs from the row before."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def pieces(keys: Sequence[np.ndarray], columns: Sequence[np.ndarray]) -> list[pa.Array]:
    """Arrays of chunk rows (keys, n, columns); rows are sorted by key first if most stand alone."""
    starts = starts_of(keys)
    if len(starts) * 8 > len(keys[0]) + 64:
        order = np.lexsort(keys[::-1])
        keys, columns = [k[order] for k in keys], [c[order] for c in columns]
        starts = starts_of(keys)
    ends = np.append(starts, len(keys[0]))
    packed = [_narrow(c) for c in columns] if len(keys[0]) else [np.empty(0, np.uint8) for _ in columns]
    return [*[pa.array(k[starts], pa.int64()) for k in keys], pa.array(np.diff(ends), pa.int32()), *[binaries(ends * c.itemsize, c.view(np.uint8)) for c in packed]]


def schema_of(keys: Sequence[str], n: int) -> str:
    return ", ".join([*[f"{k} long" for k in keys], "n int", *[f"_{i} binary" for i in range(n)]])


def chunked(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> Chunks:
    attach(rows.sparkSession)
    real = [isinstance(rows.schema[c].dataType, _REAL) for c in columns]
    given = rows.select(*[F.col(k).cast("long").alias(k) for k in keys], *[F.col(c).cast("double" if r else rows.schema[c].dataType).alias(f"_{i}") for i, (c, r) in enumerate(zip(columns, real, strict=True))])
    names = [*keys, "n", *[f"_{i}" for i in range(len(columns))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = [numbers(c) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(pieces(values[: len(keys)], values[len(keys) :]), names)

    return Chunks(given.mapInArrow(run, schema_of(keys, len(columns))), list(keys), real)


def flat(batch: pa.RecordBatch, group: np.ndarray, real: Sequence[bool]) -> Flat:
    """The rows of a batch's chunks; ``group``: a number for each chunk."""
    n = batch.column("n").to_numpy()
    total, columns = int(n.sum()), []
    for i, is_real in enumerate(real):
        packed = batch.column(f"_{i}")
        offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1].astype(np.int64)
        raw = np.frombuffer(packed.buffers()[2], np.uint8) if packed.buffers()[2] else np.empty(0, np.uint8)
        wide = np.diff(offsets) // np.maximum(n, 1)
        kinds = {1: np.uint8, 2: np.int16, 4: np.int32, 8: np.float64 if is_real else np.int64, 0: np.uint8}
        at = np.append(starts_of([wide]), len(wide)) if len(wide) else [0]
        parts = [np.frombuffer(raw[offsets[a] : offsets[b]].tobytes(), kinds[int(wide[a])]) for a, b in zip(at[:-1], at[1:], strict=True)]
        columns.append(np.concatenate([p.astype(np.float64 if is_real else np.int64) for p in parts]) if parts else np.empty(0, np.float64 if is_real else np.int64))
        assert len(columns[-1]) == total
    return Flat(np.repeat(group, n), columns)


def windows(batches: Iterator[pa.RecordBatch], keys: Sequence[str], weight: Callable[[pa.RecordBatch], np.ndarray], most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, where each key begins) of batches that are sorted by key: whole keys, as many as come to ``most`` together."""

    def cut(ready: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        batch = ready[0] if len(ready) == 1 else pa.concat_batches(ready)
        starts = np.append(starts_of([numbers(batch.column(k)) for k in keys]), batch.num_rows)
        before = np.append(0, np.cumsum(weight(batch)))[starts]
        a = 0
        while a < len(starts) - 1:
            b = max(a + 1, int(np.searchsorted(before, before[a] + most, "right")) - 1)
            yield batch.slice(starts[a], starts[b] - starts[a]), starts[a:b] - starts[a]
            a = b

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = [numbers(batch.column(k)) for k in keys]
        begin = starts_of(at)
        if last == [k[0] for k in at]:
            begin = begin[1:]
        last = [k[-1] for k in at]
        if not len(begin):
            held.append(batch)
            continue
        if held or begin[-1]:
            yield from cut([*held, *([batch.slice(0, begin[-1])] if begin[-1] else [])])
        held = [batch.slice(begin[-1])]
    if held:
        yield from cut(held)


def _sorted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def gathered(sides: Sequence[Chunks], fn: Callable[[list[np.ndarray], list[Flat]], Iterator[pa.RecordBatch]], schema: str, weight: Callable[[pa.RecordBatch], np.ndarray] = lambda b: b.column("n").to_numpy()) -> DataFrame:
    """``fn`` of windows of whole keys: (the keys' columns, the rows of each side by the number of their key, in its order)."""
    keys, most = sides[0].keys, max(len(s.real) for s in sides)
    pad = lambda s: [F.col(f"_{i}") if i < len(s.real) else F.lit(None).cast("binary").alias(f"_{i}") for i in range(most)]
    rows = None
    for number, s in enumerate(sides):
        part = s.frame.select(*keys, F.lit(number).cast("int").alias("_side"), "n", *pad(s))
        rows = part if rows is None else rows.unionByName(part)
    real = [s.real for s in sides]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in windows(batches, keys, weight, WINDOW):
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, batch.num_rows)))
            side = batch.column("_side").to_numpy()
            flats = []
            for number, r in enumerate(real):
                own = np.flatnonzero(side == number)
                flats.append(flat(batch if len(own) == len(side) else batch.take(pa.array(own)), group[own], r))
            yield from fn([numbers(batch.column(k))[starts] for k in keys], flats)

    return _sorted(rows, keys).mapInArrow(run, schema)


def by_key(rows: DataFrame, keys: Sequence[str], kernel: Callable[[pa.RecordBatch, np.ndarray], Iterator[pa.RecordBatch]], schema: str, sized: str = "data") -> DataFrame:
    """``kernel`` of whole keys' rows and where each key begins, some megabytes of the binary column ``sized`` at a time."""
    attach(rows.sparkSession)

    def weight(batch: pa.RecordBatch) -> np.ndarray:
        column = batch.column(sized)
        return np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]).astype(np.int64) + 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in windows(batches, keys, weight, WINDOW_BYTES):
            yield from kernel(batch, starts)

    return _sorted(rows, keys).mapInArrow(run, schema)


def met(rows: DataFrame, other: DataFrame, value: str, cell: int = 512) -> DataFrame:
    """``rows`` (image_id, y, x, ...) with ``value`` of ``other`` at the same place: an inner join whose sides travel as chunks of cells.

    The join's columns stand first. Columns that aren't numbers take an ordinary join, sorted, never broadcast."""
    place = ["image_id", "y", "x"]
    rest = [c for c in rows.columns if c not in place]
    if not (fits(rows, rows.columns) and fits(other, [*place, value])) or any(isinstance(d.schema[k].dataType, _REAL) for d in (rows, other) for k in place):
        return rows.join(other.select(*place, value).hint("merge"), place)
    keys = ["image_id", "_cy", "_cx"]
    cells = lambda d: d.where(" AND ".join(f"{k} IS NOT NULL" for k in place)).withColumns({f"_c{k}": F.floor(F.col(k) / cell) for k in ("y", "x")})
    kinds = [rows.schema[c].dataType.simpleString() for c in (*place, *rest)] + [other.schema[value].dataType.simpleString()]
    out = pa_types(kinds)
    names = [*place, *rest, value]

    def run(groups: list[np.ndarray], sides: list[Flat]) -> Iterator[pa.RecordBatch]:
        a, b = sides
        at = lambda f: (f.g * cell + (f.columns[0] - groups[1][f.g] * cell)) * cell + (f.columns[1] - groups[2][f.g] * cell)
        want, have, m = at(a), at(b), b.columns[2]
        if len(have) > 1 and (have[1:] < have[:-1]).any():
            order = np.argsort(have, kind="stable")
            have, m = have[order], m[order]
        low, high = np.searchsorted(have, want), np.searchsorted(have, want, "right")
        times = high - low
        pick = np.repeat(np.arange(len(want)), times)
        nth = low[pick] + np.arange(len(pick)) - np.repeat(np.cumsum(times) - times, times)
        columns = [groups[0][a.g[pick]], *[c[pick] for c in a.columns], m[nth]]
        yield pa.RecordBatch.from_arrays([array(c, k) for c, k in zip(columns, out, strict=True)], names)

    both = [chunked(cells(rows), keys, ["y", "x", *rest]), chunked(cells(other), keys, ["y", "x", value])]
    made = gathered(both, run, ", ".join(f"`{n}` {k if not k.startswith('decimal') else 'double'}" for n, k in zip(names, kinds, strict=True)))
    return made.select(*[F.col(n).cast(k) if k.startswith("decimal") else F.col(n) for n, k in zip(names, kinds, strict=True)])


def by_place(pixels: DataFrame, columns: Sequence[str], fn: Callable[..., list[pa.Array]], made: Sequence[str], cell: int = 512) -> DataFrame:
    """(image_id, y, x, made...): a row for each place. ``fn`` gets the places of a window (ids, y, x), the number of each pixel's
    place, and the columns."""
    rows = pixels.withColumns({f"_c{k}": F.floor(F.col(k) / cell) for k in ("y", "x")})
    y_kind, x_kind = (pixels.schema[k].dataType.simpleString() for k in ("y", "x"))
    kinds = pa_types([y_kind, x_kind])

    def run(groups: list[np.ndarray], sides: list[Flat]) -> Iterator[pa.RecordBatch]:
        f = sides[0]
        y, x, *rest = f.columns
        place = (f.g * cell + (y - groups[1][f.g] * cell)) * cell + (x - groups[2][f.g] * cell)
        if len(place) > 1 and (place[1:] < place[:-1]).any():
            order = np.argsort(place, kind="stable")
            place, y, x, g, rest = place[order], y[order], x[order], f.g[order], [k[order] for k in rest]
        else:
            g = f.g
        first = starts_of([place])
        number = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(place))))
        places = [groups[0][g[first]], y[first], x[first]]
        columns = [array(places[0], pa.int64()), *[array(p, k) for p, k in zip(places[1:], kinds, strict=True)], *fn(places, number, *rest)]
        yield pa.RecordBatch.from_arrays(columns, ["image_id", "y", "x", *[m.split(" ")[0] for m in made]])

    return gathered([chunked(rows, ["image_id", "_cy", "_cx"], ["y", "x", *columns])], run, ", ".join(["image_id long", f"y {y_kind}", f"x {x_kind}", *made]))


def pa_types(kinds: Sequence[str]) -> list[pa.DataType]:
    known = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32()}
    return [known.get(k, pa.float64()) for k in kinds]


def boxed(rows: DataFrame, boxes: DataFrame, columns: Sequence[str], sides: Sequence[str], fn: Callable[[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]], Iterator[pa.RecordBatch]], schema: str, keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """``fn`` of rows and their image's box: (the chunks' ids, the number of each row's chunk, ``columns`` of the rows, ``sides`` by chunk).

    Chunks of an image are joined with its box, so that no pixel is; neither side is broadcast."""
    key = keys[0]
    chunks = chunked(rows.where(F.col(key).isNotNull()), [key], columns)
    real, n_sides = chunks.real, len(sides)
    whole = boxes.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), *[F.col(k).cast("long").alias(f"_b{i}") for i, k in enumerate(sides)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.append(0, np.cumsum(batch.column("n").to_numpy().astype(np.int64)))
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + WINDOW, "right")) - 1)
                part = batch.slice(a, b - a)
                f = flat(part, np.arange(b - a), real)
                yield from fn(part.column(key).to_numpy(), f.g, f.columns, [numbers(part.column(f"_b{i}")) for i in range(n_sides)])
                a = b

    return chunks.frame.join(whole.hint("merge"), key).mapInArrow(run, schema)


def placed(pixels: DataFrame, boxes: DataFrame, canvases: DataFrame, value: str, fill: int, stretch: bool = False, cell: int = 512) -> DataFrame:
    """(image_id, y, x, value) of every place of ``canvases`` (image_id, height, width): what lies in an image's box (x0, y0, x1, y1)
    moved by (dy, dx), and ``fill`` elsewhere.

    With ``stretch``, boxes carry ``stretch`` and ``target`` too: where the former is set the box's pixels are spread over a square of
    that side, each output taking the nearest pixel, and nothing is filled in. Pixels meet their canvas by cells of it."""
    kind = pixels.schema[value].dataType
    real = isinstance(kind, _REAL)
    keys, sides = ["image_id", "_cy", "_cx"], ["y0", "x0", "y1", "x1", "dy", "dx", *(["stretch", "target"] if stretch else [])]

    def move(ids: np.ndarray, g: np.ndarray, columns: list[np.ndarray], box: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        y, x, v = columns
        y0, x0, y1, x1 = box[:4]
        inside = np.flatnonzero((y >= y0[g]) & (y < y1[g]) & (x >= x0[g]) & (x < x1[g]) & (~np.isnan(v) if real else v != NULL))
        g, y, x, v = g[inside], y[inside], x[inside], v[inside]
        y, x = y + box[4][g], x + box[5][g]
        if stretch:
            wide = (box[6] == 1)[g]
            spread = [_fed(y[wide] - box[4][g][wide] - y0[g][wide], (y1 - y0)[g][wide], box[7][g][wide]), _fed(x[wide] - box[5][g][wide] - x0[g][wide], (x1 - x0)[g][wide], box[7][g][wide])]
            (top, down), (left, across) = spread
            times = down * across
            pick = np.repeat(np.arange(len(times)), times)
            nth = np.arange(len(pick)) - np.repeat(np.cumsum(times) - times, times)
            own = np.flatnonzero(wide)[pick]
            y, x = np.concatenate([y[~wide], top[pick] + nth // across[pick]]), np.concatenate([x[~wide], left[pick] + nth % across[pick]])
            g, v = np.concatenate([g[~wide], g[own]]), np.concatenate([v[~wide], v[own]])
        if len(y):
            yield pa.RecordBatch.from_arrays(pieces([ids[g], y // cell, x // cell], [y, x, v]), [*keys, "n", "_0", "_1", "_2"])

    moved = boxed(pixels.where("y IS NOT NULL AND x IS NOT NULL").select("image_id", "y", "x", value), boxes, ["y", "x", value], sides, move, schema_of(keys, 3))
    filled = F.col("filled").cast("int") if "filled" in canvases.columns else F.lit(1)
    grid = canvases.where("height > 0 AND width > 0").select("image_id", F.col("height").cast("int").alias("_h"), F.col("width").cast("int").alias("_w"), filled.alias("_f"))
    for k, side in (("_cy", "_h"), ("_cx", "_w")):
        grid = grid.withColumn(k, F.explode(F.sequence(F.lit(0), F.floor((F.col(side) - 1) / cell).cast("int"))))
    frames = chunked(grid, keys, ["_h", "_w", "_f"])
    out = pa_types([kind.simpleString()])[0]

    def canvas(groups: list[np.ndarray], given: list[Flat]) -> Iterator[pa.RecordBatch]:
        p, f = given
        g = f.g
        top, left = groups[1] * cell, groups[2] * cell
        h, w, fills = np.zeros(len(top), np.int64), np.zeros(len(top), np.int64), np.zeros(len(top), bool)
        h[g], w[g] = np.minimum(cell, f.columns[0] - top[g]), np.minimum(cell, f.columns[1] - left[g])
        fills[g] = f.columns[2] == 1
        inside = (p.columns[0] - top[p.g] < h[p.g]) & (p.columns[1] - left[p.g] < w[p.g])
        where = p.g[inside]
        ends = np.append(0, np.cumsum(h * w))
        v, known = np.full(ends[-1], fill, np.float64 if real else np.int64), np.repeat(fills, h * w)
        at = ends[where] + (p.columns[0][inside] - top[where]) * w[where] + p.columns[1][inside] - left[where]
        v[at], known[at] = p.columns[2][inside], True
        row = np.repeat(np.arange(len(top)), h * w)
        y, x = np.divmod(np.arange(ends[-1]) - ends[row], np.maximum(w[row], 1))
        some = slice(None) if known.all() else np.flatnonzero(known)
        row = row[some]
        yield pa.RecordBatch.from_arrays([pa.array(groups[0][row]), pa.array((y[some] + top[row]).astype(np.int32)), pa.array((x[some] + left[row]).astype(np.int32)), array(v[some], out)], ["image_id", "y", "x", value])


    def weight(batch: pa.RecordBatch) -> np.ndarray:
        """Places of a canvas, as well as pixels."""
        n, own = batch.column("n").to_numpy().astype(np.int64), np.flatnonzero(batch.column("_side").to_numpy() == 1)
        size = flat(batch.take(pa.array(own)), own, [False] * 3)
        h, w = (np.clip(size.columns[i] - numbers(batch.column(k))[size.g] * cell, 0, cell) for i, k in enumerate(keys[1:]))
        np.add.at(n, size.g, h * w)
        return n

    made = gathered([Chunks(moved, keys, [False, False, real]), frames], canvas, f"image_id long, y int, x int, `{value}` {'double' if real else kind.simpleString()}", weight)
    return made if not real else made.withColumn(value, F.col(value).cast(kind))


def _fed(at: np.ndarray, n_src: np.ndarray, n_dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first output, how many) that take the pixel ``at``: floor((dst + 0.5) * n_src / n_dst)."""
    reached = lambda k: (2 * (at + k) * n_dst + n_src - 1) // (2 * n_src)
    return reached(0), reached(1) - reached(0)
