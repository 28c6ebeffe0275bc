"""Chains of neighbourhood operators over packed tiles with one exchange.

A chain is a list of steps (``conv3``, ``relu``, ``pool2``, ``upsample2``, ``mix``). From the last step back, the plan works out which
places of the photograph an output tile needs (its halo); every input tile sends its part of them once, and a task runs the
whole chain on one output tile. At each step what lies outside the frame is zero, so that tiles give what the
whole frame would. Values are doubles; a row is an output tile, whatever the photograph's size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import attach
from .packed import _FIELDS, TILE, _rows

Cells = Sequence[tuple[int, int, int, int, float]]
Span = tuple[int, int]
_OUT = [("image_id", pa.int64()), *[(k, pa.int32()) for k in ("y0", "x0", "height", "width", "planes")], ("values", pa.binary())]
_OUT_SQL = "image_id long, y0 int, x0 int, height int, width int, planes int, values binary"


@dataclass(frozen=True)
class Step:
    """Keeps sizes and places, plane by plane."""

    def size(self, n: int) -> int:
        """A side after the step."""
        return n

    def needs(self, span: Span) -> Span:
        """The places of the input that a stretch of the output is made of; they may lie outside the frame."""
        return span

    def apply(self, a: np.ndarray) -> np.ndarray:
        """The output stretch from the input places that it needs."""
        return a


@dataclass(frozen=True)
class Relu(Step):
    def apply(self, a: np.ndarray) -> np.ndarray:
        return np.maximum(a, 0)


@dataclass(frozen=True)
class Weighted(Step):
    """Weighted sums of places and planes; ``weights`` is (dy, dx, in, out), and planes beyond its own count nothing."""

    weights: np.ndarray = field(compare=False)
    bias: np.ndarray = field(compare=False)

    def read(self, a: np.ndarray) -> np.ndarray:
        return a[:, :, : self.weights.shape[2]]


@dataclass(frozen=True)
class Conv3(Weighted):
    def needs(self, span: Span) -> Span:
        return span[0] - 1, span[1] + 1

    def apply(self, a: np.ndarray) -> np.ndarray:
        a, h, w = self.read(a), a.shape[0] - 2, a.shape[1] - 2
        return sum(a[dy : dy + h, dx : dx + w] @ self.weights[dy, dx] for dy in range(3) for dx in range(3)) + self.bias


@dataclass(frozen=True)
class Mix(Weighted):
    def apply(self, a: np.ndarray) -> np.ndarray:
        return self.read(a) @ self.weights[0, 0] + self.bias


@dataclass(frozen=True)
class Pool2(Step):
    def size(self, n: int) -> int:
        return n // 2

    def needs(self, span: Span) -> Span:
        return 2 * span[0], 2 * span[1]

    def apply(self, a: np.ndarray) -> np.ndarray:
        return a.reshape(a.shape[0] // 2, 2, a.shape[1] // 2, 2, a.shape[2]).max(axis=(1, 3))


@dataclass(frozen=True)
class Upsample2(Weighted):
    """Output stretches are cut to even places by the plan, so that every input place gives its whole 2x2 block."""

    def size(self, n: int) -> int:
        return 2 * n

    def needs(self, span: Span) -> Span:
        return span[0] // 2, -(-span[1] // 2)

    def apply(self, a: np.ndarray) -> np.ndarray:
        out = np.empty((a.shape[0], 2, a.shape[1], 2, self.weights.shape[3]))
        for dy in range(2):
            for dx in range(2):
                out[:, dy, :, dx] = self.read(a) @ self.weights[dy, dx] + self.bias
        return out.reshape(2 * a.shape[0], 2 * a.shape[1], out.shape[4])


def _dense(cells: Cells, bias: Sequence[float], side: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    w = np.zeros((side, side, 1 + max(c[2] for c in cells), len(bias)))
    for dy, dx, a, b, v in cells:
        w[dy + shift, dx + shift, a, b] += v
    return w, np.array(bias, float)


def conv3(cells: Cells, bias: Sequence[float]) -> Step:
    """``rasterops.focal_conv3``: cells (dy, dx, in, out, weight), zero padding."""
    return Conv3(*_dense(cells, bias, 3, 1))


def relu() -> Step:
    return Relu()


def pool2() -> Step:
    """``rasterops.max_pool``: an odd last row or column is dropped."""
    return Pool2()


def upsample2(cells: Cells, bias: Sequence[float]) -> Step:
    """``rasterops.upsample2_kernel``."""
    return Upsample2(*_dense(cells, bias, 2, 0))


def mix(weights: Sequence[tuple[int, int, float]], bias: Sequence[float]) -> Step:
    """``rasterops.channel_mix``."""
    return Mix(*_dense([(0, 0, a, b, w) for a, b, w in weights], bias, 1, 0))


def spans(chain: Sequence[Step], out: Span) -> list[Span]:
    """The stretch of each step's input that an output stretch needs, from the first step's to the output itself."""
    needed = [out]
    for step in reversed(chain):
        needed.append(step.needs(needed[-1]))
    return needed[::-1]


def halo(chain: Sequence[Step], tile: int = TILE) -> int:
    """Places that an inner output tile needs beyond its own part of the photograph, on the wider side."""
    a, b = spans(chain, (4 * tile, 5 * tile))[0]
    n = 1 << 20
    for step in chain:
        n = step.size(n)
    scale = (1 << 20) / n
    return int(max(4 * tile * scale - a, b - 5 * tile * scale))


def _within(a: np.ndarray, at: tuple[int, int], rows: Span, columns: Span) -> np.ndarray:
    """The places asked for of an array that begins at ``at``; zero where it has none."""
    if (rows, columns) == ((at[0], at[0] + a.shape[0]), (at[1], at[1] + a.shape[1])):
        return a
    out = np.zeros((rows[1] - rows[0], columns[1] - columns[0], a.shape[2]))
    t, b = max(rows[0], at[0]), min(rows[1], at[0] + a.shape[0])
    l_, r = max(columns[0], at[1]), min(columns[1], at[1] + a.shape[1])
    if t < b and l_ < r:
        out[t - rows[0] : b - rows[0], l_ - columns[0] : r - columns[0]] = a[t - at[0] : b - at[0], l_ - at[1] : r - at[1]]
    return out


def run_chain(chain: Sequence[Step], a: np.ndarray, at: tuple[int, int], frame: tuple[int, int], rows: Span, columns: Span) -> np.ndarray:
    """The chain's output at ``rows`` and ``columns`` from a part of the frame that begins at ``at`` and has all that is needed."""
    ys, xs = spans(chain, rows), spans(chain, columns)
    h, w = frame
    for step, y, x, y_out, x_out in zip(chain, ys[:-1], xs[:-1], ys[1:], xs[1:], strict=True):
        a = step.apply(_within(a, at, y, x))
        h, w = step.size(h), step.size(w)
        top, left = (2 * y[0], 2 * x[0]) if isinstance(step, Upsample2) else (y_out[0], x_out[0])
        # what a step makes of the padding isn't part of its frame
        y_in, x_in = (max(top, 0), min(top + a.shape[0], h)), (max(left, 0), min(left + a.shape[1], w))
        a = a[y_in[0] - top : max(y_in[1], y_in[0]) - top, x_in[0] - left : max(x_in[1], x_in[0]) - left]
        at = (y_in[0], x_in[0])
    return _within(a, at, rows, columns)


def stencil_chain(tiles: DataFrame, chain: Sequence[Step], tile: int = TILE) -> DataFrame:
    """(image_id, y0, x0, height, width, planes, values): output tiles of doubles, for packed tiles that also carry their frame's
    ``frame_h`` and ``frame_w``. Frames that the chain shrinks to nothing have none."""
    attach(tiles.sparkSession)
    chain = list(chain)

    def sized(n: int) -> int:
        for step in chain:
            n = step.size(n)
        return n

    def fed(begin: int, end: int, side: int) -> Iterator[tuple[int, int, int]]:
        """(output tile, first and last place that it needs) of those that an input stretch feeds."""
        out = sized(side)
        for g in range(-(-out // tile)):
            a, b = spans(chain, (g * tile, min(out, (g + 1) * tile)))[0]
            if a < end and begin < b:
                yield g, max(a, begin), min(b, end)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (i, y, x, a), fh, fw in zip(_rows(batch), batch.column("frame_h").to_pylist(), batch.column("frame_w").to_pylist(), strict=True):
                made = []
                for gy, t, b in fed(y, y + a.shape[0], fh):
                    for gx, l_, r in fed(x, x + a.shape[1], fw):
                        part = np.ascontiguousarray(a[t - y : b - y, l_ - x : r - x])
                        made.append((i, t, l_, *part.shape[:2], part.tobytes(), fh, fw, gy, gx))
                columns = list(zip(*made, strict=True)) if made else [[]] * 10
                kinds = [*[k for _, k in _FIELDS], *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*[k for k, _ in _FIELDS], "frame_h", "frame_w", "gy", "gx"])

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, gy, gx = (k.as_py() for k in key)
        given, frame = [], None
        for batch in batches:
            frame = batch.column("frame_h")[0].as_py(), batch.column("frame_w")[0].as_py()
            given += [(y, x, a if a.ndim == 3 else a[:, :, None]) for _, y, x, a in _rows(batch)]
        top, left = min(y for y, _, _ in given), min(x for _, x, _ in given)
        whole = np.zeros((max(y + a.shape[0] for y, _, a in given) - top, max(x + a.shape[1] for _, x, a in given) - left, given[0][2].shape[2]))
        for y, x, a in given:
            whole[y - top : y - top + a.shape[0], x - left : x - left + a.shape[1]] = a
        rows, columns = ((g * tile, min(sized(n), (g + 1) * tile)) for g, n in zip((gy, gx), frame, strict=True))
        out = np.ascontiguousarray(run_chain(chain, whole, (top, left), frame, rows, columns))
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, (_, k) in zip((i, rows[0], columns[0], *out.shape, out.tobytes()), _OUT, strict=True)], [k for k, _ in _OUT])

    names = [*[k for k, _ in _FIELDS], "frame_h", "frame_w"]
    sent = tiles.select(*names).mapInArrow(parts, "image_id long, y0 int, x0 int, height int, width int, data binary, frame_h int, frame_w int, gy int, gx int")
    return sent.groupBy("image_id", "gy", "gx").applyInArrow(run, _OUT_SQL)


def to_values(tiles: DataFrame) -> DataFrame:
    """(image_id, y, x, c, v as double) of output tiles: the long form, for small rasters and tests."""
    attach(tiles.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                v = np.frombuffer(r["values"])
                y, x, c = (k.ravel().astype(np.int32) for k in np.indices((r["height"], r["width"], r["planes"])))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), r["image_id"], np.int64)), pa.array(y + np.int32(r["y0"])), pa.array(x + np.int32(r["x0"])), pa.array(c), pa.array(v)], ["image_id", "y", "x", "c", "v"])

    return tiles.mapInArrow(run, "image_id long, y int, x int, c int, v double")
