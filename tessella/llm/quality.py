"""Quality rules by repetition coverage: rolling hashes of several n-gram lengths measure the share of characters inside
duplicated n-grams and duplicated lines.

Words are runs of bytes other than space and 0x09-0x0D. Hashes are 64-bit polynomial prefix sums, so every n-gram length
costs a few numpy passes. Rows are independent: no shuffle, and memory is bounded by one slab (or one text, if longer).

Defined cases: a null text counts as empty (no words, so the base rule fails); ties and repeated rows get equal results;
other columns are carried along untouched, and only ``text_col`` is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLAB_BYTES, attach, give_back, slabs, utf8

#: Window of the base rule, in words.
BASE_WORDS = 5
#: Largest share of word characters inside duplicated n-grams, by n-gram length in words.
#: Three and four words: half-way up the gap between labelled texts that repeat short runs over and over and all others.
#: Beyond the base rule, longer runs don't tell labelled good from bad texts apart; their limits hold for other word sizes.
NGRAM_LIMITS = {3: 0.30, 4: 0.30, 5: 0.25, 7: 0.22, 10: 0.20}
#: Largest share of word-bearing characters inside lines that repeat an earlier line.
LINE_LIMIT = 0.30

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEADS = (np.arange(256) & 0xC0) != 0x80
_BYTE = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLAB_BYTES + 1), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if n <= SLAB_BYTES + 1:
            _powers[base] = have
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_Q)
    return x ^ (x >> np.uint64(29))


def word_table(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, hash and number of code points of each word. Works in blocks that end at a space, so byte-level arrays stay small."""
    begins, hashes, chars = [], [], []
    n, a = len(data), 0
    while a < n:
        b = min(n, a + SLAB_BYTES)
        if b < n:
            gaps = np.flatnonzero(_SPACE[data[a:b]])
            if len(gaps):
                b = a + int(gaps[-1]) + 1
            else:
                step = b
                while step < n and not _SPACE[data[step : step + SLAB_BYTES]].any():
                    step += SLAB_BYTES
                b = min(n, step + int(np.argmax(_SPACE[data[step : step + SLAB_BYTES]])) + 1) if step < n else n
        block = data[a:b]
        word = ~_SPACE[block]
        first = at[np.searchsorted(at, a) : np.searchsorted(at, b)] - a  # texts that begin here
        head = np.empty(len(block), bool)
        head[0], head[1:] = True, ~word[:-1]
        head[first] = True
        start = np.flatnonzero(word & head)
        if len(start):
            tail = np.empty(len(block), bool)
            tail[-1], tail[:-1] = True, ~word[1:]
            tail[first[first > 0] - 1] = True
            end = np.flatnonzero(word & tail) + 1
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(_BYTE[block] * _power(_P, len(block)), out=sums[1:])
            hashes.append(_mix((sums[end] - sums[start]) * _power(_P_INVERSE, len(block))[start] + (end - start).astype(np.uint64)))
            points = np.zeros(len(block) + 1, np.int32)
            np.cumsum(_LEADS[block], out=points[1:])
            chars.append(points[end] - points[start])
            begins.append(start + a)
        a = b
    if not begins:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(begins), np.concatenate(hashes), np.concatenate(chars).astype(np.int64)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated(hashes: np.ndarray, text: np.ndarray, n: int, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Window starts whose n words occur again in the same text, and a mask of the words that such windows cover.

    ``among``: starts that can qualify at all (those of duplicated shorter windows)."""
    m = len(hashes) - n + 1
    covered = np.zeros(len(hashes), bool)
    starts = np.arange(max(0, m)) if among is None else among[among < m]
    starts = starts[text[starts] == text[starts + n - 1]] if len(starts) else starts
    if len(starts) < 2:
        return np.empty(0, np.int64), covered
    key = text[starts].astype(np.uint64) * np.uint64(_P)
    for j in range(n):
        key = key * np.uint64(_Q) + hashes[starts + j]
    key = _mix(key)
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.empty(0, np.int64), covered
    spot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    starts = starts[twice[spot] == key]
    edge = np.zeros(len(hashes) + 1, np.int32)
    edge[starts] += 1
    edge[starts + n] -= 1  # starts are distinct, so plain indexing adds each once
    return starts, np.cumsum(edge[:-1]) > 0


def _lines(data: np.ndarray, at: np.ndarray) -> tuple[list[int], list[int]]:
    counts, sizes = [], []
    for i in range(len(at) - 1):
        lines = data[at[i] : at[i + 1]].tobytes().split(b"\n")
        n = size = 0
        if len(lines) > 1:
            seen: set[bytes] = set()
            for line in lines:
                if line in seen:
                    n += 1
                    size += len(b"".join(line.split()).decode("utf-8", "replace"))
                elif line.split(None, 1):
                    seen.add(line)
        counts.append(n)
        sizes.append(size)
    return counts, sizes


def measure(texts: pa.Array, ngram_limits: dict[int, float], line_limit: float, min_words: int, max_repeat_percent: int) -> dict[str, np.ndarray]:
    data, at = utf8(texts)
    begins, hashes, chars = word_table(data, at)
    bounds = np.searchsorted(begins, at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(bounds))
    out = {"n_words": np.diff(bounds), "word_chars": per_text(chars, bounds), "n_symbols": per_text(_SYMBOL[data], at)}
    dup_lines, dup_line_chars = _lines(data, at)
    out["n_dup_lines"] = np.array(dup_lines, np.int64)
    total = np.maximum(out["word_chars"], 1)
    out["dup_line_share"] = np.array(dup_line_chars, np.int64) / total
    worst = np.zeros(len(at) - 1)
    bad = out["dup_line_share"] > line_limit
    among = None
    for n in sorted({BASE_WORDS, *ngram_limits}):
        among, covered = repeated(hashes, text, n, among)  # a duplicated window begins with a duplicated shorter one
        if n == BASE_WORDS:
            out["n_repeat_words"] = per_text(covered, bounds)
        if n in ngram_limits:
            share = per_text(np.where(covered, chars, 0), bounds) / total
            worst = np.maximum(worst, share)
            bad |= share > ngram_limits[n]
    out["ngram_share"] = worst
    out["base_failed"] = (out["n_words"] < min_words) | (100 * out["n_repeat_words"] > max_repeat_percent * out["n_words"])
    out["kept"] = ~(out["base_failed"] | bad)
    return out


_FIELDS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "ngram_share": pa.float64(), "dup_line_share": pa.float64()}
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ngram_share double, dup_line_share double"


def quality_column(text_col: str = "text", ngram_limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT, min_words: int = 10, max_repeat_percent: int = 20):
    """A struct column of measures and the verdict ``kept``."""
    limits = dict(ngram_limits)

    def rules(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [measure(slab, limits, line_limit, min_words, max_repeat_percent) for slab in slabs(batch)]
            del batch
            yield give_back(pa.StructArray.from_arrays([pa.array(np.concatenate([p[k] for p in parts]) if parts else [], kind) for k, kind in _FIELDS.items()], list(_FIELDS)))

    return F.arrow_udf(rules, SCHEMA)(F.col(text_col))


def measure_quality(df: DataFrame, text_col: str = "text", into: str = "quality", **limits) -> DataFrame:
    """All columns of ``df`` and the struct ``into`` (an input column of that name is replaced)."""
    attach(df.sparkSession)
    return df.withColumn(into, quality_column(text_col, **limits))


def keep_quality(df: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows whose text passes, with their own columns."""
    attach(df.sparkSession)
    return df.where(quality_column(text_col, **limits)["kept"])
