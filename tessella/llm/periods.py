"""Periodic runs of words: stretches that repeat themselves, found from the suffixes of each text.

A run is a stretch of words that are equal at distance q, its smallest period, which no neighbouring word extends, and which has at
least ``least`` words and ``times`` periods. Suffixes of the words are sorted (prefix doubling in numpy) with their common
prefixes. Then Kruskal's way over the sorted suffixes: classes are united by falling common prefix, each with its
positions in order; where a union makes two positions neighbours whose distance is within the prefix, the stretch from the first
one to the end of the second one's prefix has that distance as its smallest period, and it is a run if no word in front extends it.
A run's own two first positions always become neighbours: one between them would give the run a smaller period. Only prefixes
of a run's least length less its period can show one, so texts without a repeat of that many words have no suffixes sorted.

Each text is a task's own affair: rows are never shuffled, and memory is that of one text's suffixes.

Defined cases: a null text has no words, like an empty one; words are split at the six ASCII white space characters alone; other
columns are kept as they are, and a column with the result's name is replaced.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, give_back

LEAST = 24
TIMES = 3
#: Most positions in a part of an ordered set, before it is halved.
PART = 1024
_STRUCT = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_ODD = 0x9E3779B97F4A7C15


class Positions:
    """An ordered set of numbers that tells a new member's neighbours; parts are halved, so adding moves few members."""

    __slots__ = ("n", "parts")

    def __init__(self, first: int):
        self.parts, self.n = [[first]], 1

    def add(self, p: int) -> tuple[int, int]:
        """The members before and after p, or -1."""
        parts = self.parts
        k = min(bisect_left(parts, p, key=lambda part: part[-1]), len(parts) - 1) if len(parts) > 1 else 0
        part = parts[k]
        i = bisect_left(part, p)
        before = part[i - 1] if i else parts[k - 1][-1] if k else -1
        after = part[i] if i < len(part) else parts[k + 1][0] if k + 1 < len(parts) else -1
        part.insert(i, p)
        self.n += 1
        if len(part) > PART:
            parts[k : k + 1] = [part[: PART // 2], part[PART // 2 :]]
        return before, after

    def __iter__(self) -> Iterator[int]:
        for part in self.parts:
            yield from part


def shortest_prefix(least: int, times: int) -> int:
    """The least common prefix of a run's first two positions: its length without one period."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def _numbers(words: list[bytes]) -> np.ndarray:
    """Each word's number, by first occurrence and from 1."""
    table: dict[bytes, int] = {}
    return np.fromiter((table.setdefault(w, len(table) + 1) for w in words), np.int64, len(words))


def _repeats(x: np.ndarray, k: int) -> bool:
    """Whether a window of k words may come twice: by hashes, so without a miss."""
    if len(x) <= k:
        return False
    h, width, base = x.astype(np.uint64) * np.uint64(_ODD), 1, _ODD
    h ^= h >> np.uint64(31)
    while width < k:
        step = min(width, k - width)
        # windows of ``width`` and the same one ``step`` later overlap or touch, and cover width + step words
        h = h[:-step] * np.uint64(base) + (h[step:] ^ (h[step:] >> np.uint64(29)))
        base, width = base * _ODD % 2**64, width + step
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def _suffixes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, and the common prefix of each with the one before it (first: 0)."""
    n = len(x)
    levels, k = [(1, np.append(np.unique(x, return_inverse=True)[1] + 1, 0))], 1
    while k < n and levels[-1][1].max() < n:
        rank = levels[-1][1]
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:n]
        k *= 2
        levels.append((k, np.append(np.unique(rank[:n] * (n + 1) + after, return_inverse=True)[1] + 1, 0)))
    order = np.argsort(levels[-1][1][:n], kind="stable")
    a, b, common = order[:-1], order[1:], np.zeros(n, np.int64)
    shared = common[1:]
    for k, rank in reversed(levels):
        same = rank[np.minimum(a + shared, n)] == rank[np.minimum(b + shared, n)]
        shared += k * same
    return order, common


def find_runs(x: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run among the numbers ``x``, by start, then period."""
    floor = shortest_prefix(least, times)
    if len(x) < least or not _repeats(x, floor):
        return []
    order, common = _suffixes(x)
    joins = np.flatnonzero(common >= floor)
    joins = joins[np.argsort(-common[joins], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}

    def find(v: int) -> int:
        while (up := parent.setdefault(v, v)) != v:
            parent[v] = v = parent[up]
        return v

    seeds: list[tuple[int, int, int]] = []
    for a, b, shared in zip(order[joins - 1].tolist(), order[joins].tolist(), common[joins].tolist(), strict=True):
        u, v = find(a), find(b)
        large, small = members.pop(u, None) or Positions(u), members.pop(v, None) or Positions(v)
        if large.n < small.n:
            large, small, u, v = small, large, v, u
        parent[v] = u
        last, added = -1, list(small)
        for p, following in zip(added, [*added[1:], len(x)], strict=True):
            before, after = large.add(p)
            if before > last and p - before <= shared:  # else p's neighbour comes from its own class
                seeds.append((before, p - before + shared, p - before))
            if 0 <= after < following and after - p <= shared:
                seeds.append((p, after - p + shared, after - p))
            last = p
        members[u] = large
    return sorted(((s, n, q) for s, n, q in seeds if n >= least and n >= times * q and not (s and x[s - 1] == x[s - 1 + q])), key=lambda r: (r[0], r[2]))


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay if every run is left with its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    return b" ".join([words[i] for i in np.flatnonzero(_kept(len(words), runs)).tolist()])


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, exactly; of equal ones the first."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _analysed(text: str | None, least: int, times: int) -> tuple[list[bytes], list[tuple[int, int, int]]]:
    words = (text or "").encode().split()  # of bytes: only ASCII white space splits
    return words, find_runs(_numbers(words), least, times) if len(words) >= least else []


def measure(text: str | None, least: int = LEAST, times: int = TIMES) -> dict[str, int | str | None]:
    """The fields of ``measure_runs`` for one text."""
    words, runs = _analysed(text, least, times)
    start, length, period = _best(runs) or (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    exponent = None if period is None else 1000 * length // period
    digests = {"runs_sha256": hashlib.sha256(listed).hexdigest(), "collapsed_sha256": hashlib.sha256(_collapsed(words, runs)).hexdigest()}
    return {"n_words": len(words), "n_runs": len(runs), "start": start, "length": length, "period": period, "exponent_milli": exponent} | digests


def _each(df: DataFrame, text_col: str, kind: str, form: pa.DataType, of: Callable[[str | None], object]) -> Column:
    attach(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = pa.array([of(x.as_py()) for x in batch], form)
            del batch
            yield give_back(out)

    return F.arrow_udf(run, kind)(F.col(text_col))


def _check(least: int, times: int) -> None:
    if times < 2 or least < 2:
        raise ValueError("a run has two words and two periods at least")


def measure_runs(df: DataFrame, text_col: str = "text", into: str = "runs", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``df`` with a struct: number of runs, the one with the greatest exponent (else nulls), and digests of all runs and of the
    text with each run left with its first period."""
    _check(least, times)
    form = pa.struct([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _STRUCT.split(", ")])
    return df.withColumn(into, _each(df, text_col, f"struct<{_STRUCT.replace(' ', ':').replace(',:', ',')}>", form, lambda x: measure(x, least, times)))


def list_runs(df: DataFrame, text_col: str = "text", into: str = "runs", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``df`` with all runs as an array of (start, length, period), by start, then period."""
    _check(least, times)
    form = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    named = lambda x: [dict(zip(("start", "length", "period"), r, strict=True)) for r in _analysed(x, least, times)[1]]
    return df.withColumn(into, _each(df, text_col, "array<struct<start:long,length:long,period:long>>", form, named))


def collapse_runs(df: DataFrame, text_col: str = "text", into: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``df`` with the text's words joined by one space, every run left with its first period; a null text stays null."""
    _check(least, times)
    return df.withColumn(into, _each(df, text_col, "string", pa.string(), lambda x: None if x is None else _collapsed(*_analysed(x, least, times)).decode()))


def looped(text: Column, key: Column) -> Column:
    """The text's words with a loop in them, to try the search on: from word a = g % n on they repeat the p that follow, where g is
    the CRC-32 of the key over ten and p = 1 + (n - a) // (3 + g % 8). A text without words, or a null key, stays as it is."""
    g = F.floor(F.crc32(key.cast("string").cast("binary")) / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    loop = F.concat(F.slice(words, F.lit(1), a), F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)))
    return F.when((n > 0) & key.isNotNull(), F.array_join(F.slice(loop, F.lit(1), n), " ")).otherwise(text)
