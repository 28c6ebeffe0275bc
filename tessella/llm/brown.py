"""Brown class-based n-gram scoring.

Word counts of the training texts are a table as large as the corpus makes it. Units are the words seen ``min_count`` times
or more (at most ``n_words`` of them, the most frequent); rarer words are one of ``n_suffixes`` units by a hash of their last
three bytes. All units are clustered by exchange: each moves to the class that raises the class bigram likelihood most.

* The ``n_seed`` most frequent words are clustered first, one by one, on their own bigram table (of bounded size).
* Then every unit is moved by its own neighbours' classes: one pass over the texts counts, for each unit, the classes before
  and behind it; counts are summed in Spark by blocks of units and levels of tasks, and each block finds its units' best classes
  against the table of class pairs. Words without a class move first, then all units, half of them at a time, since moves
  made together can undo each other's gain; a turn that lowers the likelihood is taken back.

A text's score is the sum over its tokens of the class transition's and the word's log probability in its class, both
smoothed; perplexity follows. Workers get the units (bounded by ``n_words``); the counts of all other words meet their
tokens in an equality join, so nothing is cut off.

Defined cases: a null text is empty (one end token); with no training text every word is unknown and scores by smoothing
alone; of equally frequent words at the bound those with the smaller hash are units; rows that repeat, or have no id, are scored row by row (rows without an
id count as training rows only if ``train`` says so); other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, give_back, materialise

N_WORDS = 150_000
MIN_COUNT = 5
N_SUFFIXES = 1023
N_SEED = 767
N_CLASSES = 64
SWEEPS = 8
#: Turns of all units: even ones, then odd ones.
TURNS = 2
ALPHA = 0.1
_FLUSH = 200_000
#: Blocks of units, tokens whose neighbours are counted at once, and tables that are summed at once.
BLOCKS, TOKENS, FAN = 64, 1 << 20, 64


def tokens(text: str | None) -> list[bytes]:
    """Words (A-Z lowered, split at space and 0x09-0x0D); the end token is left out."""
    return (text or "").encode().lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of a one-column table of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for x in batch.column(0):
                counts.update(tokens(x.as_py()))
                if len(counts) > _FLUSH:
                    yield _counted(counts)
                    counts.clear()
        if counts:
            yield _counted(counts)

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _counted(counts: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])


def frequent(counts: DataFrame, most: int, least: int = 1) -> dict[bytes, int]:
    """Counts of the most frequent words seen ``least`` times or more, by falling count; about ``most`` at most.

    The count is read off a histogram of logarithms (a few hundred rows), so no task sorts or gathers the vocabulary. The
    level that passes ``most`` gives its share by hash."""
    step = F.floor(F.log2("c") * 16).cast("int")
    known = counts.where(F.col("c") >= least)
    sizes = {r.step: r.n for r in known.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()}
    total, lowest, part = 0, None, 0.0
    for k in sorted(sizes, reverse=True):
        lowest, part = k, min(1.0, (most - total) / sizes[k])
        if part < 1:
            break
        total += sizes[k]
    if lowest is None:
        return {}
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(part * (1 << 30))
    rows = known.where((step > lowest) | ((step == lowest) & drawn)).toArrow()
    found = zip(rows["word"].to_pylist(), rows["c"].to_pylist(), strict=True)
    return {bytes(w): n for w, n in sorted(found, key=lambda x: (-x[1], x[0]))}


def suffix_unit(word: bytes, n_words: int, n_suffixes: int) -> int:
    """Unit of a word that has none of its own; 0 is the end token, words follow, then suffixes."""
    return 1 + n_words + zlib.crc32(word[-3:]) % n_suffixes


class Units:
    """Units of words; remembers those of rarer words within bounds."""

    def __init__(self, own: dict[bytes, int], n_suffixes: int):
        self.own, self.n_words, self.n_suffixes, self.seen = own, len(own), n_suffixes, dict(own)

    def of(self, words: list[bytes]) -> list[int]:
        seen = self.seen
        new = [w for w in words if w not in seen]
        if new:
            if len(seen) + len(new) > len(self.own) + 500_000:
                self.seen = seen = dict(self.own)
                new = words
            for w in new:
                if w not in seen:
                    seen[w] = suffix_unit(w, self.n_words, self.n_suffixes)
        return list(map(seen.__getitem__, words))


def unit_texts(texts: DataFrame, own: dict[bytes, int], n_suffixes: int) -> DataFrame:
    """(units): runs of whole texts as 32-bit units, an end before the first and behind each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, line = Units(own, n_suffixes), [0]
        for batch in batches:
            for x in batch.column(0):
                line += units.of(tokens(x.as_py()))
                line.append(0)
                if len(line) > _FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array([np.array(line, np.uint32).tobytes()], pa.binary())], ["units"])
                    line = [0]
            del batch
            give_back(None)
        if len(line) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([np.array(line, np.uint32).tobytes()], pa.binary())], ["units"])

    return texts.mapInArrow(run, "units binary")


def pair_table(coded: DataFrame, kind: np.ndarray) -> np.ndarray:
    """Counts of neighbouring kinds (``kind`` of each unit: a class, or a small number of any sort)."""
    size = int(kind.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for x in batch.column(0):
                at = kind[np.frombuffer(x.as_buffer(), np.uint32)].astype(np.int64)
                total += np.bincount(at[:-1] * size + at[1:], minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["pair", "n"])

    rows = coded.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(size * size, np.int64)
    table[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return table.reshape(size, size)


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    return np.diff(keys, prepend=0).astype(np.uint32).tobytes() + counts.astype(np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64).tobytes()


def _unpacked(parts: list[bytes], n: list[int], size: int) -> np.ndarray:
    """The sum of packed counts, by key."""
    total = np.zeros(size, np.int64)
    for raw, k in zip(parts, n, strict=True):
        keys = np.cumsum(np.frombuffer(raw, np.uint32, k), dtype=np.int64)
        total[keys] += np.frombuffer(raw, np.uint32 if len(raw) == 8 * k else np.uint64, k, 4 * k).astype(np.int64)
    return total


def neighbours(coded: DataFrame, group: np.ndarray, moves: np.ndarray, k: int) -> DataFrame:
    """(block, part, n, data): of the units that may move, counts of the classes behind, the classes before, and themselves.

    A unit is in block unit % BLOCKS; its 2k + 1 counts follow each other in the block's table, which is sparse."""
    width, rows_of = 2 * k + 1, -(-len(group) // BLOCKS)
    size = rows_of * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, n_held = TaskContext.get().partitionId(), [], 0

        def flush() -> pa.RecordBatch:
            codes = []
            for u in held:
                place, cls = ((u % BLOCKS) * rows_of + u // BLOCKS) * width, group[u].astype(np.int64)
                left, right = moves[u[:-1]], moves[u[1:]]
                codes += [place[:-1][left] + cls[1:][left], place[1:][right] + k + cls[:-1][right], place[:-1][left & (u[:-1] == u[1:])] + 2 * k]
            keys, counts = np.unique(np.concatenate(codes), return_counts=True)
            edges = np.searchsorted(keys, np.arange(BLOCKS + 1) * size)
            spans = [(b, i, j) for b, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if j > i]
            columns = [pa.array([b for b, _, _ in spans], pa.int32()), pa.array([part] * len(spans), pa.int32()), pa.array([j - i for _, i, j in spans], pa.int32()), pa.array([_packed(keys[i:j] - b * size, counts[i:j]) for b, i, j in spans], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "part", "n", "data"])

        for batch in batches:
            for x in batch.column(0):
                held.append(np.frombuffer(x.as_buffer(), np.uint32).astype(np.int64))
                n_held += len(held[-1])
                if n_held > TOKENS:
                    yield flush()
                    held, n_held = [], 0
        if held:
            yield flush()

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = _unpacked(table["data"].to_pylist(), table["n"].to_pylist(), size)
        at = np.flatnonzero(total)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "n": pa.array([len(at)], pa.int32()), "data": pa.array([_packed(at, total[at])], pa.binary())})

    schema = "block int, part int, n int, data binary"
    rows = coded.mapInArrow(run, schema)
    parts = coded.select(F.spark_partition_id().alias("part")).agg(F.coalesce(F.max("part"), F.lit(0)) + 1).first()[0]
    while parts > FAN:  # no task sums more than FAN tasks' tables
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("block", "part").applyInArrow(add, schema)
        parts = -(-parts // FAN)
    return rows


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def gains(pairs: np.ndarray, r: np.ndarray, l_: np.ndarray, own: float) -> np.ndarray:
    """What the log likelihood gains by putting a unit into each class.

    ``pairs``: counts of class pairs without the unit; r and l_: its counts with the classes behind and before it, without
    its ``own`` pairs."""
    j, i = np.flatnonzero(r), np.flatnonzero(l_)
    x, y = pairs[:, j], pairs[i]
    gain = (_xlogx(x + r[j]) - _xlogx(x)).sum(axis=1) + (_xlogx(y + l_[i, None]) - _xlogx(y)).sum(axis=0)
    d = np.diag(pairs)
    gain += _xlogx(d + r + l_ + own) - _xlogx(d + r) - _xlogx(d + l_) + _xlogx(d)
    rows, columns = pairs.sum(axis=1) + l_, pairs.sum(axis=0) + r  # of the classes' other units, wherever this one goes
    return gain - (_xlogx(rows + r.sum() + own) - _xlogx(rows) + _xlogx(columns + l_.sum() + own) - _xlogx(columns))


def likelihood(pairs: np.ndarray) -> float:
    """The part of the class bigram log likelihood that classes decide."""
    p = pairs.astype(float)
    return float(_xlogx(p).sum() - _xlogx(p.sum(axis=1)).sum() - _xlogx(p.sum(axis=0)).sum())


def exchange(bigrams: np.ndarray, n_classes: int = N_CLASSES, sweeps: int = SWEEPS, apart: int = 1) -> np.ndarray:
    """Class of each unit. The first ``apart`` units keep a class each to themselves; the others start round-robin by frequency."""
    n = len(bigrams)
    n_classes = max(apart + 1, min(n_classes, n))
    order = [int(u) for u in np.argsort(-bigrams.sum(axis=1), kind="stable") if u >= apart]
    group = np.arange(n)
    for rank, u in enumerate(order):
        group[u] = apart + rank % (n_classes - apart)
    one_hot = np.zeros((n, n_classes))
    one_hot[np.arange(n), group] = 1
    b = bigrams.astype(float)
    pairs = one_hot.T @ b @ one_hot
    right = b @ one_hot  # counts of unit, class behind
    left = b.T @ one_hot  # counts of unit, class before
    out, into = b.sum(axis=1), b.sum(axis=0)
    for _ in range(sweeps):
        moved = 0
        for u in order:
            if not out[u] and not into[u]:
                continue
            old, own = int(group[u]), b[u, u]
            r, l_ = right[u].copy(), left[u].copy()
            r[old] -= own
            l_[old] -= own
            pairs[old] -= r
            pairs[:, old] -= l_
            pairs[old, old] -= own
            gain = gains(pairs, r, l_, own)
            gain[:apart] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            pairs[new] += r
            pairs[:, new] += l_
            pairs[new, new] += own
            if new != old:
                moved += 1
                group[u] = new
                right[:, old] -= b[:, u]
                right[:, new] += b[:, u]
                left[:, old] -= b[u]
                left[:, new] += b[u]
        if not moved:
            break
    return group


def best_classes(counts: np.ndarray, old: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The best class of each unit, from its row of 2k + 1 neighbour counts; all others stay where they are."""
    k, p, new = len(pairs), pairs.astype(float), old.copy()
    for u in np.flatnonzero(counts.any(axis=1)).tolist():
        o, own = int(old[u]), float(counts[u, 2 * k])
        r, l_ = counts[u, :k].astype(float), counts[u, k : 2 * k].astype(float)
        r[o] -= own
        l_[o] -= own
        p[o] -= r
        p[:, o] -= l_
        p[o, o] -= own
        gain = gains(p, r, l_, own)
        gain[0] = -np.inf
        to = int(np.argmax(gain))
        if gain[to] > gain[o] + 1e-9:
            new[u] = to
        p[o] += r
        p[:, o] += l_
        p[o, o] += own
    return new


def move(coded: DataFrame, group: np.ndarray, moves: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The classes after every unit that may move has gone to its best one, as the others stand."""
    k, rows_of = len(pairs), -(-len(group) // BLOCKS)

    def decide(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        counts = _unpacked(table["data"].to_pylist(), table["n"].to_pylist(), rows_of * (2 * k + 1)).reshape(rows_of, -1)
        units = np.arange(rows_of) * BLOCKS + block
        old = np.where(units < len(group), group[np.minimum(units, len(group) - 1)], 0)
        new = best_classes(counts, old, pairs)
        at = np.flatnonzero(new != old)
        return pa.table({"unit": pa.array(units[at], pa.int32()), "to": pa.array(new[at], pa.int32())})

    found = neighbours(coded, group, moves, k).groupBy("block").applyInArrow(decide, "unit int, to int").toArrow()
    out = group.copy()
    out[found["unit"].to_numpy()] = found["to"].to_numpy()
    return out


def cluster(coded: DataFrame, n_units: int, n_seed: int = N_SEED, n_classes: int = N_CLASSES, turns: int = TURNS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, counts of class pairs). Class 0 is the end's, class 1 that of units which no other class draws."""
    units = np.arange(n_units)
    seeds, n_classes = min(n_seed, n_units - 1), max(3, n_classes)
    kind = np.where(units == 0, 0, np.where(units <= seeds, units + 1, 1))
    seeded = exchange(pair_table(coded, np.append(kind, seeds + 1))[: seeds + 2, : seeds + 2], n_classes, apart=2)
    group = seeded[kind].astype(np.int32)
    pairs = pair_table(coded, np.append(group, n_classes - 1))
    for turn in range(turns + 1):
        moves = units > seeds if not turn else (units > 0) & (units % 2 == turn % 2)
        moved = move(coded, group, moves, pairs)
        after = pair_table(coded, np.append(moved, n_classes - 1))
        if turn and likelihood(after) < likelihood(pairs):
            break
        group, pairs = moved, after
    return group, pairs


class Model(NamedTuple):
    """Everything but the count table: its size is bounded by the parameters."""

    own: dict[bytes, int]  # unit of each word that has one
    counts: np.ndarray  # count of each of these words, by unit; at 0 that of the end
    group: np.ndarray  # class by unit
    transition: np.ndarray  # log10 probability of a class after a class
    below: np.ndarray  # log10 of the denominator of a word's probability, by class
    n: int
    v: int
    n_suffixes: int


def fit(texts: DataFrame, n_words: int = N_WORDS, n_suffixes: int = N_SUFFIXES, n_classes: int = N_CLASSES, n_seed: int = N_SEED, min_count: int = MIN_COUNT, turns: int = TURNS, alpha: float = ALPHA) -> tuple[Model, DataFrame]:
    """The model, and the table (word, c) of all training words, in shared storage."""
    attach(texts.sparkSession)
    counts = materialise(word_counts(texts), "word-counts")
    ends = texts.count()
    sums = counts.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    common = frequent(counts, n_words, min_count)
    own = {w: i + 1 for i, w in enumerate(common)}
    n_units = 1 + len(own) + n_suffixes
    group, pairs = cluster(materialise(unit_texts(texts, own, n_suffixes), "units"), n_units, n_seed, n_classes, turns)
    k = len(pairs)
    # A class after a class: Witten-Bell between its bigram and its own share.
    kinds = np.maximum((pairs > 0).sum(axis=1, keepdims=True), 1)
    share = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * k)
    transition = np.log10((pairs + kinds * share) / (pairs.sum(axis=1, keepdims=True) + kinds))
    # A word in its class: counts over all words, grouped by unit in Spark.
    by_class = _classes(counts, own, n_suffixes, group).groupBy("class").agg(F.count("*").alias("v"), F.sum("c").alias("n")).collect()
    v, n = np.zeros(k), np.zeros(k)
    for r in by_class:
        v[r["class"]], n[r["class"]] = r.v, r.n
    n[0] += ends
    v[0] += 1
    below = np.log10(n + alpha * (v + 1))
    # V and N of the base model count the end token.
    model = Model(own, np.array([ends, *common.values()], np.int64), group, transition, below, int(sums.n or 0) + ends, int(sums.v) + (ends > 0), n_suffixes)
    return model, counts


def _classes(counts: DataFrame, own: dict[bytes, int], n_suffixes: int, group: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(group[[own.get(w) or suffix_unit(w, len(own), n_suffixes) for w in batch.to_pylist()]], pa.int32())

    return counts.withColumn("class", F.arrow_udf(run, "int")(F.col("word")))


def score(df: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA) -> DataFrame:
    """(id_col, n_tokens, n_known, base_score, score, perplexity) of every row.

    A text becomes one head row and a row for each of its words that have no unit of their own; those meet their counts in an
    equality join. Head rows carry a key of their own that no word can have, so they are dealt evenly."""
    attach(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()
    n_own, ends_known = len(model.own), int(model.counts[0] > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 36
        units, logs = Units(model.own, model.n_suffixes), np.log10(model.counts + alpha)
        for batch in batches:
            ids, last = batch.column(0), batch.num_rows - 1
            uids, words, tfs, heads, whose = [], [], [], [], []
            for i, x in enumerate(batch.column(1)):
                split = tokens(x.as_py())
                at = np.array([0, *units.of(split), 0])
                rare = np.flatnonzero(at > n_own) - 1
                rest = Counter(map(split.__getitem__, rare.tolist()))
                total, path = float(logs[at[1:][at[1:] <= n_own]].sum()), model.group[at]
                classes = float((model.transition[path[:-1], path[1:]] - model.below[path[1:]]).sum())
                uid += 1
                uids += [uid] * (len(rest) + 1)
                words.append(b" %d" % uid)
                words += rest.keys()
                tfs.append(0)
                tfs += rest.values()
                heads.append({"n_tokens": len(split) + 1, "n_known": len(split) - len(rare) + ends_known, "logs": total, "classes": classes})
                heads += [None] * len(rest)
                whose.append(i)
                whose += [None] * len(rest)
                if len(uids) > _FLUSH or i == last:
                    yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(words, pa.binary()), pa.array(tfs, pa.int32()), ids.take(pa.array(whose, pa.int32())), pa.array(heads, _HEAD)], ["uid", "word", "tf", "id", "head"])
                    uids, words, tfs, heads, whose = [], [], [], [], []
            del batch
            give_back(None)

    rows = df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"uid long, word binary, tf int, id {id_type}, head {_HEAD_SQL}")
    met = rows.join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rare = F.col("tf") * F.log10(c + F.lit(alpha))
    sums = met.groupBy("uid").agg(F.max("id").alias("id"), F.max("head").alias("h"), F.sum(rare).alias("rare"), F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("found"))
    logs, n = F.col("h.logs") + F.col("rare"), F.col("h.n_tokens")
    base = logs - n * F.lit(math.log10(model.n + alpha * (model.v + 1)))
    total = logs + F.col("h.classes")
    return sums.select(F.col("id").alias(id_col), n.alias("n_tokens"), (F.col("h.n_known") + F.col("found")).alias("n_known"), base.alias("base_score"), total.alias("score"), F.pow(F.lit(10.0), -total / n).alias("perplexity"))


_HEAD = pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()), ("classes", pa.float64())])
_HEAD_SQL = "struct<n_tokens:long,n_known:long,logs:double,classes:double>"


def score_documents(df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Fit on the rows where ``train`` holds and score all rows; ``train_tokens`` is the number of training tokens."""
    texts = df.where(train).select(F.col(text_col))
    model, counts = fit(texts, **options)
    scored = score(df, model, counts, id_col, text_col, options.get("alpha", ALPHA))
    return scored.withColumn("train_tokens", F.lit(model.n).cast("long"))
