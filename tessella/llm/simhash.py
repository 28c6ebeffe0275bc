"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into three segments: of at most four (or five) differing bits, one segment gets at most one.
Each segment is indexed under every variant with one bit deleted; equal or one-bit-apart segments share a variant, so the
rows of one variant, brought together by one shuffle, hold all candidates, and the full fingerprints verify them there. A pair is
taken only from its first segment and variant that can show it, so no link comes twice.

Only distinct fingerprints are indexed. Of a bucket that is crowded, that shuffle gets a few rows and a count; it is dealt out in
blocks, and each pair of blocks reports a spanning forest of its links instead of all of them; that leaves the classes the same. Classes come from
contracting the graph of links, in rounds that grow with the logarithm of a chain's length; every step is a join or a
grouping, cut off by a written table. The rows meet their class by fingerprint, the most frequent fingerprints by broadcast.

Defined cases: a null text counts as empty and has fingerprint zero, which links like any other; repeated rows and texts
share a fingerprint; the class id is the smallest non-null id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, give_back, join_counted, materialise, with_ids

SHINGLE_WORDS = 4
MAX_BITS = 4
#: (lowest bit, width) of the three segments.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: A bucket with more distinct fingerprints than this doesn't list its links but a spanning forest of them,
CROWD = 64
#: taken between blocks of this many fingerprints.
BLOCK = 1024
#: Fingerprints that a task takes variants from, and those it takes them from in one go.
DEAL_ROWS, LOT = 500_000, 1 << 15
_SEED = 42
_COUNT_BLOCK = 1 << 15


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Bit majority over XXH64 of the word shingles, as a signed 64-bit number."""
    split = (text or "").encode().lower().split()  # of bytes: only A-Z is lowered, only ASCII space splits
    if not split:
        return 0
    line = b" ".join(split)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1) - 1
    n = max(1, len(split) - words + 1)
    begins = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(words, len(split)) - 1 :].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, n, _COUNT_BLOCK):
        hashes = b"".join([digest(line[a:b], _SEED) for a, b in zip(begins[i : i + _COUNT_BLOCK], stops[i : i + _COUNT_BLOCK], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id_col, fp) with the fingerprint as a long."""
    attach(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = pa.array([fingerprint(x.as_py(), words) for x in batch], pa.int64())
            del batch
            yield give_back(out)

    return df.select(F.col(id_col), F.arrow_udf(run, "long")(F.col(text_col)).alias("fp"))


def variants(fps: DataFrame, enough: int | None = None) -> DataFrame:
    """(key, fp, more): a row for each segment and deleted bit; the key names segment, bit and what is left of the segment.

    With ``enough``, a lot of fingerprints gives so many rows of a key at most, the last of which counts those left out in ``more``."""

    def lot(fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        for s, (low, width) in enumerate(SEGMENTS):
            part = fp.view(np.uint64) >> np.uint64(low) & np.uint64((1 << width) - 1)
            part = part.astype(np.int64)
            for i in range(width):
                key, more = part >> i + 1 << i | part & (1 << i) - 1 | s << 40 | i << 32, np.zeros(len(fp), np.int64)
                order = np.argsort(key, kind="stable")
                key = key[order]
                if enough is not None:
                    begins = np.flatnonzero(np.diff(key, prepend=-1))
                    sizes = np.diff(begins, append=len(key))
                    much = sizes > enough
                    more[begins[much] + enough - 1] = sizes[much] - enough
                    kept = np.arange(len(key)) - np.repeat(begins, sizes) < enough
                    key, order, more = key[kept], order[kept], more[kept]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[order]), pa.array(more)], ["key", "fp", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            n += len(batch)
            if n >= LOT:
                yield from lot(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from lot(np.concatenate(held))

    return fps.select("fp").mapInArrow(run, "key long, fp long, more long")


def _first_shown(x: np.ndarray) -> np.ndarray:
    """Segment and bit (as in the key's upper half) that a pair which differs by x is taken from; -1 if none shows it."""
    out = np.full(x.shape, -1, np.int64)
    for s, (low, width) in reversed(list(enumerate(SEGMENTS))):
        part = x >> np.uint64(low) & np.uint64((1 << width) - 1)
        # With one differing bit at position i, part is 2**i; its position is the number of ones below it.
        bit = np.where(part == 0, 0, np.bitwise_count(part - np.uint64(1)).astype(np.int64))
        out = np.where(np.bitwise_count(part) <= 1, s << 8 | bit, out)
    return out


def _bucket_links(index: DataFrame, most: int, crowd: int) -> DataFrame:
    """(a, b, key, n): the own links (a, b) of buckets of up to ``crowd``; key and number of rows of larger ones.

    A task goes through its rows in the order of keys and holds no more than ``crowd`` + 1 of a bucket that goes on in the next batch."""

    def met(key: np.ndarray, fp: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        sizes = np.diff(begins, append=len(key))
        n = np.add.reduceat(1 + more, begins) if len(key) else sizes
        large, few = n > crowd, np.repeat(n <= crowd, sizes)
        names, counts = key[begins[large]], n[large]
        key, fp = key[few], fp[few]
        a, b, at, apart = [], [], np.arange(len(key)), 0
        while len(at):
            apart += 1
            at = at[at < len(key) - apart]
            at = at[key[at] == key[at + apart]]
            x = (fp[at] ^ fp[at + apart]).view(np.uint64)
            own = np.bitwise_count(x) <= most
            own[own] = _first_shown(x[own]) == key[at[own]] >> 32
            left, right = fp[at[own]], fp[at[own] + apart]
            a.append(np.minimum(left, right))
            b.append(np.maximum(left, right))
        links = [np.concatenate([np.empty(0, np.int64), *v]) for v in (a, b)]
        no_link, no_key = pa.nulls(len(names), pa.int64()), pa.nulls(len(links[0]), pa.int64())
        columns = [(links[0], no_link), (links[1], no_link), (no_key, names), (no_key, counts)]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(v, pa.int64()) for v in c]) for c in columns], ["a", "b", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([v, batch.column(i).to_numpy()]) for i, v in enumerate(held)]
            begins = np.flatnonzero(np.diff(held[0]))
            end = begins[-1] + 1 if len(begins) else 0
            yield met(*(v[:end] for v in held))
            held = [v[end:] for v in held]
            if len(held[0]) > crowd + 1:
                left_out = int((1 + held[2][crowd + 1 :]).sum())
                held = [v[: crowd + 1].copy() for v in held]
                held[2][-1] += left_out
        yield met(*held)

    return index.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long, key long, n long")


def _forest(fps: np.ndarray, other: np.ndarray | None, key: int, most: int) -> np.ndarray:
    """Links of a spanning forest of a bucket's own links among fps (with other: between both), as rows of two.

    Own links of a key with a higher bit join fingerprints that have the bit to ones that don't, so only those are met."""
    low, bit = SEGMENTS[key >> 40][0], key >> 32 & 0xFF
    has = lambda v: (v.view(np.uint64) >> np.uint64(low + bit)) & np.uint64(1) == 1
    if bit and other is None:
        meetings = [(fps[has(fps)], fps[~has(fps)])]
    elif bit:
        meetings = [(fps[has(fps)], other[~has(other)]), (fps[~has(fps)], other[has(other)])]
    else:
        meetings = [(fps, fps if other is None else other)]
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = v = root[root[v]]
        return v

    kept, enough = [], len(fps) - 1 + (0 if other is None else len(other))
    for left, right in meetings:
        # Unsigned, as numpy counts the bits of a negative number's absolute value.
        x = left.view(np.uint64)[:, None] ^ right.view(np.uint64)[None, :]
        near = np.bitwise_count(x) <= most
        a, b = np.nonzero(np.triu(near, 1) if left is right else near)
        own = _first_shown(x[a, b]) == key >> 32
        a, b = a[own], b[own]
        for v, w in zip(left[a].tolist(), right[b].tolist(), strict=True):
            p, q = find(v), find(w)
            if p != q:
                root[p] = q
                kept.append((v, w))
                if len(kept) == enough:
                    break
    return np.array(kept, np.int64).reshape(-1, 2)


def _dealt(fps: DataFrame) -> DataFrame:
    """The fingerprints over all cores, by hash: a small table would be read in few tasks, and each row becomes 64 variants."""
    return fps.repartition(max(fps.sparkSession.sparkContext.defaultParallelism, fps.count() // DEAL_ROWS), "fp")


def links(fps: DataFrame, most: int = MAX_BITS, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """(a, b): links between different fingerprints at ``most`` or fewer differing bits, enough to tell the classes.

    ``fps`` has distinct values in ``fp``. Buckets of up to ``crowd`` give every link of theirs; of larger ones, each pair
    of blocks gives a spanning forest."""
    if not 0 <= most <= 5:
        raise ValueError("three segments with one deleted bit find up to five differing bits")
    attach(fps.sparkSession)
    fps = _dealt(fps)
    met = materialise(_bucket_links(variants(fps, crowd + 1), most, crowd), "buckets")
    found, large = met.where("key is null").select("a", "b"), met.where("key is not null").select("key", "n")
    if not large.limit(1).count():
        return found

    def forest(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        fp, side = np.ascontiguousarray(table["fp"].to_numpy()), table["block"].to_numpy()
        i, j = key[1].as_py(), key[2].as_py()
        found = _forest(fp, None, key[0].as_py(), most) if i == j else _forest(fp[side == i], fp[side == j], key[0].as_py(), most)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    dealt = variants(fps).join(large, "key").withColumn("blocks", F.ceil(F.col("n") / block)).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    met = dealt.select("key", "fp", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"))
    met = met.select("key", "fp", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    return found.unionByName(met.groupBy("key", "i", "j").applyInArrow(forest, "a long, b long"))


def classes(pairs: DataFrame, start: DataFrame) -> DataFrame:
    """(fp, component_id) for the fingerprints in ``pairs``: the smallest ``id`` of ``start`` (fp, id) among those reachable.

    Each round every vertex joins the smallest of its neighbours and itself in an order that a hash draws anew, twice over
    (its choice's choice), and the graph shrinks to what was chosen. At least half of the vertices are expected to go in a
    round, whatever the shape, so rounds grow with the logarithm of the longest chain; each works on what the last one left."""
    edges = materialise(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    chosen: list[DataFrame] = []
    while edges.limit(1).count():
        turn = F.lit(len(chosen))
        # The hash of one number is one to one, so names stay apart within a round; the round is part of a name afterwards.
        near = edges.groupBy("a").agg(F.min(F.xxhash64("b", turn)).alias("near")).select(F.col("a").alias("v"), F.xxhash64("a", turn).alias("own"), "near")
        near = materialise(near.select("v", "own", F.least("own", "near").alias("near")), "choices")
        beyond = near.select(F.col("own").alias("near"), F.col("near").alias("to"))
        step = materialise(near.join(beyond, "near").select("v", "to"), "steps")
        chosen.append(step)
        left, right = step.select(F.col("v").alias("a"), F.col("to").alias("to_a")), step.select(F.col("v").alias("b"), F.col("to").alias("to_b"))
        moved = edges.join(left, "a").join(right, "b").where("to_a <> to_b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        edges = materialise(moved.distinct(), "links")
    if not chosen:
        return start.select("fp", F.col("id").alias("component_id")).limit(0)
    label = None
    for turn in range(len(chosen) - 1, -1, -1):
        step = chosen[turn].select(F.col("v"), F.col("to"), F.lit(turn).alias("turn"))
        if label is not None:
            later = label.select(F.col("v").alias("to"), F.col("root").alias("later"), F.col("turn").alias("later_turn"))
            step = step.join(later, "to", "left").select("v", F.coalesce("later", "to").alias("root"), F.coalesce("later_turn", "turn").alias("turn"))
        else:
            step = step.withColumnRenamed("to", "root")
        label = materialise(step, "labels")
    named = label.withColumnRenamed("v", "fp").join(start, "fp")
    smallest = named.groupBy("root", "turn").agg(F.min("id").alias("component_id"))
    return label.withColumnRenamed("v", "fp").join(smallest, ["root", "turn"]).select("fp", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, most: int = MAX_BITS, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """(id_col, fingerprint as 16 hexadecimal digits, component_id) for every row."""
    prints = materialise(fingerprints(df, id_col, text_col, words).toDF("id", "fp"), "fingerprints")
    each = materialise(prints.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("n")), "distinct")
    linked = classes(links(each.select("fp"), most, crowd, block), each.select("fp", "id"))
    known = materialise(each.join(linked, "fp", "left").select("fp", "n", F.coalesce("component_id", "id").alias("component_id")), "named")
    return join_counted(prints, known, "fp", "n").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` whose id is the smallest of its class; of rows with that same id, one.

    Rows without an id stay only if their whole class has none, and then one of them does."""
    found = materialise(near_duplicates(df, id_col, text_col, **options), "near-duplicates").withColumnRenamed(id_col, "_id")
    kept = with_ids(df, id_col, found.where("_id = component_id").select("_id"))
    lone = found.where(F.col("component_id").isNull()).select(F.col("fingerprint").alias("print")).distinct()
    if not lone.limit(1).count():
        return kept
    attach(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([f"{fingerprint(x.as_py(), options.get('words', SHINGLE_WORDS)) & (1 << 64) - 1:016x}" for x in batch], pa.string())

    nameless = df.where(F.col(id_col).isNull()).select(F.struct(*df.columns).alias("row"), F.arrow_udf(run, "string")(F.col(text_col)).alias("print"))
    return kept.unionByName(nameless.join(lone, "print", "left_semi").dropDuplicates(["print"]).select("row.*"))
