"""Near copies by SimHash, checked exactly and made whole: every pair of a similarity (Jaccard) of 0.8 or more is linked.

A text is the set of its five-word shingles, as 64-bit hashes; equal sets are one set from the start. The work:

1. Each set's SimHash. Fingerprints at four or fewer differing bits are found by segments with one deleted bit (``simhash.links``);
   the whole sets of these pairs are compared, and those that are alike make the first classes.
2. Four bits of 64 hold most pairs that differ by little, but not those near the limit of 0.8. So all sets are put in one
   order, rare shingles first (by a table of counts; any order is right, a rare one is quick). Of two sets that share enough, the
   first shared shingle lies in a short prefix of each, and the prefixes have a certain number in common; an equality join
   finds these pairs, and those that step 1 left in different classes are compared whole.
3. A crowded prefix shingle doesn't list its pairs. It links its sets to one of them in step 1; only if several classes are left after
   step 2, blocks of its sets are met in pairs, and each pair of blocks reports a spanning forest of its links between classes.

So no link is missed but by a collision of 64-bit hashes, and none is made without the exact check.

Defined cases: a null text counts as empty, and empty texts are equal; a text of fewer than five words is one shingle; only
A-Z is lowered and only ASCII space splits; the class id is the smallest non-null id; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, give_back, join_counted, materialise, with_ids
from .simhash import MAX_BITS, classes
from .simhash import links as near_prints

SHINGLE_WORDS = 5
#: A prefix shingle of more different sets than this doesn't list its pairs,
CROWD = 64
#: but meets blocks of this many sets.
BLOCK = 512
#: Cells of the table of counts, in chunks, and bits of the table of wanted sets.
CELLS, CHUNK, WANTED = 1 << 20, 1 << 12, 1 << 24
_ROWS = 1 << 17
#: Shingles whose bits are counted in one go.
_PRINTED = 1 << 15


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes."""
    split = (text or "").encode().lower().split()  # of bytes: only A-Z is lowered, only ASCII space splits
    if not split:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, split), np.uint64, len(split))
    n = max(1, len(split) - words + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(words, len(split))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
    out = (out ^ (out >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return np.unique(out ^ (out >> np.uint64(33)))


def _key(found: np.ndarray) -> int:
    """The set's own number, signed."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes())).astype(np.int64))


#: The key of the set without shingles.
EMPTY = _key(np.empty(0, np.uint64))


def fingerprint(found: np.ndarray) -> int:
    """The set's SimHash, as a signed 64-bit number: the bits that more than half of its shingles have."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(found), _PRINTED):
        ones += np.unpackbits(found[i : i + _PRINTED].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(found)).tobytes(), "big", signed=True)


def _alike(na, nb, shared):
    """Whether sets of these sizes that share so many have a similarity of 0.8: in whole numbers, 9 s >= 4 (a + b)."""
    return 9 * shared >= 4 * (na + nb)


def _prints(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """A row (id_col, key, fp) for each text, and rows (chunk, counts) of each task's shingle counts."""

    names = ["id", "key", "fp", "chunk", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        kind = None
        for batch in batches:
            kind, keys, fps = batch.column(0).type, [], []
            for x in batch.column(1):
                found = shingles(x.as_py(), words)
                np.add.at(counts, (found & np.uint64(CELLS - 1)).astype(np.int64), 1)
                keys.append(_key(found))
                fps.append(fingerprint(found))
            none = pa.nulls(len(keys), pa.int32()), pa.nulls(len(keys), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(fps, pa.int64()), *none], names)
            del batch
            give_back(None)
        if kind is not None:
            parts = [zlib.compress(x.tobytes(), 1) for x in counts.reshape(-1, CHUNK)]
            none = pa.nulls(len(parts), kind), pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays([*none, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names)

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("key", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("chunk", T.IntegerType()), T.StructField("counts", T.BinaryType())])
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _commonness(prints: DataFrame) -> np.ndarray:
    """For each cell how common its shingles are, on a logarithmic scale of small numbers."""

    def total(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = np.zeros(CHUNK, np.int64)
        for x in table["counts"]:
            out += np.frombuffer(zlib.decompress(x.as_py()), np.int64)
        scale = np.minimum(np.round(4 * np.log2(1 + out)), 255).astype(np.uint8)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "scale": pa.array([scale.tobytes()], pa.binary())})

    rows = prints.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInArrow(total, "chunk int, scale binary").collect()
    out = np.zeros(CELLS, np.uint8)
    for r in rows:
        out[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(r.scale, np.uint8)
    return out


def _prefixes(df: DataFrame, text_col: str, words: int, common: np.ndarray) -> DataFrame:
    """(tok, key, n, pos): the shingles of each set in whose first places any set that is alike has one too."""
    shared = df.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, out, rows = set(), [], 0

        def flush() -> pa.RecordBatch:
            tok, key, n, pos = (np.concatenate([x[i] for x in out]) for i in range(4))
            return pa.RecordBatch.from_arrays([pa.array(tok.view(np.int64)), pa.array(key), pa.array(n), pa.array(pos)], ["tok", "key", "n", "pos"])

        for batch in batches:
            for x in batch.column(0):
                found = shingles(x.as_py(), words)
                key, n = _key(found), len(found)
                if not n or key in seen:
                    continue
                seen.add(key)
                scale = shared.value[(found & np.uint64(CELLS - 1)).astype(np.int64)]
                p = n - -(-4 * n // 5) + 1
                first = found[np.argsort(scale, kind="stable")[:p]]
                out.append((first, np.full(p, key, np.int64), np.full(p, n, np.int32), np.arange(p, dtype=np.int32)))
                rows += p
                if rows > _ROWS:
                    yield flush()
                    out, rows = [], 0
            del batch
            give_back(None)
        if out:
            yield flush()

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "tok long, key long, n int, pos int")


def _sets(df: DataFrame, text_col: str, words: int, wanted: DataFrame) -> DataFrame:
    """(key, hashes) for the wanted keys; a bit table spares the others before anything is shuffled."""
    bits = np.zeros(WANTED, bool)
    at = wanted.select(F.col("key").bitwiseAND(F.lit(WANTED - 1)).alias("at")).distinct().toArrow()["at"].to_numpy()
    bits[at] = True
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            keys, sets, size = [], [], 0
            for x in batch.column(0):
                found = shingles(x.as_py(), words)
                key = _key(found)
                at = key & (WANTED - 1)
                if key not in seen and shared.value[at >> 3] >> (7 - (at & 7)) & 1:
                    seen.add(key)
                    keys.append(key)
                    sets.append(found.tobytes())
                    size += len(found)
                    if size > _ROWS * 8:
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "hashes"])
                        keys, sets, size = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "hashes"])
            del batch
            give_back(None)

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "key long, hashes binary").join(wanted, "key", "left_semi").dropDuplicates(["key"])


def fingerprint_pairs(each: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """(a, b): pairs of the sets of ``each`` (key, fp) whose fingerprints differ by ``most`` bits or fewer, enough to join them.

    Sets with one fingerprint are paired with the first of them, which also stands for them in the pairs of near fingerprints."""
    named = materialise(each.where(F.col("key") != EMPTY).groupBy("fp").agg(F.min("key").alias("own"), F.count("*").alias("n")), "fingerprints")
    within = join_counted(each.where(F.col("key") != EMPTY).select("fp", "key"), named, "fp", "n").where("own < key").select(F.col("own").alias("a"), F.col("key").alias("b"))
    near = near_prints(named.select("fp"), most)
    own = lambda c: named.select(F.col("fp").alias(c), F.col("own").alias(f"own_{c}"))
    between = near.join(own("a"), "a").join(own("b"), "b").select(F.least("own_a", "own_b").alias("a"), F.greatest("own_a", "own_b").alias("b"))
    return within.unionByName(between)


def prefix_pairs(few: DataFrame, crowded: DataFrame | None = None) -> DataFrame:
    """(a, b): the pairs of sets of ``few`` (tok, key, n, pos) that can be alike by their sizes and by what their prefixes share.

    Up to where the first of two prefixes ends, all that the sets share is in both; so the pair shares at most that and what the
    longer rest holds. Of the shingles in ``crowded``, which list no pairs, all may be shared."""
    n, m, p, q = F.col("x.n"), F.col("y.n"), F.col("x.pos"), F.col("y.pos")
    met = few.alias("x").join(few.alias("y"), (F.col("x.tok") == F.col("y.tok")) & (F.col("x.key") < F.col("y.key")) & _alike(n, m, F.least(n, m)))
    met = met.select(F.col("x.key").alias("a"), F.col("y.key").alias("b"), n.alias("n"), m.alias("m"), _alike(n, m, F.least(n - p, m - q)).alias("first"))
    met = met.groupBy("a", "b", "n", "m").agg(F.count("*").alias("shared"), F.max("first").alias("first")).where("first")
    if crowded is not None:
        more = crowded.groupBy("key").agg(F.count("*").alias("more"))
        for c in ("a", "b"):
            met = met.join(more.select(F.col("key").alias(c), F.col("more").alias(f"more_{c}")), c, "left")
        met = met.withColumn("shared", F.col("shared") + F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0))))
    rest = F.ceil(F.greatest("n", "m") * 4 / 5) - 1  # of a set of n shingles, these are behind its prefix
    return met.where(_alike(F.col("n"), F.col("m"), F.col("shared") + rest)).select("a", "b")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends aren't in one class."""
    for c in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("key").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""

    def same(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            out.append(bool(_alike(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)))))
        return pa.array(out, pa.bool_())

    both = pairs.join(sets.select(F.col("key").alias("b"), F.col("hashes").alias("hb")), "b").join(sets.select(F.col("key").alias("a"), F.col("hashes").alias("ha")), "a")
    return both.where(F.arrow_udf(same, "boolean")("ha", "hb")).select("a", "b")


def _meet(keys: np.ndarray, roots: np.ndarray, pos: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of a spanning forest between the classes of sets of two sides (or of one, where all are on side 0)."""
    sizes = np.array([len(x) for x in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    words, ids = np.unique(np.concatenate(sets), return_inverse=True)
    mark, parent, kept = np.zeros(len(words), np.int64), {}, []

    def find(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v

    two = bool(side.any())
    now = np.array([find(int(r)) for r in roots])
    # Sets of small classes look at all others; of the largest class, none has to look.
    names, counts = np.unique(now, return_counts=True)
    for i in np.nonzero(now != names[counts.argmax()])[0].tolist():
        far = now != now[i]
        far &= (side != side[i]) if two else True
        fits = _alike(sizes, sizes[i], np.minimum(sizes, sizes[i])) & _alike(sizes, sizes[i], np.minimum(sizes - pos, sizes[i] - pos[i]))
        if not (far & fits).any():
            continue
        mine = ids[starts[i] : starts[i] + sizes[i]]
        mark[mine] = 1
        near = far & fits & _alike(sizes, sizes[i], np.add.reduceat(mark[ids], starts))
        mark[mine] = 0
        for j in np.nonzero(near)[0].tolist():
            p, q = find(int(now[i])), find(int(now[j]))
            if p != q:
                parent[p] = q
                kept.append((int(keys[i]), int(keys[j])))
        if near.any():
            now = np.array([find(int(r)) for r in now])
    return kept


def _between(crowded: DataFrame, roots: DataFrame, sets: DataFrame, block: int) -> DataFrame | None:
    """Links (a, b) between classes within crowded shingles, enough to tell the classes; None if there is nothing to meet."""
    placed = crowded.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    several = placed.groupBy("tok").agg(F.count("*").alias("c"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    several = materialise(several.select("tok", "c"), "several-classes")
    if not several.limit(1).count():
        return None

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        at, i, j = table["block"].to_numpy(), key[1].as_py(), key[2].as_py()
        side = (at == j).astype(np.int8) if i != j else np.zeros(len(at), np.int8)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["hashes"].combine_chunks()]
        found = _meet(table["key"].to_numpy(), table["root"].to_numpy(), table["pos"].to_numpy().astype(np.int64), side, sets)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    dealt = placed.join(several, "tok").withColumn("blocks", F.ceil(F.col("c") / block)).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    met = dealt.select("tok", "key", "root", "pos", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"))
    met = met.select("tok", "key", "root", "pos", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    mixed = met.groupBy("tok", "i", "j").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("tok", "i", "j")
    return met.join(mixed, ["tok", "i", "j"], "left_semi").join(sets, "key").groupBy("tok", "i", "j").applyInArrow(meet, "a long, b long")


def _roots(links: DataFrame) -> DataFrame:
    """(key, root) for the linked sets."""
    ends = links.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    return classes(links, ends.withColumn("id", F.col("fp"))).select(F.col("fp").alias("key"), F.col("component_id").alias("root"))


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """(id, key, root, component_id) for every row: its set, the set that names its class, and the class's smallest id."""
    attach(df.sparkSession)
    prints = materialise(_prints(df, id_col, text_col, words), "prints")
    texts = prints.where("chunk is null")
    each = materialise(texts.groupBy("key").agg(F.min("id").alias("id"), F.min("fp").alias("fp"), F.count("*").alias("n")), "distinct")
    first = materialise(fingerprint_pairs(each), "fingerprint-pairs")
    every = Window.partitionBy("tok")
    index = _prefixes(df, text_col, words, _commonness(prints))
    index = index.withColumn("low", F.min("key").over(every)).withColumn("high", F.max("key").over(every)).where("low < high")
    index = materialise(index.select("tok", "key", "n", "pos").dropDuplicates(["tok", "key"]), "prefixes")
    large = materialise(index.groupBy("tok").agg(F.count("*").alias("c")).where(F.col("c") > crowd).select("tok"), "crowded")
    crowded = index.join(large, "tok", "left_semi")
    some = bool(large.limit(1).count())
    pairs = materialise(prefix_pairs(index.join(large, "tok", "left_anti"), crowded if some else None), "candidates")
    if some:
        sized = crowded.withColumn("size", F.floor(F.log("n") / F.log(F.lit(1.25))))
        heads = sized.groupBy("tok", "size").agg(F.min("key").alias("a"), F.min_by("n", "key").alias("m"))
        star = sized.join(heads, ["tok", "size"]).where(F.col("a") < F.col("key")).where(_alike(F.col("n"), F.col("m"), F.least("n", "m")))
        first = first.unionByName(star.select("a", F.col("key").alias("b")))
    first = materialise(first.distinct(), "first-pairs")
    wanted = first.unionByName(pairs).select(F.explode(F.array("a", "b")).alias("key"))
    wanted = materialise((wanted.unionByName(crowded.select("key")) if some else wanted).distinct(), "wanted")
    sets = materialise(_sets(df, text_col, words, wanted), "sets")
    links = materialise(_verified(first, sets), "alike")
    rest = materialise(_verified(_apart(pairs, _roots(links)), sets), "alike-too")
    links = links.unionByName(rest)
    roots = materialise(_roots(links), "classes")
    more = _between(crowded, roots, sets, block) if some else None
    if more is not None:
        roots = materialise(_roots(materialise(links.unionByName(more).distinct(), "all-alike")), "classes")
    placed = materialise(each.select("key", "id", "n").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "placed")
    named = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    known = materialise(placed.select("key", "root", "n").join(named, "root"), "named")
    return join_counted(texts.select("id", "key"), known, "key", "n")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` whose id is the smallest of its class; of rows with that same id, one.

    Rows without an id stay only if their whole class has none, and then one of them does."""
    found = materialise(near_copies(df, id_col, text_col, **options), "near-copies")
    kept = with_ids(df, id_col, found.where("id = component_id").select("id"))
    lone = found.where("component_id is null and key = root").select(F.col("key").alias("set")).distinct()
    if not lone.limit(1).count():
        return kept
    words = options.get("words", SHINGLE_WORDS)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([_key(shingles(x.as_py(), words)) for x in texts], pa.int64())

    nameless = df.where(F.col(id_col).isNull()).select(F.struct(*df.columns).alias("row"), F.arrow_udf(run, "long")(F.col(text_col)).alias("set"))
    return kept.unionByName(nameless.join(lone, "set", "left_semi").dropDuplicates(["set"]).select("row.*"))
