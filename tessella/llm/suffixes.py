"""Removal of passages that repeat across documents, by a Burrows-Wheeler transform of a collection built column by column.

A byte goes if a string of ``n`` bytes that covers it also starts in a document with a smaller id, whatever else goes. Every window
of n bytes is known by its anchor, the smallest hash among the shorter strings in it; equal windows have equal anchors. The work:

1. Each document's distinct anchors. An anchor of one text only can have no repeated window, so only anchors of two or more
   different texts go on: they are dealt by hash, sorted and told apart in one pass, after what a batch of documents shares is
   settled in the batch.
2. The windows with such anchors, in strings of consecutive windows with one anchor. Strings of a batch that are equal leave one,
   and the others' windows go; so a passage in every document sends a row a batch.
3. Strings are dealt by anchor. A task builds the transform of a bounded bucket of strings that share windows: each round inserts
   one symbol of every string, last symbols first, into the transform and the common prefixes, which are read and written front to
   back (Bauer, Cox and Rosone). Where neighbours have n bytes in common, all but the windows of the smallest id go.

An anchor of very many texts isn't dealt as such: each of its windows is dealt by its own hash, so no bucket holds all of them.
Equal texts are met first: the smallest id stands for all, the others lose everything (if they have n bytes).

Defined cases: a null text is empty; rows without an id take no part and keep everything; rows with equal ids aren't smaller than each
other; repeated rows get the same result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, give_back, join_counted, materialise, settle, slabs, utf8

N = 50
#: Windows in a string at most: a mask of them fits a long.
MOST = 32
#: An anchor of more texts than this has its windows dealt one by one.
HOT = 10_000
#: Bytes of text, or strings, whose equals are met before they are dealt; bytes of strings in a bucket.
BATCH_BYTES = 8 << 20
#: Bytes hashed in one go, so that numpy's passes stay in a core's cache.
SLAB = 1 << 16
BATCH_STRINGS = 200_000
BUCKET_BYTES = 2 << 20
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_TABLE = np.random.default_rng(20).integers(0, 2**64, 256, np.uint64)


def rolled(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of each window of k bytes: a polynomial by doubling (of overlapping halves in the last step), mixed once."""
    h, width = _TABLE[data], 1
    while width < k:
        step = min(width, k - width)
        if len(h) <= step:
            return h[:0]
        low, h = h[step:], h[:-step] * np.uint64(pow(_BASE, step, 2**64))
        h += low
        width += step
    h ^= h >> np.uint64(29)
    h *= np.uint64(_MIX)
    h ^= h >> np.uint64(32)
    return h


def _smallest(h: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w consecutive values, by doubling."""
    width = 1
    while width < w:
        step = min(width, w - width)
        h = np.minimum(h[:-step], h[step:]) if len(h) > step else h[:0]
        width += step
    return h


def anchored(data: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Strings of consecutive windows with one anchor, MOST at most: anchor, text, first byte in ``data`` and number of windows."""
    k = max(1, 2 * n // 5)
    anchor = _smallest(rolled(data, k), n - k + 1)
    if not len(anchor):
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    last = np.maximum(at[1:] - n + 1, at[:-1])  # one past a text's last window
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, at[:-1], 1)
    np.add.at(inside, last, -1)
    inside = np.cumsum(inside[: len(anchor)]) > 0
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    firsts = at[:-1][at[:-1] < len(anchor)]
    new[firsts] = True
    begin = np.flatnonzero(new & inside)
    text = np.searchsorted(at, begin, "right") - 1
    end = np.minimum(np.append(np.flatnonzero(new), len(anchor))[np.searchsorted(np.flatnonzero(new), begin) + 1], last[text])
    pieces = -(-(end - begin) // MOST)
    of = np.repeat(np.arange(len(begin)), pieces)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = begin[of] + MOST * nth
    return anchor[begin], text[of], begin, np.minimum(end[of] - begin, MOST)


def _anchors(n: int):
    """(anchor, dg, known): each batch's distinct anchors of texts; those of several texts of the batch are known to be shared, and
    one of them is also put forward to be met by other batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dg = batch.column("dg").to_numpy()
            hashes, texts, row = [], [], 0
            for slab in slabs(batch.column("text").cast(pa.large_string()), SLAB):
                anchor, text, _, _ = anchored(*utf8(slab), n)
                hashes.append(anchor)
                texts.append(text + row)
                row += len(slab)
            if not hashes:
                continue
            h, d = np.concatenate(hashes).view(np.int64), dg[np.concatenate(texts)]
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            h, d = h[fresh], d[fresh]
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            shared = ~first | ~np.append(first[1:], True)
            known = np.arange(shared.sum() + first.sum()) < shared.sum()
            out = [np.concatenate([x[shared], x[first]]) for x in (h, d)]
            order = np.argsort(out[1], kind="stable")  # by text, which the shuffle's compression uses
            del batch
            yield give_back(pa.RecordBatch.from_arrays([pa.array(x[order]) for x in (*out, known)], ["anchor", "dg", "known"]))

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, dg) of anchors of two or more texts, from rows sorted by both; a run may go over batches, of which one row is held."""
    held_h, held_d, several = np.empty(0, np.int64), np.empty(0, np.int64), False
    for batch in batches:
        h, d, known = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "dg", "known"))
        out_h, out_d = [h[known]], [d[known]]
        carried = several and len(held_h) == 1
        h, d = np.concatenate([held_h, h[~known]]), np.concatenate([held_d, d[~known]])
        if len(h):
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            run = np.cumsum(first) - 1
            fresh = np.ones(len(h), bool)
            fresh[1:] = first[1:] | (d[1:] != d[:-1])
            many = np.bincount(run, fresh) > 1
            many[0] |= carried
            take = fresh & many[run]
            if carried:
                take[0] = False  # it was given out with its own batch
            out_h.append(h[take])
            out_d.append(d[take])
            held_h, held_d, several = h[-1:], d[-1:], bool(many[-1])
        del batch
        yield give_back(pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_h)), pa.array(np.concatenate(out_d))], ["anchor", "dg"]))


_STRINGS = "bucket int, doc long, dg long, pos int, windows int, string binary"


def _strings(n: int, buckets: int):
    """Rows of _STRINGS for the anchors wanted of each text; a row without a string has windows that go."""
    names = [f.split()[0] for f in _STRINGS.split(", ")]
    deal = lambda x: xxhash.xxh32_intdigest(x) % buckets

    def met(rows: list[tuple]) -> pa.RecordBatch:
        least: dict[bytes, int] = {}
        for r in rows:
            if r[1] < least.setdefault(r[5], r[1]):
                least[r[5]] = r[1]
        columns = list(zip(*[r if r[1] == least[r[5]] else (*r[:5], None) for r in rows], strict=True)) or [[]] * 6
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            ids, dg = batch.column("doc").to_pylist(), batch.column("dg").to_pylist()
            row = 0
            for slab in slabs(batch.column("text").cast(pa.large_string()), SLAB):
                data, at = utf8(slab)
                anchor, text, begin, windows = anchored(data, at, n)
                raw, signed, starts = data.tobytes(), anchor.view(np.int64), np.searchsorted(text, np.arange(len(slab) + 1))
                own_bucket = (anchor % np.uint64(buckets)).astype(np.int64)
                for i in range(len(slab)):
                    a, b, base = starts[i], starts[i + 1], int(at[i])
                    cold, hot = (batch.column(c)[row + i].values.to_numpy() for c in ("cold", "hot"))
                    who = (ids[row + i], dg[row + i])
                    own = signed[a:b]
                    for j in (a + np.flatnonzero(np.isin(own, cold))).tolist():
                        s, w = int(begin[j]), int(windows[j])
                        rows.append((int(own_bucket[j]), *who, s - base, w, raw[s : s + w + n - 1]))
                    for j in (a + np.flatnonzero(np.isin(own, hot))).tolist() if len(hot) else ():
                        for s in range(int(begin[j]), int(begin[j] + windows[j])):
                            string = raw[s : s + n]
                            rows.append((deal(string), *who, s - base, 1, string))
                row += len(slab)
                held += len(data)
                if held >= BATCH_BYTES or len(rows) >= BATCH_STRINGS:
                    yield give_back(met(rows))
                    rows, held = [], 0
            del batch
        yield give_back(met(rows))

    return run


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of the strings in order: string, length, and the common prefix with the one before.

    A round inserts the suffixes that are one symbol longer than the last round's. A suffix that begins with c comes
    after those that begin with less and, among its like, as the suffixes behind their c are ordered; so the transform (the symbol
    before each suffix), read front to back, tells its place. Its common prefix with a neighbour is one more than the least
    between the two suffixes behind."""
    m, lens = len(strings), np.array([len(s) for s in strings], np.int64)
    text, begin = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1, np.cumsum(lens) - lens
    before = lambda s, t: np.where(lens[s] > t, text[np.maximum(begin[s] + lens[s] - t - 1, 0) if len(text) else 0], 0).astype(np.uint16)
    of, size, common = np.arange(m, dtype=np.int32), np.zeros(m, np.int32), np.zeros(m, np.uint8 if lens.max(initial=0) < 256 else np.int32)
    symbols, place = before(np.arange(m), 0), np.arange(m)
    for t in range(1, int(lens.max(initial=0)) + 1):
        live = np.flatnonzero(lens >= t)
        order = np.argsort(symbols, kind="stable")
        behind = order[np.count_nonzero(symbols == 0) :]  # of each suffix that isn't empty, the one without its first symbol
        where = np.empty(len(symbols), np.int64)
        where[behind] = np.arange(m, m + len(behind))
        new = where[place[live]]
        total = len(symbols) + len(live)
        old = np.ones(total, bool)
        old[new] = False
        grown = np.empty(total, common.dtype)
        grown[old] = common
        edge = np.zeros(total + 1, bool)
        edge[new] = edge[new + 1] = True
        k = np.flatnonzero(edge[:total])
        k = k[k > m]
        a, b = behind[k - 1 - m], behind[k - m]
        alike = symbols[a] == symbols[b]
        grown[m] = 0
        grown[k] = np.where(alike, 1, 0)
        grown[k[alike]] += _least(common, a[alike] + 1, b[alike])
        of, size, symbols = (_filled(old, new, x, y) for x, y in ((of, live), (size, t), (symbols, before(live, t))))
        common = grown
        place[live] = new
    return of, size, common


def _filled(old: np.ndarray, new: np.ndarray, kept: np.ndarray, put: np.ndarray | int) -> np.ndarray:
    out = np.empty(len(old), kept.dtype)
    out[old] = kept
    out[new] = put
    return out


def _least(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(x[a:b + 1]) for each pair, from minima over powers of two."""
    out, span = np.empty(len(a), x.dtype), b - a + 1
    level, width = x, 1
    while len(a) and width <= span.max():
        here = (span >= width) & (span < 2 * width)
        out[here] = np.minimum(level[a[here]], level[b[here] - width + 1])
        level, width = np.minimum(level[:-width], level[width:]) if len(level) > width else level[:0], 2 * width
    return out


def _repeated(strings: list[bytes], docs: np.ndarray, n: int) -> np.ndarray:
    """A mask for each string: the windows that a string of a smaller document also has."""
    masks = np.zeros(len(strings), np.int64)
    lens = np.array([len(s) for s in strings], np.int64)
    data, at = np.frombuffer(b"".join(strings), np.uint8), np.concatenate([[0], np.cumsum(lens)])
    h = rolled(data, n)
    of = np.repeat(np.arange(len(strings)), lens - n + 1)
    h = h[np.arange(len(of)) + of * (n - 1)]  # of windows inside a string
    order = np.argsort(h, kind="stable")
    h, of = h[order], of[order]
    same = (h[1:] == h[:-1]) & (of[1:] != of[:-1])
    share = np.unique(np.concatenate([of[1:][same], of[:-1][same]]))  # the others have no window that may be repeated
    if not len(share):
        return masks
    own, size, common = transform([strings[i] for i in share.tolist()])
    own = share[own]
    group = np.cumsum(common < n) - 1
    least = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, docs[own])
    goes = (size >= n) & (least[group] < docs[own])
    np.bitwise_or.at(masks, own[goes], np.int64(1) << (lens[own[goes]] - size[goes]))
    return masks


def _bucket(n: int):
    def run(table: pa.Table) -> pa.Table:
        doc, dg, pos, windows = (table[c].to_numpy() for c in ("doc", "dg", "pos", "windows"))
        mask = (np.int64(1) << windows.astype(np.int64)) - 1
        rows = np.flatnonzero(table["string"].is_valid().to_numpy())
        number: dict[bytes, int] = {}
        string = np.fromiter((number.setdefault(s, len(number)) for s in table["string"].drop_null().to_pylist()), np.int64, len(rows))
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, string, doc[rows])
        first = doc[rows] == least[string]
        mask[rows[first]] = _repeated(list(number), least, n)[string[first]]
        goes = mask != 0
        return give_back(pa.table({"doc": doc[goes], "dg": dg[goes], "pos": pos[goes], "mask": mask[goes]}))

    return run


def _runs(n: int):
    """Maximal runs of bytes that windows cover, from (pos, mask) of a document."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for x in batch:
                pos, mask = x.values.field("pos").to_numpy().astype(np.int64), x.values.field("mask").to_numpy()
                starts = np.unique(np.concatenate([pos[mask >> b & 1 == 1] + b for b in range(MOST)]))
                cut = np.flatnonzero(np.diff(starts) > n)
                begin, end = starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + n
                out.append([{"start": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
            yield pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return F.arrow_udf(run, "array<struct<start:long,end:long>>")


def find_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, hot: int = HOT) -> DataFrame:
    """(doc, dg, repeats): for documents that lose something, the maximal runs of bytes that go; ``dg`` is xxhash64 of the text."""
    if n < 2:
        raise ValueError("windows have two bytes at least")
    spark = df.sparkSession
    attach(spark)
    docs = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("dg", F.xxhash64("text"))
    digests = materialise(docs.select("doc", "dg", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("size")).where(F.col("size") >= n), "digests")
    firsts = materialise(digests.groupBy("sha").agg(F.min("doc").alias("first"), F.min("dg").alias("dg"), F.count("*").alias("rows")), "firsts")
    copies = join_counted(digests.select("doc", "dg", "sha", "size"), firsts.select("sha", "first", "rows"), "sha", "rows").where("doc > first").select("doc", "dg", "size").distinct()
    whole = copies.select("doc", "dg", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end"))).alias("repeats"))

    anchors = docs.select("dg", "text").mapInArrow(_anchors(n), "anchor long, dg long, known boolean")
    dealt = anchors.repartition(F.when(F.col("known"), F.xxhash64("anchor", "dg")).otherwise(F.col("anchor"))).sortWithinPartitions("anchor", "dg")
    shared = materialise(dealt.mapInArrow(_shared, "anchor long, dg long"), "anchors")
    del anchors, dealt
    settle(spark)
    often = shared.groupBy("anchor").agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select("anchor", F.lit(True).alias("often"))
    cold, warm = F.when(F.col("often").isNull(), F.col("anchor")), F.when(F.col("often"), F.col("anchor"))
    wanted = shared.join(often, "anchor", "left").groupBy("dg").agg(F.collect_set(cold).alias("cold"), F.collect_set(warm).alias("hot"))
    wanted = materialise(firsts.select(F.col("first").alias("doc"), "dg").join(wanted, "dg"), "wanted-anchors")  # its shuffles go before texts are dealt
    buckets = max(spark.sparkContext.defaultParallelism, shared.count() * (3 * n // 2) // BUCKET_BYTES)
    strings = docs.join(wanted, ["doc", "dg"]).select("doc", "dg", "text", "cold", "hot").mapInArrow(_strings(n, buckets), _STRINGS)
    found = strings.groupBy("bucket").applyInArrow(_bucket(n), "doc long, dg long, pos int, mask long")
    parts = found.groupBy("doc", "dg").agg(F.collect_list(F.struct("pos", "mask")).alias("parts")).select("doc", "dg", _runs(n)("parts").alias("repeats"))
    return parts.unionByName(whole)


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", into: str = "cut", n: int = N, hot: int = HOT) -> DataFrame:
    """``df`` with a struct: the bytes of the text, the runs of bytes that go (start, end), how many and how much that is, and the
    rest, whose characters may be cut in two, as bytes."""
    found = materialise(find_repeats(df, id_col, text_col, n, hot), "repeats")
    settle(df.sparkSession)
    found = found.select(F.col("doc").alias("_doc"), F.col("dg").alias("_dg"), F.col("repeats").alias("_repeats"))
    met = df.join(found, (F.col(id_col).cast("long") == F.col("_doc")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_dg")), "left")

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, repeats in batches:
            out = []
            for text, spans in zip(texts, repeats, strict=True):
                raw, spans = (text.as_py() or "").encode(), spans.as_py() or []
                edges = [0, *(v for s in spans for v in (s["start"], s["end"])), len(raw)]
                rest = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append({"n_bytes": len(raw), "n_removed": len(raw) - len(rest), "n_spans": len(spans), "spans": spans, "kept": rest})
            yield give_back(pa.array(out, form))

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    form = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())])
    kind = "n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary"
    return met.withColumn(into, F.arrow_udf(run, kind)(F.col(text_col), F.col("_repeats"))).drop("_doc", "_dg", "_repeats")


def cut_sql(n: int = N) -> str:
    """Bytes, removed bytes and runs, and the digest of the rest in DuckDB, over ``documents``; a row for each window."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS size FROM documents
), o AS (SELECT doc_id, least(400, size - {n - 1} - base) AS many, base, piece FROM (
       SELECT doc_id, size, unnest(range(0, size - {n - 1}, 400)) AS base, unnest([substr(h, 2 * j + 1, {2 * (399 + n)}) FOR j IN range(0, size - {n - 1}, 400)]) AS piece FROM d WHERE size >= {n}) q
), s AS (SELECT doc_id, base + unnest(range(many)) AS i, unnest([substr(piece, 2 * j + 1, {2 * n}) FOR j IN range(many)]) AS s FROM o
), f AS (SELECT s, min(doc_id) AS first FROM s GROUP BY s HAVING min(doc_id) < max(doc_id)
), m AS (SELECT doc_id, i FROM s JOIN f USING (s) WHERE first < doc_id
), g AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {n} THEN 0 ELSE 1 END AS begins FROM m
), r AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g
), p AS (SELECT doc_id, run, min(i) AS a, max(i) + {n} AS b FROM r GROUP BY ALL
), k AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM p GROUP BY doc_id
), e AS (SELECT d.doc_id, h, size, n_removed, n_spans, list_prepend(0, coalesce(b, [])) AS x, list_append(coalesce(a, []), size) AS y FROM d LEFT JOIN k ON k.doc_id = d.doc_id)
SELECT doc_id, size AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(array_to_string([substr(h, 2 * x[j] + 1, 2 * (y[j] - x[j])) FOR j IN range(1, len(x) + 1)], ''))) AS kept_sha256
FROM e"""
