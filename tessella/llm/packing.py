"""Best-fit packing with certified bounds.

Texts become token counts; texts longer than a sequence are cut into full pieces, the first of which may be shorter. The
pieces are dealt to groups of bounded size, each packed by best-fit decreasing. Dual-feasible functions give a lower bound
on each group's number of bins: a group that meets its bound is certified and done. While all groups together need more bins than the
bound of all pieces, the looser bins of groups with a gap (of all groups, once each is certified) give up their pieces;
these are exchanged, that is dealt anew to fewer groups, and packed again.

No group is larger than about ``group_rows``, so no task grows with the input; only numbers travel, never ids or texts.

Defined cases: a null text is an empty one (its end id alone); repeated rows are packed separately; ties in length are
broken by row; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytebpe import encode
from .common import attach, give_back, materialise

CAPACITY = 2048
GROUP_ROWS = 40_000
#: Fixed value: the pattern of the library's byte-level pre-tokenizer.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class LibraryIds:
    """Ids of a text as the tokenizers library gives them, by a quicker way where that is proven to be the same.

    The library merges pairs that its file lists; a rank table merges any neighbours whose union is a token, lowest rank
    first. Both give the same ids on all texts if ids rise with the merges and every token, spelled out alone, is merged
    to itself by the library: a union formed in a text is formed by the same steps when it stands alone, so no other pair
    can ever yield it. That is checked here for each token of the file; a file that fails, or that isn't plain byte-level
    BPE, is left to the library, and so is each text that contains an added token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        ranks = self._ranks(said["model"]) if self._plain(said) else None
        self.ranked = None if ranks is None else tiktoken.Encoding("local", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _plain(said: dict) -> bool:
        """Whether nothing but byte-level splitting and merging happens to a text."""
        model, split = said["model"], said["pre_tokenizer"] or {}
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
        around = ("normalizer", "post_processor", "truncation", "padding")
        return model["type"] == "BPE" and not any(model.get(k) for k in options) and not any(said.get(k) for k in around) and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")

    def _ranks(self, model: dict) -> dict[bytes, int] | None:
        """The table of tokens by id; None if a token isn't merged to itself or ids don't rise with the merges."""
        # The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for the characters from 256 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in pairs]
        if any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
            return None
        ranks = {}
        for token, i in model["vocab"].items():
            if token in self.added:
                continue
            alone = self.library.model.tokenize(token)
            if len(alone) != 1 or alone[0].id != i or not set(token) <= set(byte_of):
                return None
            ranks[bytes(byte_of[c] for c in token)] = i
        return ranks if sum(len(t) == 1 for t in ranks) == 256 else None

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.ranked is None or any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(x.astype("<u4", copy=False).tobytes() for x in encode(self.ranked, text))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> LibraryIds:
    return LibraryIds(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones, but for the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(id, piece, start, length, ids_crc32): a row for each piece of each text, with the checksum of its ids."""
    attach(df.sparkSession)
    kinds = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokenizer(path).ids, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            whose, rows = [], []
            for at, x in enumerate(batch.column(1)):
                ids = encode(x.as_py() or "") + end
                parts = cut(len(ids) // 4, capacity)
                whose += [at] * len(parts)
                rows += [(i, s, n, zlib.crc32(memoryview(ids)[4 * s : 4 * (s + n)])) for i, (s, n) in enumerate(parts)]
            own = batch.column(0).take(pa.array(whose, pa.int64()))
            del batch
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield give_back(pa.RecordBatch.from_arrays([own, *[pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)]], ["id", *kinds]))

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), *[T.StructField(k, T.IntegerType() if k == "piece" else T.LongType()) for k in kinds]])
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def lower_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """The largest of the bounds that dual-feasible functions give for bins of ``capacity``.

    ``counts``: of each length, if these are distinct.

    Two families over the histogram of lengths: dropping items below k while rounding those above capacity-k up to a full
    bin (k = 0 is the plain volume), and the staircase x -> floor((m+1) x / C) / m, exact multiples kept."""
    if not len(lengths):
        return 0
    size, count = np.unique(lengths, return_counts=True) if counts is None else (lengths, counts)
    best = -(-int((size * count).sum()) // capacity)
    for k in [k for k in np.unique(np.minimum(size, capacity - size)) if 0 < k <= capacity // 2]:
        value = np.where(size > capacity - k, capacity, np.where(size < k, 0, size))
        best = max(best, -(-int((value * count).sum()) // capacity))
    for m in range(1, 12):
        whole = (m + 1) * size % capacity == 0
        value = np.where(whole, size * m, (m + 1) * size // capacity * capacity)  # in units of 1 / (m * capacity)
        best = max(best, -(-int((value * count).sum()) // (m * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and the room left in each bin. Bins are kept by room; a bit set finds the tightest that fits."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    room: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    present = 0
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = present >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                present &= ~(1 << r)
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins[i] = b
        room[b] = r - n
        by_room[r - n].append(b)
        present |= 1 << (r - n)
    return bins, np.array(room, np.int64)


_STATE = "uid long, length long, bin long, room long, gap long"


def _pack_groups(df: DataFrame, groups: int, salt: int, capacity: int) -> DataFrame:
    """Deal rows (uid, length) to groups and pack each: bin is unique over all groups of this round."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        lengths = table["length"].to_numpy()
        bins, room = best_fit_decreasing(lengths, capacity)
        gap = len(room) - lower_bound(lengths, capacity)
        return pa.table({"uid": table["uid"], "length": table["length"], "bin": (key[0].as_py() << 24) + bins, "room": room[bins], "gap": np.full(len(bins), gap)})

    dealt = df.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(groups)).alias("group"))
    return dealt.groupBy("group").applyInArrow(run, _STATE)


def assign(items: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int | None = None) -> tuple[DataFrame, int, int]:
    """(uid, length, bin) for items (uid, length), bins numbered uniquely; the bound for all items; the number of bins.

    The bound (from the histogram of lengths, at most one row per length) says when nothing can be gained. Until then
    each round settles the fuller half of the bins that have room, of the groups with a gap or, once all groups
    are certified, of all groups; the pieces of the other half are exchanged: dealt to half as many groups or fewer, and
    packed again. A round that needs more bins than before is not used. It ends when the bound is met, or when a round
    neither settles nor saves a bin; ``rounds`` may end it earlier."""
    lengths = items.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").collect()
    size, count = np.array([r.length for r in lengths], np.int64), np.array([r.n for r in lengths], np.int64)
    bound, n = lower_bound(size, capacity, count), int(count.sum())
    state = materialise(_pack_groups(items, max(1, -(-n // group_rows)), 0, capacity), "packed")
    named = lambda rows, turn: rows.select("uid", "length", (F.lit(turn << 48).cast("long") + F.col("bin")).alias("bin"))
    bins_of = lambda rows: rows.agg(F.count("*").alias("n"), F.count_distinct("bin").alias("bins")).first()
    total, done, turn = bins_of(state).bins, None, 0
    held = total
    while total > bound and (rounds is None or turn < rounds):
        gaps = bool(state.where("gap > 0 and room > 0").limit(1).count())
        loose = (F.col("room") > 0) & (F.col("gap") > 0) if gaps else F.col("room") > 0
        middle = state.where(loose).groupBy("bin").agg(F.first("room").alias("room")).agg(F.percentile_approx("room", 0.5)).first()[0]
        if middle is None:
            break
        open_bin = loose & (F.col("room") >= middle)
        rest = state.where(open_bin)
        before = bins_of(rest)
        again = materialise(_pack_groups(rest.select("uid", "length"), max(1, -(-before.n // group_rows)), turn + 1, capacity), "packed")
        after = bins_of(again).bins
        if after > before.bins or after == held:
            break
        settled = named(state.where(~open_bin), turn)
        done = settled if done is None else done.unionByName(settled)
        state, turn, total, held = again, turn + 1, total - before.bins + after, after
    last = named(state, turn)
    return last if done is None else done.unionByName(last), bound, total


def pack_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int | None = None) -> DataFrame:
    """One row per piece: (id_col, piece, start, length, ids_crc32, sequence_id, offset, bound, gap).

    ``bound``: sequences that any packing of these pieces needs; ``gap``: sequences used beyond that (the same in each row)."""
    cut_up = materialise(pieces(df, path, id_col, text_col, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    bins, bound, total = assign(cut_up.select("uid", "length"), capacity, group_rows, rounds)
    placed = cut_up.join(bins.select("uid", F.col("bin").alias("sequence_id")), "uid")
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "uid").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0).cast("long"))
    return placed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", offset.alias("offset"), F.lit(bound).cast("long").alias("bound"), F.lit(total - bound).cast("long").alias("gap"))
