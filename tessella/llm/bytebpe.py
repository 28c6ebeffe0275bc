"""Byte-level BPE with a local rank file: encoding and decoding of whole texts in Arrow batches.

Long texts are cut where a pre-token certainly ends: between a character that isn't white space and one that is. No
pre-token of the pattern spans such a place, and its look-ahead only reads the white space that follows, so the cut never
changes an id. Long runs of white space, which the library's regular expression engine can't match, are taken as the
pattern takes them: all but the last character are one pre-token if text follows, else all.

Defined cases: a null text counts as empty (no ids); repeated rows get equal results; other columns are carried along.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach

#: Unicode's White_Space, as the pattern's ``\s`` has it.
WHITE = "\\t-\\r \\x85\\xa0  -     　"
SEGMENT_CHARS = 1 << 16
_LONG_RUN = 2048
_long_white = re.compile(f"[{WHITE}]{{{_LONG_RUN},}}")
_boundary = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    """The library's encoder over a local rank file (base64 token and rank on each line), without special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _segments(text: str, begin: int, end: int, limit: int) -> Iterator[str]:
    while end - begin > limit:
        cut = _boundary.search(text, begin + limit, end)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    if begin < end:
        yield text[begin:end]


def encode(enc: tiktoken.Encoding, text: str, limit: int = SEGMENT_CHARS) -> Iterator[np.ndarray]:
    """The ids of a text, in pieces of bounded size."""
    if len(text) <= _LONG_RUN:
        yield np.array(enc.encode_ordinary(text), np.uint32)
        return
    begin = 0
    for run in _long_white.finditer(text):
        for part in _segments(text, begin, run.start(), limit):
            yield np.array(enc.encode_ordinary(part), np.uint32)
        begin = run.end() - 1 if run.end() < len(text) else run.end()
        yield np.array(enc._encode_single_piece(text[run.start() : begin]), np.uint32)
    for part in _segments(text, begin, len(text), limit):
        yield np.array(enc.encode_ordinary(part), np.uint32)


def decode(enc: tiktoken.Encoding, ids: np.ndarray) -> bytes:
    """Raw bytes of ids; a text's bytes are whole even where one id isn't valid UTF-8 by itself."""
    return enc.decode_bytes(ids.tolist())


_DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(df: DataFrame, path: str, pattern: str, text_col: str = "text", into: str = "ids") -> DataFrame:
    """All columns and ``into``: the array of ids of the whole text."""
    attach(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(path, pattern)
        for batch in batches:
            parts = [np.concatenate([*encode(enc, x or ""), np.empty(0, np.uint32)]).astype(np.int32) for x in batch.to_pylist()]
            at = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*parts, np.empty(0, np.int32)])))

    return df.withColumn(into, F.arrow_udf(run, "array<int>")(F.col(text_col)))


def decode_documents(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", into: str = "bytes") -> DataFrame:
    """All columns and ``into``: the raw bytes of an array of ids (null: empty)."""
    attach(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(path, pattern)
        for batch in batches:
            yield pa.array([enc.decode_bytes(x or []) for x in batch.to_pylist()], pa.binary())

    return df.withColumn(into, F.arrow_udf(run, "binary")(F.col(ids_col)))


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text", into: str = "bpe") -> DataFrame:
    """All columns and the struct ``into``: number of ids, digest of the ids, digest of the bytes decoded from them.

    Ids never leave the worker, and a long text is held one segment at a time."""
    attach(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(path, pattern)
        for batch in batches:
            counts, ids_hex, bytes_hex = [], [], []
            for x in batch:
                n, ids_sha, bytes_sha = 0, hashlib.sha256(), hashlib.sha256()
                for ids in encode(enc, x.as_py() or ""):
                    n += len(ids)
                    ids_sha.update(ids.astype("<u4").tobytes())
                    bytes_sha.update(decode(enc, ids))
                counts.append(n)
                ids_hex.append(ids_sha.hexdigest())
                bytes_hex.append(bytes_sha.hexdigest())
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(bytes_hex, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return df.withColumn(into, F.arrow_udf(run, _DIGEST)(F.col(text_col)))
