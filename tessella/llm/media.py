"""Media columns by signature sniffing.

An Aho-Corasick automaton finds the magic bytes of all known formats in one pass over a value; a validator per format then
confirms structure and lengths. What a value really is (its whole length is one valid object) corrects the declared type;
valid objects further inside are carved out with their place. Formats: WAV and AIFF (any PCM), BMP (uncompressed, any depth
and row order), PGM and PPM (binary), PNG (chunk lengths and checksums), GIF, JPEG, Ogg, ZIP and PDF. Whether an object's
samples are plain 8-bit ones in reading order, as ``store`` writes them, is a separate field (``plain``).

``store`` is the way in: it puts bytes into one of the lossless 8-bit forms, for a quarter of the payloads as a member of a
ZIP container, so that they have to be carved; ``declare`` names the type, wrongly for a quarter. ``digest`` sniffs,
corrects, carves and reads the payload back.

Defined cases: a null value is empty bytes, has no type and no objects; several formats at the same place are ordered by
place, then length, then name; repeated rows get equal results; other columns are carried along, but one with the name
of the result is replaced; without other columns ``carve`` has no column ``row``. Headers of PGM and PPM are read up to 512
bytes, comments included.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, give_back


class Found(NamedTuple):
    """An object in a value: where it is, where its samples are, its sides (frames and channels of sound), its rate."""

    format: str
    begin: int
    end: int
    data_begin: int
    data_end: int
    width: int = 0
    height: int = 0
    rate: int = 0
    plain: bool = False


#: Width of stored pictures, and samples a second of stored sound.
UNIT = 64
RATE = 8000
#: Gray levels of stored BMPs.
_PALETTE = b"".join(bytes((i, i, i, 0)) for i in range(256))


def _wav(b: bytes, at: int) -> Found | None:
    if len(b) < at + 44 or b[at + 8 : at + 12] != b"WAVE":
        return None
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    if end > len(b):
        return None
    pos, form, samples = at + 12, None, None
    while pos + 8 <= end:
        kind, n = struct.unpack_from("<4sI", b, pos)
        if pos + 8 + n > end:
            return None
        if kind == b"fmt ":
            if n < 16:
                return None
            code, channels, rate, _, align, bits = form = struct.unpack_from("<HHIIHH", b, pos + 8)
            if code not in (1, 3, 0xFFFE) or not channels or not rate or bits not in (8, 16, 24, 32, 64) or align != channels * bits // 8:
                return None
        elif kind == b"data":
            samples = (pos + 8, pos + 8 + n)
        pos += 8 + n + n % 2
    if form is None or samples is None or pos not in (end, end + 1) or (samples[1] - samples[0]) % align:
        return None
    return Found("wav", at, end, *samples, (samples[1] - samples[0]) // align, channels, rate, (code, align, bits) == (1, 1, 8))


def _aiff(b: bytes, at: int) -> Found | None:
    if len(b) < at + 54 or b[at + 8 : at + 12] != b"AIFF":
        return None
    end = at + 8 + struct.unpack_from(">I", b, at + 4)[0]
    if end > len(b):
        return None
    pos, form, samples = at + 12, None, None
    while pos + 8 <= end:
        kind, n = struct.unpack_from(">4sI", b, pos)
        if pos + 8 + n > end:
            return None
        if kind == b"COMM" and n >= 18:
            channels, frames, bits, exponent, mantissa = form = struct.unpack_from(">HIHHQ", b, pos + 8)
            if not channels or not 1 <= bits <= 32 or not 16383 <= exponent <= 16446:
                return None
        elif kind == b"SSND" and n >= 8:
            samples = (pos + 16, pos + 8 + n)
        pos += 8 + n + n % 2
    if form is None or samples is None or samples[1] - samples[0] != frames * channels * ((bits + 7) // 8):
        return None
    return Found("aiff", at, end, *samples, frames, channels, mantissa >> (16446 - exponent), (channels, bits) == (1, 8))


def _bmp(b: bytes, at: int) -> Found | None:
    if len(b) < at + 54:
        return None
    size, _, offset, head, width, height, planes, bits, packing = struct.unpack_from("<IIIIiiHHI", b, at + 2)
    if head not in (40, 108, 124) or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or packing not in (0, 3) or width <= 0 or height == 0:
        return None
    row = (width * bits + 31) // 32 * 4
    if at + size > len(b) or offset < 14 + head or not 0 <= size - offset - row * abs(height) < 4:
        return None
    plain = (bits, packing, offset) == (8, 0, 54 + len(_PALETTE)) and height < 0 and row == width and b[at + 54 : at + offset] == _PALETTE
    return Found("bmp", at, at + size, at + offset, at + offset + row * abs(height), width, abs(height), 0, plain)


_GAP = rb"\s(?:\s|#[^\n]*\n)*"
_NETPBM = re.compile(rb"P([56])" + _GAP + rb"(\d{1,9})" + _GAP + rb"(\d{1,9})" + _GAP + rb"(\d{1,5})\s")


def _netpbm(b: bytes, at: int) -> Found | None:
    head = _NETPBM.match(b, at, at + 512)
    if head is None:
        return None
    kind, width, height, top = map(int, head.groups())
    first, unit = head.end(), (1 if kind == 5 else 3) * (1 if top < 256 else 2)
    end = first + width * height * unit
    if not width or not height or not 1 <= top < 65536 or end > len(b):
        return None
    return Found("pgm" if kind == 5 else "ppm", at, end, first, end, width, height, 0, (kind, top) == (5, 255))


def _png(b: bytes, at: int) -> Found | None:
    pos, width, height = at + 8, 0, 0
    while pos + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, pos)
        if pos + 12 + n > len(b) or zlib.crc32(memoryview(b)[pos + 4 : pos + 8 + n]) != struct.unpack_from(">I", b, pos + 8 + n)[0]:
            return None
        if kind == b"IHDR" and n == 13:
            width, height = struct.unpack_from(">II", b, pos + 8)
        pos += 12 + n
        if kind == b"IEND":
            return Found("png", at, pos, at, pos, width, height) if width and height else None
    return None


def _sub_blocks(b: bytes, pos: int) -> int:
    """The place behind a GIF's run of sub-blocks, or the value's end if it's cut off."""
    while pos < len(b) and b[pos]:
        pos += 1 + b[pos]
    return min(pos + 1, len(b))


def _gif(b: bytes, at: int) -> Found | None:
    if len(b) < at + 14:
        return None
    width, height, packed = struct.unpack_from("<HHB", b, at + 6)
    pos, pictures = at + 13 + (3 << (packed & 7) + 1 if packed & 128 else 0), 0
    while pos < len(b):
        if b[pos] == 0x3B:
            return Found("gif", at, pos + 1, at, pos + 1, width, height) if pictures and width and height else None
        if b[pos] == 0x21:
            pos = _sub_blocks(b, pos + 2)
        elif b[pos] == 0x2C and pos + 10 < len(b):
            own = b[pos + 9]
            pos, pictures = _sub_blocks(b, pos + 11 + (3 << (own & 7) + 1 if own & 128 else 0)), pictures + 1
        else:
            return None
    return None


_MARKER = re.compile(rb"\xff[^\x00\xff\xd0-\xd7]")


def _jpeg(b: bytes, at: int) -> Found | None:
    pos, width, height, scans = at + 2, 0, 0, 0
    while pos + 4 <= len(b) and b[pos] == 0xFF:
        kind, n = b[pos + 1], struct.unpack_from(">H", b, pos + 2)[0]
        if kind < 0xC0 or 0xD0 <= kind <= 0xD9 or n < 2:
            return None
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            if n < 8 or pos + 9 > len(b):
                return None
            height, width = struct.unpack_from(">HH", b, pos + 5)
        pos += 2 + n
        if kind == 0xDA:  # a scan's coded bytes go on to the next marker that isn't a restart
            after = _MARKER.search(b, pos)
            if after is None:
                return None
            pos, scans = after.start(), scans + 1
            if b[pos + 1] == 0xD9:
                return Found("jpeg", at, pos + 2, at, pos + 2, width, height) if width and scans else None
    return None


def _ogg(b: bytes, at: int) -> Found | None:
    pos, flags = at, 0
    while b[pos : pos + 5] == b"OggS\0" and pos + 27 <= len(b):
        flags, table = b[pos + 5], pos + 27 + b[pos + 26]
        end = table + sum(b[pos + 27 : table])
        if (pos == at and not flags & 2) or end > len(b):
            return None
        pos = end
    return Found("ogg", at, pos, at, pos) if flags & 4 else None


def _zip(b: bytes, at: int) -> Found | None:
    """From the end record back: every entry of the directory must name a local header of the archive."""
    if len(b) < at + 22:
        return None
    disk, _, here, entries, size, offset, note = struct.unpack_from("<HHHHIIH", b, at + 4)
    begin, pos, end = at - size - offset, at - size, at + 22 + note
    if disk or here != entries or begin < 0 or end > len(b):
        return None
    for _ in range(entries):
        if b[pos : pos + 4] != b"PK\1\2" or pos + 46 > at:
            return None
        name, extra, comment = struct.unpack_from("<HHH", b, pos + 28)
        local = begin + struct.unpack_from("<I", b, pos + 42)[0]
        if b[local : local + 4] != b"PK\3\4" or local >= at - size:
            return None
        pos += 46 + name + extra + comment
    return Found("zip", begin, end, begin, end) if pos == at else None


_PDF_END = re.compile(rb"startxref\s+(\d{1,12})\s+%%EOF(?:\r\n|\n|\r)?")
_PDF_TABLE = re.compile(rb"xref\b|\d+\s+\d+\s+obj\b")


def _pdf(b: bytes, at: int) -> Found | None:
    """Up to the last end mark before another file begins; updates append further ones."""
    limit, end = b.find(b"%PDF-", at + 5), None
    for mark in _PDF_END.finditer(b, at, limit if limit >= 0 else len(b)):
        if _PDF_TABLE.match(b, at + int(mark[1])):
            end = mark.end()
    return Found("pdf", at, end, at, end) if end else None


#: Magic bytes at the beginning of each format (of ZIP: of the record at its end).
MAGIC: dict[bytes, Callable[[bytes, int], Found | None]] = {
    b"RIFF": _wav,
    b"FORM": _aiff,
    b"BM": _bmp,
    b"P5\n": _netpbm,
    b"P5 ": _netpbm,
    b"P6\n": _netpbm,
    b"P6 ": _netpbm,
    b"\x89PNG\r\n\x1a\n": _png,
    b"GIF87a": _gif,
    b"GIF89a": _gif,
    b"\xff\xd8\xff": _jpeg,
    b"OggS": _ogg,
    b"PK\x05\x06": _zip,
    b"%PDF-": _pdf,
}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for magic, validator in MAGIC.items():
        found.add_word(magic.decode("latin-1"), (len(magic), validator))
    found.make_automaton()
    return found


def sniff(value: bytes | None) -> list[Found]:
    """All valid objects of a value, by place; objects inside the samples of another one are found as well."""
    value = value or b""
    out = []
    for last, (n, validator) in _automaton().iter(value.decode("latin-1")):
        hit = validator(value, last + 1 - n)
        if hit:
            out.append(hit)
    return sorted(out, key=lambda x: (x.begin, -x.end, x.format))


def whole(value: bytes, found: list[Found]) -> Found | None:
    """The object that is the whole value."""
    return next((x for x in found if x.begin == 0 and x.end == len(value)), None)


# --- storing and reading back ---


def _as_wav(payload: bytes) -> bytes:
    body = struct.pack("<4sIHHIIHH4sI", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload)) + payload + b"\0" * (len(payload) % 2)
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


def _as_aiff(payload: bytes) -> bytes:
    # The rate is an 80-bit float: the mantissa's top bit is the rate's highest one.
    exponent = 16383 + RATE.bit_length() - 1
    common = struct.pack(">4sIHIHHQ", b"COMM", 18, 1, len(payload), 8, exponent, RATE << (64 - RATE.bit_length()))
    sound = struct.pack(">4sIII", b"SSND", 8 + len(payload), 0, 0) + payload + b"\0" * (len(payload) % 2)
    return b"FORM" + struct.pack(">I", 4 + len(common) + len(sound)) + b"AIFF" + common + sound


def _as_bmp(payload: bytes) -> bytes:
    offset = 54 + len(_PALETTE)
    return b"BM" + struct.pack("<IIIIiiHHIIiiII", offset + len(payload), 0, offset, 40, UNIT, -(len(payload) // UNIT), 1, 8, 0, len(payload), 0, 0, 256, 0) + _PALETTE + payload


def _as_pgm(payload: bytes) -> bytes:
    return f"P5\n{UNIT} {len(payload) // UNIT}\n255\n".encode() + payload


_STORES = {"wav": _as_wav, "aiff": _as_aiff, "bmp": _as_bmp, "pgm": _as_pgm}
_FORMS = list(_STORES)


def _in_zip(member: bytes) -> bytes:
    """A ZIP archive with one member, not compressed."""
    name = b"media"
    # Versions, flags, method 0, time and day (1 January 1980), checksum, both sizes, lengths of name and extra field.
    common = struct.pack("<HHHHHIIIHH", 10, 0, 0, 0, 33, zlib.crc32(member), len(member), len(member), len(name), 0)
    local = b"PK\3\4" + common + name
    entry = b"PK\1\2" + struct.pack("<H", 20) + common + struct.pack("<HHHII", 0, 0, 0, 0, 0) + name
    return local + member + entry + b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 1, 1, len(entry), len(local) + len(member), 0)


def pad(raw: bytes, unit: int = UNIT) -> bytes:
    """Bytes 0 behind, up to a positive multiple of the unit."""
    return raw + b"\0" * (max(unit, -(-len(raw) // unit) * unit) - len(raw))


def store(payload: bytes) -> bytes:
    """The payload in one of the forms, one in four inside a ZIP; chosen by its checksum, so equal payloads are stored alike."""
    chosen = zlib.crc32(payload)
    stored = _STORES[_FORMS[chosen % 4]](payload)
    return _in_zip(stored) if chosen >> 2 & 3 == 0 else stored


def declare(payload: bytes) -> str:
    """The type that a careless source names for ``store(payload)``: its form, one in four times the next form's, never the ZIP."""
    chosen = zlib.crc32(payload)
    return _FORMS[(chosen + (chosen >> 4 & 3 == 0)) % 4]


_OBJECT_ARROW = pa.struct([("format", pa.string()), *((k, pa.int64()) for k in Found._fields[1:-1]), ("plain", pa.bool_())])
_OBJECT = f"struct<format:string,{','.join(f'{k}:long' for k in Found._fields[1:-1])},plain:boolean>"


def sniff_column(df: DataFrame, content_col: str = "content", declared_col: str | None = None, into: str = "media") -> DataFrame:
    """All columns and the struct ``into``: declared and actual type, whether they differ, and every embedded object."""
    attach(df.sparkSession)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for contents, declared in batches:
            rows = []
            for value, said in zip(contents, declared.to_pylist(), strict=True):
                raw = value.as_py() or b""
                found = sniff(raw)
                top = whole(raw, found)
                actual = top.format if top else None
                rows.append({"declared": said, "type": actual, "corrected": actual is not None and actual != said, "objects": [x._asdict() for x in found]})
            yield give_back(pa.array(rows, pa.struct([("declared", pa.string()), ("type", pa.string()), ("corrected", pa.bool_()), ("objects", pa.list_(_OBJECT_ARROW))])))

    said = F.col(declared_col).cast("string") if declared_col else F.lit(None).cast("string")
    return df.withColumn(into, F.arrow_udf(run, f"declared string, type string, corrected boolean, objects array<{_OBJECT}>")(F.col(content_col), said))


def carve(df: DataFrame, content_col: str = "content", media_col: str = "media") -> DataFrame:
    """A row per embedded object of a sniffed column: all other columns, the object's fields and its bytes as ``object``."""
    rest = [c for c in df.columns if c not in (content_col, media_col)]
    rows = df.select(*[F.col(c) for c in rest], F.col(content_col).alias("_content"), F.explode(F.col(media_col)["objects"]).alias("_o"))
    return rows.select(*([F.struct(*rest).alias("row")] if rest else []), "_o.*", F.substring("_content", F.col("_o.begin").cast("int") + 1, (F.col("_o.end") - F.col("_o.begin")).cast("int")).alias("object"))


def store_column(df: DataFrame, text_col: str = "text", into: str = "stored") -> DataFrame:
    """All columns and the struct ``into``: the text's padded UTF-8 bytes in a stored form (``content``), and its ``declared`` type."""
    attach(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            payloads = [pad((x.as_py() or "").encode()) for x in batch]
            columns = [pa.array(map(store, payloads), pa.binary()), pa.array(map(declare, payloads), pa.string())]
            yield give_back(pa.StructArray.from_arrays(columns, ["content", "declared"]))

    return df.withColumn(into, F.arrow_udf(run, "content binary, declared string")(F.col(text_col)))


def _feature(media: Found, payload: bytes) -> str:
    samples = np.frombuffer(payload, np.uint8)
    mean = int(samples.sum(dtype=np.int64)) // len(samples)
    crossings = int(np.count_nonzero((samples[1:] >= 128) != (samples[:-1] >= 128)))
    return f"{media.format} {media.width}x{media.height} min={samples.min()} max={samples.max()} mean={mean} crossings={crossings}"


_DIGEST = {"n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "declared_type": pa.string(), "media_type": pa.string(), "type_corrected": pa.bool_(), "n_carved": pa.int32(), "carved_from": pa.int64()}
_DIGEST_SQL = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, declared_type string, media_type string, type_corrected boolean, n_carved int, carved_from long"


def digest(text_bytes: int, stored: bytes, declared: str | None) -> tuple:
    """Sniff the stored bytes, correct their type, and read the payload back from the longest object with plain samples,
    which is the value itself or has to be carved from ``carved_from``; ``n_carved`` counts all objects but the whole value."""
    found = sniff(stored)
    top, media = whole(stored, found), max((x for x in found if x.plain), key=lambda x: x.end - x.begin, default=None)
    if top is None or media is None:
        raise ValueError("stored bytes are no valid object")
    payload = stored[media.data_begin : media.data_end]
    hashes = hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(stored), hashlib.sha256(stored).hexdigest()
    return text_bytes, len(payload), *hashes, _feature(media, payload), declared, top.format, top.format != declared, len(found) - 1, media.begin


def digest_column(df: DataFrame, text_col: str = "text", stored_col: str = "stored", into: str = "digest") -> DataFrame:
    """All columns and the struct ``into`` with what was read back from ``stored_col``."""
    attach(df.sparkSession)

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sizes, contents, declared in batches:
            rows = [digest(n, c.as_py(), said) for n, c, said in zip(sizes.to_pylist(), contents, declared.to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _DIGEST]
            yield give_back(pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in zip(columns, _DIGEST.values(), strict=True)], list(_DIGEST)))

    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    return df.withColumn(into, F.arrow_udf(run, _DIGEST_SQL)(size, F.col(stored_col)["content"], F.col(stored_col)["declared"]))
