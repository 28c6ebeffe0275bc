"""WARC archives: writing captures, reading records back, and assembling transactions.

A capture is three records: request, response (or revisit) and metadata; request and metadata name the response as
concurrent. Records are written as text whose line end is the record separator (two CRLF), so Spark's own writer makes
gzip-compressed archives, committed task by task. The reader takes each archive whole as bytes, unpacks it as a stream and
trusts only Content-Length.

Assembly joins the records through their concurrent-to ids and emits one nested row per capture.

Defined cases: null html is an empty payload; a null url leaves out the target; payloads under ``min_bytes`` and equal
smallest page ids are all responses; rows with no page id are responses that nothing refers to; of several requests or
metadata records that name one response, the one with the smallest record id is taken and ``n_requests`` and
``n_metadata`` tell how many there were; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, materialise, shared_path

MIN_BYTES = 100
#: Payload bytes in one archive file at most, unless one page alone is larger; bounds what a reading task holds (each archive is one value).
FILE_BYTES = 1 << 27
#: Upper bounds of the payload sizes that are written together.
SIZE_CLASSES = (1 << 16, 1 << 20, 1 << 24)
#: A payload with more than one in so many of all pages is matched by broadcast.
HOT_SHARE = 10_000
_READ = 1 << 16


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, html, digest, n_bytes, refers_to): which page's response has the payload already, if another's."""
    raw = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.sha2(raw, 256).alias("digest"), F.octet_length(raw).cast("long").alias("n_bytes"))
    large = F.col("n_bytes") >= min_bytes
    counts = rows.where(large & F.col("page_id").isNotNull()).groupBy(F.col("digest").alias("of")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = materialise(counts.where("n > 1"), "warc-first")
    often = F.col("n") * HOT_SHARE > rows.count()
    hot = first.where(often).select(F.col("of").alias("hot_of"), F.col("first").alias("hot_first"))
    met = rows.join(F.broadcast(hot), (F.col("digest") == F.col("hot_of")) & large, "left")
    # Rows that have met their payload, or need not, get a key that nothing has, so that they spread evenly; it is made of the row
    # alone, so that a condition on the size is settled at the scan, before anything is digested.
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    met = met.withColumn("key", F.when(large & F.col("hot_of").isNull(), F.col("digest")).otherwise(alone)).join(first.where(~often).select("of", "first"), F.col("key") == F.col("of"), "left")
    of = F.coalesce("hot_first", "first")
    return met.select("page_id", "url", "html", "digest", "n_bytes", F.when(of < F.col("page_id"), of).alias("refers_to"), F.coalesce(of == F.col("page_id"), F.lit(False)).alias("referred"))


def _named_uuid(page_id):
    """The record id of a page that revisits refer to."""
    h = F.md5(F.concat(F.lit("page:"), page_id.cast("string")))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _record(kind: str, record_id, extra, content_type: str, body):
    """A record without the separator that ends it."""
    head = F.concat(F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <"), record_id, F.lit(">\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n"), extra)
    return F.concat(head, F.lit(f"Content-Type: {content_type}\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body)


def write(judged: DataFrame, path: str, file_bytes: int = FILE_BYTES, largest: int | None = None) -> None:
    """Archives of the judged pages: request, response or revisit, and metadata for each row, next to each other.

    Pages are written by size class, as many to an archive as its bytes allow at the class's upper bound; ``largest`` is the
    longest payload's size, if it is known."""
    if largest is None:
        largest = judged.agg(F.max("n_bytes")).first()[0] or 0
    below = 0
    for bound in (*SIZE_CLASSES, None):
        of = (F.col("n_bytes") >= below) & (F.col("n_bytes") < bound if bound else F.lit(True))
        if below <= largest:
            _write(judged.where(of), f"{path}/from-{below}", max(1, file_bytes // bound) if bound else 1)
        below = bound


def _write(judged: DataFrame, path: str, file_rows: int) -> None:
    # Every row is a capture of its own, so repeated rows don't share ids, but for a page that revisits refer to by its id.
    ids = judged.withColumn("u", F.when(F.col("referred"), _named_uuid(F.col("page_id"))).otherwise(F.uuid()))
    safe = F.regexp_replace(F.col("url"), "[\\x00-\\x20\\x7f]", "%20")
    target = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), safe, F.lit("\r\n")), F.lit(""))
    response_id = F.concat(F.lit("urn:uuid:"), F.col("u"))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: <"), response_id, F.lit(">\r\n"))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit("\r\n\r\n"))
    refers = F.concat(F.lit("WARC-Refers-To: <urn:uuid:"), _named_uuid(F.col("refers_to")), F.lit(">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))
    http_type = "application/http; msgtype=response"
    main = F.when(F.col("refers_to").isNull(), _record("response", response_id, F.concat(target, digest), http_type, F.concat(http, F.col("html")))).otherwise(_record("revisit", response_id, F.concat(target, digest, refers), http_type, http))
    request = _record("request", F.concat(F.lit("urn:request:"), F.col("u")), F.concat(target, concurrent), "application/http; msgtype=request", F.concat(F.lit("GET "), F.coalesce(safe, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")))
    metadata = _record("metadata", F.concat(F.lit("urn:metadata:"), F.col("u")), F.concat(target, concurrent), "application/warc-fields", F.concat(*[F.coalesce(F.concat(F.lit(f"{k}: "), F.col(c).cast("string"), F.lit("\r\n")), F.lit("")) for k, c in (("pageId", "page_id"), ("refersToPageId", "refers_to"))]))
    text = F.concat_ws("\r\n\r\n", request, main, metadata)
    ids.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", file_rows).text(path)


def _unpacked(raw: bytes) -> Iterator[bytes]:
    """Plain bytes of an archive, gzip members or not, piece by piece."""
    if raw[:2] != b"\x1f\x8b":
        yield raw
        return
    view, at = memoryview(raw), 0
    while at < len(raw):
        unpack = zlib.decompressobj(31)
        while at < len(raw) and not unpack.eof:
            part = view[at : at + _READ]
            yield unpack.decompress(part)
            at += len(part) - len(unpack.unused_data)
        if not unpack.eof:
            raise ValueError("an archive ends inside a gzip member")


def records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, body) of each record."""
    source, buffer = _unpacked(raw), bytearray()

    def fill(n: int) -> bool:
        while len(buffer) < n:
            part = next(source, None)
            if part is None:
                return False
            buffer.extend(part)
        return True

    while fill(1):
        if buffer[:1] in b"\r\n":
            del buffer[:1]
            continue
        seen = 0
        while (end := buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not fill(seen + 1):
                raise ValueError("an archive ends inside a record header")
        lines = buffer[:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins with {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(fields["content-length"])
        if not fill(end + 4 + n):
            raise ValueError("an archive ends inside a record")
        yield fields, bytes(memoryview(buffer)[end + 4 : end + 4 + n])
        del buffer[: end + 4 + n]


_FIELDS = [("warc_type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("digest_ok", pa.bool_()), ("payload", pa.binary())]
_SQL = "warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, payload_digest string, payload_bytes long, digest_ok boolean, payload binary"


def _row(fields: dict[str, str], body: bytes, keep: bool) -> tuple:
    kind = fields.get("warc-type", "")
    bare = lambda k: fields[k].strip("<>") if k in fields else None
    said = fields.get("warc-payload-digest", "").partition(":")[2] or None
    payload, size = body, len(body)
    if kind in ("response", "revisit", "request"):
        head, _, payload = body.partition(b"\r\n\r\n")
        size = len(payload)
    digest = hashlib.sha256(payload).hexdigest()
    ok = said is None or said == digest
    if kind == "revisit":  # no payload of its own: the HTTP header still has its length, and the digest is the response's
        lengths = [x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size, digest, ok = int(lengths[0]) if lengths else 0, said, True
    return kind, bare("warc-record-id"), bare("warc-concurrent-to"), bare("warc-refers-to"), fields.get("warc-target-uri"), digest, size, ok, payload if keep or kind == "metadata" else None


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives below ``path``. Digest and length are those of the payload as read."""
    attach(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                rows, size = [], 0
                for fields, body in records(value.as_py()):
                    rows.append(_row(fields, body, payloads))
                    size += len(body) if payloads else 0
                    if len(rows) >= 1000 or size > 1 << 23:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", True).load(path).select("content")
    return files.mapInArrow(run, _SQL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _FIELDS, strict=True)], [k for k, _ in _FIELDS])


def assemble(rows: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` (the response or revisit), ``request`` and ``metadata`` structs."""
    parts = [c for c in rows.columns if c != "concurrent_to"]
    main = rows.where(F.col("warc_type").isin("response", "revisit")).select("record_id", F.struct(*parts).alias("capture"))

    def side(kind: str, name: str, count: str) -> DataFrame:
        of = rows.where((F.col("warc_type") == kind) & F.col("concurrent_to").isNotNull())
        return of.groupBy(F.col("concurrent_to").alias(f"{name}_of")).agg(F.min_by(F.struct(*parts), "record_id").alias(name), F.count("*").alias(count))

    requests, metadata = side("request", "request", "n_requests"), side("metadata", "metadata", "n_metadata")
    met = main.join(requests, main.record_id == requests.request_of, "left").join(metadata, main.record_id == metadata.metadata_of, "left")
    zero = F.lit(0).cast("long")
    return met.select("capture", "request", "metadata", F.coalesce("n_requests", zero).alias("n_requests"), F.coalesce("n_metadata", zero).alias("n_metadata"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES, payloads: bool = False) -> DataFrame:
    """Write the pages' archives to shared storage, read them back and assemble them."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    largest = pages.agg(F.max(F.octet_length(html_col))).first()[0] or 0
    write(judge(pages, id_col, url_col, html_col, min_bytes), path, largest=largest)
    return assemble(read(spark, path, payloads))


def captures(assembled: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of assembled captures."""
    said = F.decode(F.col("metadata.payload"), "UTF-8")
    page, refers = (F.regexp_extract(said, f"(?:^|\n){k}: (-?[0-9]+)", 1) for k in ("pageId", "refersToPageId"))
    return assembled.select(F.when(page != "", page.cast("long")).alias("page_id"), F.col("capture.payload_bytes").alias("payload_bytes"), F.col("capture.payload_digest").alias("payload_digest"), F.col("capture.warc_type").alias("record_type"), F.when(refers != "", refers.cast("long")).alias("refers_to"), F.col("capture.digest_ok").alias("digest_ok"), F.col("capture.target_uri").alias("url"))
