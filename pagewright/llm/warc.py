r"""WARC archives: writing, reading, and transaction assembly.

Writing gives each page a response record (or a revisit, if a page with an equal payload and a
smaller page_id exists), a request and a metadata record, tied together by concurrent-to
identifiers; a revisit refers to its response's record by that one's identifier. Identifiers are
hashes of page_id, url, payload digest and the number of the copy, so a rerun gives the same ones.
Roles are found on digests alone; payloads go through one shuffle, by those hashes, in which rows
that repeat combine first, and no page waits for another one's payload.

Each record is a gzip member of its own. Spark's text writer puts blocks of members into files in
any file system that Spark reaches, a task's files being committed as a whole. Its line ends are a
single zero byte, and a zero is what a gzip member of nothing ends with; so each block closes with
such a member, short of its last byte. Files are cut by blocks, that is by bytes.

Reading inflates each file as a stream and parses it by Content-Length. Assembly joins request and
metadata records to their response or revisit record through the concurrent-to identifiers and
gives one nested row per capture.

Defined cases: null html is an empty payload; a null or empty url leaves the target out; line ends
and other control characters in urls are percent-encoded; a null page_id refers to no page, so its
record is a response only if no page has that payload; rows that repeat a page_id with the same
payload are responses alike; an empty table gives archives without records and an empty result;
further columns have no influence; payloads of any length are kept whole. Payloads below least
bytes are never revisits.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, pick, salted_join, shared_path, small_batches

#: Compressed bytes of a block of records, at least (but the last of a task), and blocks of a file.
BLOCK_BYTES, FILE_BLOCKS = 1 << 19, 64
#: How hard records are compressed; a page is small and its members many.
LEVEL = 2
#: Bytes that are inflated at once, and bytes of payloads of a batch that is read.
INFLATE_BYTES, BATCH_BYTES = 1 << 20, 1 << 23
END = "\r\n"
# Fixed value: the profile of a revisit whose payload is identical.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """Base32 of the SHA-1, upper case: conv() to base 32 by 40 bits, then its digits replaced."""
    hexed = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", B32)


def _uuid(*parts: Column) -> Column:
    """A record identifier from the MD5 of parts, none of which may be null."""
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in ([F.lit("-")] if a > 1 else []) + [F.substring(h, a, n)]], F.lit(">"))


def _record(kind: Column | str, headers: list[tuple[str, Column]], content: Column, kind_of_content: str) -> Column:
    """A whole record. Headers that are null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in [("WARC-Type", kind), *headers, ("WARC-Date", F.lit(DATE)), ("Content-Type", F.lit(kind_of_content)), ("Content-Length", F.octet_length(content).cast("string"))]]
    return F.concat(F.concat_ws(END, F.lit("WARC/1.1"), *lines), F.lit(END * 2), content, F.lit(END * 2))


def with_roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """key, page_id, url, html, payload_bytes, payload_digest; copies, the number of rows that are
    equal in all that; and response_id and response_key of the least page with that payload (null:
    the page itself is it, or no page with an id is)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": payload_digest(F.col("html"))})
    told = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("page_id", "url", "payload_bytes", "payload_digest")]
    rows = rows.withColumn("key", F.md5(F.concat_ws("|", *told)))
    small = durable(rows.groupBy("key", "payload_digest", "payload_bytes", "page_id").agg(F.count("*").alias("copies")), "warc-roles")
    with_id = F.when(F.col("page_id").isNotNull(), F.struct(F.col("page_id").alias("response_id"), F.col("key").alias("response_key")))
    payload = ["payload_digest", "payload_bytes"]
    first = small.filter(F.col("payload_bytes") >= least).groupBy(*payload).agg(F.min(with_id).alias("first"))
    roles = salted_join(small, first, payload, F.xxhash64("key")).select("key", "copies", "first.response_id", "first.response_key")
    unique = rows.groupBy("key").agg(*[F.first(c).alias(c) for c in ("page_id", "url", "html", *payload)])
    return unique.join(roles, "key")


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """value: one WARC record per row, three for each page."""
    rows = with_roles(pages, least).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    is_revisit = F.coalesce(~F.col("response_id").eqNullSafe(F.col("page_id")) & F.col("response_id").isNotNull(), F.lit(False))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    unsafe = F.regexp_replace(F.trim("url"), r"[\x00-\x20\x7F]", "%20")
    target = F.when(F.length(unsafe) > 0, unsafe)
    own = {k: _uuid(F.lit(k), F.col("key"), F.col("copy").cast("string")) for k in ("capture", "request", "metadata")}
    response = F.when(is_revisit, _uuid(F.lit("capture"), F.col("response_key"), F.lit("1")))
    rows = rows.select("html", "payload_bytes", "payload_digest", response.alias("response"), is_revisit.alias("revisit"), page.alias("page"), target.alias("target"), *[v.alias(k) for k, v in own.items()])
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END * 2))
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    capture = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        [
            ("WARC-Record-ID", F.col("capture")),
            ("WARC-Target-URI", F.col("target")),
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))),
            ("WARC-Refers-To", F.col("response")),
        ],
        F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html"))),
        "application/http; msgtype=response",
    )
    path = F.coalesce(F.regexp_extract("target", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1), F.lit(""))
    request = _record(
        "request",
        [("WARC-Record-ID", F.col("request")), ("WARC-Concurrent-To", F.col("capture")), ("WARC-Target-URI", F.col("target"))],
        F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(f" HTTP/1.1{END * 2}")),
        "application/http; msgtype=request",
    )
    metadata = _record(
        "metadata",
        [("WARC-Record-ID", F.col("metadata")), ("WARC-Concurrent-To", F.col("capture")), ("WARC-Target-URI", F.col("target"))],
        F.concat(F.lit("page_id: "), F.col("page"), F.lit(f"{END}payload_bytes: "), F.col("payload_bytes").cast("string"), F.lit(END)),
        "application/warc-fields",
    )
    return rows.select(F.explode(F.array(capture, request, metadata)).alias("value"))


#: A gzip member of nothing; its last byte is zero.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of gzip members, one member a record."""
    held, size = [], 0
    for batch in batches:
        for record in batch.column(0):
            held.append(gzip.compress(record.as_buffer(), compresslevel=LEVEL, mtime=0))
            size += len(held[-1])
            if size >= BLOCK_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join([*held, EMPTY_MEMBER[:-1]])], pa.binary())], names=["value"])
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join([*held, EMPTY_MEMBER[:-1]])], pa.binary())], names=["value"])


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """Writes pages (page_id, url, html) as gzip-compressed WARC files into the folder path."""
    small_batches(pages.sparkSession)
    blocks = records(pages, least).select(F.col("value").cast("binary")).mapInArrow(_blocks, "value binary")
    blocks.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", FILE_BLOCKS).text(path)


def inflated(data: memoryview) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, in parts; other data as it is."""
    if bytes(data[:2]) != b"\x1f\x8b":
        yield from (bytes(data[i : i + INFLATE_BYTES]) for i in range(0, len(data), INFLATE_BYTES))
        return
    at, member = 0, zlib.decompressobj(31)
    while at < len(data):
        piece = data[at : at + 65_536]
        at += len(piece)
        while piece:
            yield member.decompress(piece, INFLATE_BYTES)
            piece = member.unconsumed_tail
        while not member.eof and (more := member.decompress(b"", INFLATE_BYTES)):
            yield more
        if member.eof:
            at -= len(member.unused_data)
            member = zlib.decompressobj(31)


class Feed:
    """Bytes that come in parts, taken by count or up to a mark."""

    def __init__(self, parts: Iterator[bytes]) -> None:
        self.parts, self.held, self.taken = parts, bytearray(), 0

    def more(self) -> bool:
        part = next(self.parts, None)
        if part is not None:
            self.held += part
        return part is not None

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        if len(self.held) < n:
            raise ValueError(f"a WARC record ends early, after byte {self.taken}")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.taken += n
        return out

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the mark, which goes too; None at the end."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark))
            if not self.more():
                return None
        return self.take(at + len(mark))[:at]

    def skip(self, mark: bytes) -> None:
        while True:
            while len(self.held) < len(mark) and self.more():
                pass
            if not self.held.startswith(mark):
                return
            self.take(len(mark))


def parsed(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and content of each record of an uncompressed archive."""
    feed = Feed(parts)
    while (head := feed.until(b"\r\n\r\n")) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record before byte {feed.taken}")
        fields = {}
        for line in head.decode().split(END)[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, feed.take(int(fields["content-length"]))
        feed.skip(b"\r\n")
    if feed.held:
        raise ValueError(f"no WARC record at byte {feed.taken}")


RECORD = "record_id string, type string, concurrent_to string, target string, refers_to string, payload_digest string, payload_bytes long, page string, headers map<string,string>, payload string"
_KINDS = pa.schema(
    [(n, pa.string()) for n in ("record_id", "type", "concurrent_to", "target", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("page", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.string())]
)


def _read(payloads: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def row(fields: dict[str, str], content: bytes) -> tuple:
        kind, digest, size, page, payload = fields.get("warc-type"), None, None, None, None
        if kind in ("response", "revisit"):
            payload = content.partition(b"\r\n\r\n")[2]
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
            if kind == "response":
                size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if digest not in (None, found):
                    raise ValueError(f"{fields.get('warc-record-id')}: the payload's digest is {found}, not {digest}")
                digest = found
        elif kind == "metadata":
            told = dict(line.partition(": ")[::2] for line in content.decode().split(END) if line)
            page, size = told.get("page_id"), int(told["payload_bytes"]) if "payload_bytes" in told else None
        text = payload.decode("utf-8", "replace") if payloads and payload is not None else None
        headers = list(fields.items()) if payloads else None
        return fields.get("warc-record-id"), kind, fields.get("warc-concurrent-to"), fields.get("warc-target-uri"), fields.get("warc-refers-to"), digest, size, page, headers, text

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _KINDS, strict=True)], schema=_KINDS)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, found in parsed(inflated(memoryview(content.as_buffer()))):
                    rows.append(row(fields, found))
                    size += len(found) if payloads else 0
                    if len(rows) >= 1000 or size >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return each


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archive files in a folder that Spark reads. A task's files have
    spark.sql.files.maxPartitionBytes together, or are one file."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read(payloads), RECORD)


def assembled(found: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, capture, request, metadata (structs).

    The three kinds meet by the identifier of the capture, in one shuffle; an identifier is a
    record's own, so no group is large. A capture without request or metadata has null there.
    """
    key = F.when(F.col("type").isin("response", "revisit"), F.col("record_id")).otherwise(F.col("concurrent_to"))
    keyed = found.filter(F.col("type").isin("response", "revisit", "request", "metadata")).withColumn("id", key)
    whole = F.struct(*found.columns)
    side = {kind: keyed.filter(F.col("type") == kind).select("id", whole.alias(kind)) for kind in ("request", "metadata")}
    captures = keyed.filter(F.col("type").isin("response", "revisit")).select("id", whole.alias("capture"))
    return captures.join(side["request"], "id", "left").join(side["metadata"], "id", "left").select(F.col("id").alias("record_id"), "capture", "request", "metadata")


def warc_report(pages: DataFrame, least: int = 0, path: str | None = None) -> DataFrame:
    """Writes pages as archives, reads them back and gives page_id, payload_bytes, payload_digest,
    record_type and refers_to of each capture."""
    spark = pages.sparkSession
    folder = path or shared_path(spark, "warc")
    write_archives(pick(pages, "page_id", "url", "html"), folder, least)
    rows = assembled(durable(read_records(spark, folder, payloads=False), "warc-records")).select(
        F.when(F.col("metadata.page") != "null", F.col("metadata.page")).cast("long").alias("page_id"),
        F.coalesce("capture.payload_bytes", "metadata.payload_bytes").alias("payload_bytes"),
        F.col("capture.payload_digest").alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        "record_id",
        F.col("capture.refers_to").alias("response"),
    )
    captures = durable(rows, "warc-captures")
    responses = captures.filter("record_type = 'response'")
    target = responses.select(F.col("record_id").alias("response"), F.col("page_id").alias("refers_to"))
    revisits = salted_join(captures.filter("record_type = 'revisit'"), target, ["response"], F.xxhash64("record_id"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*names).unionByName(revisits.select(*names))


OP6_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, h FROM p),
s AS (SELECT page_id, n, h, sha1(h) AS x FROM d),
bits AS (
  SELECT page_id, n, h, x,
         array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + CAST((CAST(('0x' || substr(x, 1 + 10 * CAST(floor(i / 8) AS INTEGER), 10)) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)), '') AS b32
  FROM s),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS low FROM bits)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = low THEN NULL ELSE low END AS refers_to
FROM g
"""
