"""WARC archives with payloads as chunk rows.

Writing: a page is a response record, or a revisit record if a page with a
smaller id has the same payload.  A block above `segment_bytes` is written as
WARC segments (a first record and continuation records), one row each, so no row
holds a whole oversized record.  Spark's own text writer stores the rows, with
CRLF ends, on whatever store the path names; it makes one gzip stream per file.

Reading: each archive is streamed line by line, whoever wrote it.  Every payload
comes back as (record, chunk number) rows of at most `chunk_bytes`, each with the
digest of the payload up to its end, so that what is held is a chunk and a line
(text up to a line feed) and never a record.  Record bounds follow
Content-Length, so a payload may hold any bytes.  Gzipped archives are not split
by Spark's reader; others are, and their lines are put in order of file and place
again by an external sort, for one task per archive.

Odd inputs: a null html is the empty payload; a null or odd url is written
percent-escaped; a null page_id has no id header and comes back null; rows that
repeat the smallest id of a payload are all responses; an empty table gives an
archive without records; an archive cut short gives what it holds of its last
record, which is then not intact; lines outside of records are skipped.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_path, small_side, stored

SEGMENT_BYTES = 65_536
DATE = "2024-01-01T00:00:00Z"
HTTP = "application/http;msgtype=response"
SPACE = uuid.UUID("6f2f1d0e-6f0a-4d56-9f4f-1a7c2b3d4e5f")


def _record_id(page: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page}/{digest}')}>"


def _head(kind: str, record: str, length: int, **fields: object) -> str:
    rows = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record}", f"WARC-Date: {DATE}"]
    rows += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None]
    return "\r\n".join([*rows, f"Content-Length: {length}", "", ""])


def _cut(data: memoryview, at: int) -> int:
    """The last character bound up to `at`."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return min(at, len(data))


def _records(page: object, url: str, payload: memoryview, digest: str, first: object, segment: int) -> Iterator[bytes]:
    """The records of a page in UTF-8; the writer adds the last CRLF of each."""
    target = quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")
    common = {"WARC_Target_URI": target, "WARC_Payload_Digest": f"sha1:{digest}", "X_Page_ID": page}
    record = _record_id(page, digest)
    if first is not None and page != first:
        yield (_head("revisit", record, 0, **common, WARC_Refers_To=_record_id(first, digest), WARC_Profile="http://netpreserve.org/warc/1.0/revisit/identical-payload-digest") + "\r\n").encode()
        return
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = len(http) + len(payload)
    if block <= segment:
        yield b"".join((_head("response", record, block, **common, Content_Type=HTTP).encode(), http.encode(), payload, b"\r\n"))
        return
    at = _cut(payload, max(segment - len(http), 4))
    yield b"".join((_head("response", record, len(http) + at, **common, Content_Type=HTTP, WARC_Segment_Number=1).encode(), http.encode(), payload[:at], b"\r\n"))
    number = 2
    while at < len(payload):
        end = _cut(payload, at + segment)
        total = block if end == len(payload) else None
        own = _record_id(f"{page}#{number}", digest)
        yield b"".join((_head("continuation", own, end - at, WARC_Segment_Origin_ID=record, WARC_Segment_Number=number, WARC_Segment_Total_Length=total).encode(), payload[at:end], b"\r\n"))
        at, number = end, number + 1


def write_warc(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, compression: str = "gzip") -> None:
    """Write pages(page_id, url, html) to WARC files below path.

    Payload digests come from Spark's sha1; only digests that repeat are joined
    back, and broadcast if a count shows that they are few.
    """
    segment = max(segment_bytes, 64)
    html = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html")).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    again = hashed.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha1", "first")
    ready = hashed.join(small_side(stored(again, "digests")), "sha1", "left").select("page_id", "url", "html", "sha1", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for b in batches:
            for page, url, text, sha1, first in zip(*(b.column(i) for i in range(5)), strict=True):
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                for r in _records(page.as_py(), url.as_py(), memoryview(text.as_buffer()), digest, first.as_py(), segment):
                    held.append(r)
                    size += len(r)
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["record"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["record"])

    ready.mapInArrow(run, "record string").write.option("lineSep", "\r\n").option("compression", compression).text(path)


class _Parser:
    """Streaming reader of the lines of one archive after another.

    Rows are (archive, record_no, chunk_no, data, running digest, header).
    """

    def __init__(self, chunk_bytes: int) -> None:
        self.most = chunk_bytes
        self.archive: str | None = None
        self.record_no = -1
        self.header: dict[str, str] | None = None  # of the WARC record being read
        self.first: dict[str, str] = {}  # header of the payload's first segment
        self.left = -1  # bytes of the block still to come; -1: not in a block
        self.http = False  # inside the HTTP header of a block
        self.parts: list[bytes] = []
        self.held = self.chunk = 0
        self.sum = hashlib.sha1(usedforsecurity=False)

    def enter(self, archive: str | None) -> Iterator[tuple]:
        """Begin an archive (None: there is no other) with what the one before leaves."""
        if archive != self.archive:
            if self.left >= 0:
                yield from self._end()
            self.archive, self.record_no, self.header, self.left = archive, -1, None, -1

    def line(self, x: bytes) -> Iterator[tuple]:
        """Take one line (without its line feed); finished chunks come back."""
        if self.left < 0:
            x = x.removesuffix(b"\r")
            if self.header is None:
                if x.startswith(b"WARC/"):
                    self.header = {}
            elif x:
                k, _, v = x.partition(b":")
                self.header[k.decode(errors="replace").strip().lower()] = v.decode(errors="replace").strip()
            else:
                yield from self._begin()
            return
        ended = len(x) + 1 > self.left
        if self.http:
            self.http = x not in (b"", b"\r")  # an empty line ends the HTTP header
        elif ended:
            yield from self._add(x[: self.left])
        else:
            yield from self._add(x)
            yield from self._add(b"\n")
        self.left -= min(len(x) + 1, self.left)
        if not self.left:
            yield from self._end()

    def _begin(self) -> Iterator[tuple]:
        h = self.header
        self.left = int(h.get("content-length") or 0)
        if h.get("warc-type") != "continuation" or h.get("warc-segment-origin-id") != self.first.get("warc-record-id"):
            self.first, self.chunk, self.sum = h, 0, hashlib.sha1(usedforsecurity=False)
            self.record_no += 1
            self.http = h.get("content-type", "").startswith("application/http")
        if not self.left:
            yield from self._end()

    def _add(self, data: bytes) -> Iterator[tuple]:
        at = 0
        while self.held + len(data) - at >= self.most:
            end = at + self.most - self.held
            self.parts.append(data[at:end])
            at = end
            yield self._chunk()
        if at < len(data):
            self.parts.append(data[at:] if at else data)
            self.held += len(data) - at

    def _chunk(self) -> tuple:
        data = b"".join(self.parts)
        self.parts, self.held = [], 0
        self.sum.update(data)
        self.chunk += 1
        return self.archive, self.record_no, self.chunk - 1, data, base64.b32encode(self.sum.digest()).decode(), self.first

    def _end(self) -> Iterator[tuple]:
        if self.held or not self.chunk:  # an empty payload has one empty chunk
            yield self._chunk()
        self.header, self.left, self.http = None, -1, False


CHUNKS = "archive string, record_no long, record_id string, chunk_no int, data binary, n_bytes long, running_digest string, record_type string, page_id string, url string, payload_digest string, refers_to_record string"


def _in_order(spark: SparkSession, path: str) -> DataFrame:
    """Lines below path as (value, archive), each archive's in order in one partition."""

    def lines(glob: str) -> DataFrame:
        return spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(path)

    packed = lines("*.gz").select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("archive"))
    at = [F.col("_metadata.file_path").alias("archive"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")]
    plain = lines("{*[!z],*[!g]z,*[!.]gz}").select(F.col("value").cast("binary"), *at)
    plain = plain.repartition("archive").sortWithinPartitions("archive", "block", "row")
    return packed.unionByName(plain.select("value", "archive"))


def read_chunks(spark: SparkSession, path: str, with_data: bool = True, chunk_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The chunk table of the archives below path.

    archive and record_no name a record by its place; running_digest is the SHA-1
    of the payload through the end of the chunk; record_id, record_type, page_id,
    url, payload_digest and refers_to_record are the record's headers.
    """
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.int64(), *[pa.string()] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, rows, size = _Parser(chunk_bytes), [], 0

        def row(archive: str, record: int, chunk: int, data: bytes, digest: str, h: dict[str, str]) -> tuple:
            return (archive, record, h.get("warc-record-id"), chunk, data if with_data else None, len(data), digest, h.get("warc-type"), h.get("x-page-id"), h.get("warc-target-uri"), (h.get("warc-payload-digest") or "").removeprefix("sha1:"), h.get("warc-refers-to"))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for b in batches:
            for x, archive in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                for made in chain(parser.enter(archive), parser.line(x.as_py())) if archive != parser.archive else parser.line(x.as_py()):
                    rows.append(row(*made))
                    size += rows[-1][5]
                    if size > 1 << 20 or len(rows) >= 1000:
                        yield out()
                        rows, size = [], 0
        rows += [row(*made) for made in parser.enter(None)]
        if rows:
            yield out()

    return _in_order(spark, path).mapInArrow(run, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: headers, chunks, and bytes and digest of what was read.

    intact: a response's payload has the digest that its header claims.
    """
    last = F.max(F.struct("chunk_no", "running_digest"))
    heads = ["record_id", "record_type", "page_id", "url", "payload_digest", "refers_to_record"]
    out = chunks.groupBy("archive", "record_no").agg(*[F.first(c).alias(c) for c in heads], F.count("*").alias("n_chunks"), F.sum("n_bytes").alias("read_bytes"), last.alias("last"))
    read = F.col("last.running_digest")
    good = (F.col("record_type") != "response") | (read == F.col("payload_digest"))
    return out.select("archive", "record_no", *heads, "n_chunks", "read_bytes", read.alias("read_digest"), good.alias("intact"))


def resolved(found: DataFrame) -> DataFrame:
    """records() with payload_bytes, payload_digest and refers_to as read.

    A revisit has those of the response that it refers to, and that one's page.
    """
    found = stored(found, "warc-records")
    wanted = found.where("refers_to_record is not null").select(F.col("refers_to_record").alias("record_id")).distinct()
    target = found.where("record_type = 'response'").join(wanted, "record_id", "left_semi").dropDuplicates(["record_id"])
    target = stored(target.select(F.col("record_id").alias("_id"), F.col("read_bytes").alias("_bytes"), F.col("read_digest").alias("_digest"), F.col("page_id").alias("_page")), "warc-targets")
    both = found.join(small_side(target), F.col("refers_to_record") == F.col("_id"), "left")
    own = F.col("record_type") == "response"
    return both.select("record_id", "record_type", "page_id", "url", "n_chunks", "intact", F.when(own, F.col("read_bytes")).otherwise(F.col("_bytes")).alias("payload_bytes"), F.when(own, F.col("read_digest")).otherwise(F.col("_digest")).alias("payload_digest"), F.col("_page").alias("refers_to"))


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, compression: str = "gzip") -> DataFrame:
    """Write the pages to archives in the shared folder and read their records."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_warc(pages, path, segment_bytes, compression)
    return resolved(records(read_chunks(spark, path, with_data=False)))
