"""WARC archives as seekable Zstandard bundles, with revisit records for payloads that occur again.

A bundle is a file of independent Zstandard frames.  Each frame holds whole WARC
records, as many as fill ``frame_bytes`` (a larger record has a frame of its own).
The file ends with a seek table, a skippable frame by which any Zstandard reader passes over
it: for each frame its compressed and its whole size, then the number of frames and a
magic number, so that a reader finds the table from the file's last nine bytes and a
frame's place by summing the sizes before it.  The index maps each record identifier to
its bundle, frame, and offset and length within the frame: one record is read by
decompressing one frame.

Of records with equal payloads (by SHA-256) of at least ``min_payload`` bytes the one with the greatest
id is a response; the others are revisits: they keep the HTTP header, which
names the payload's size, and its digest, and refer to the response by its record
identifier.  Which record that is comes from one aggregation by payload hash; hot groups
of equal payloads are joined by a broadcast of bounded size, others by shuffling, so no task
gets all copies of a frequent page.

Record identifiers are UUIDs (version 8) of the page id and a hash of the URL and payload, so every task can
name a record that another task writes, and the page id can be read from them.

Each task writes the rows it has, frame by frame, and starts a new bundle after
``bundle_bytes``; bundles have names of their own attempt, and only those of
tasks that ended are in the index, so an attempt lost with its executor leaves nothing
that is read.

Defined cases: a null payload is an empty one; a null URL is written as an empty one;
null ids come before all others, and are kept; rows of one greatest id
are ordered by URL, and rows equal in id, URL and payload are the same record written
again (all responses, or all revisits, under one identifier); an empty table gives
an empty index and no bundle; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored, workers_import
from strata.llm.hot_groups import join_groups

# Fixed values of the Zstandard seekable format: a skippable frame's magic number, the seek table's, and its descriptor
# (no checksums: each frame has its own).
SKIPPABLE, SEEKABLE, DESCRIPTOR = 0x184D2A5E, 0x8F92EAB1, 0
# Fixed values of WARC 1.1.
VERSION, PROFILE = b"WARC/1.1", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, bundle string, frame int, offset long, length long"
RECORD = ("record_id string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to_record string, refers_to long, payload binary")
RECORD_ARROW = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                          ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_record", pa.string()),
                          ("refers_to", pa.int64()), ("payload", pa.binary())])
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 1 << 30


# --- records -----------------------------------------------------------------------------------------------------

def record_id(page_id: int | None, url: str, key: bytes) -> str:
    """UUID of version 8: 64 bits of the page id, a bit that says if there is one, 57 bits of a hash."""
    number = (page_id or 0) & (1 << 64) - 1
    rest = int.from_bytes(hashlib.sha256(key + url.encode()).digest()[:8], "big") >> 7
    low = (number & 15) << 58 | (page_id is not None) << 57 | rest
    return f"urn:uuid:{uuid.UUID(int=(number >> 16) << 80 | 8 << 76 | (number >> 4 & 0xFFF) << 64 | 2 << 62 | low)}"


def page_of(identifier: str) -> int | None:
    """The page id within a record identifier."""
    u = uuid.UUID(identifier.removeprefix("urn:uuid:")).int
    if not u >> 57 & 1:
        return None
    number = u >> 80 << 16 | (u >> 64 & 0xFFF) << 4 | u >> 58 & 15
    return number - (1 << 64) if number >> 63 else number


def digest_of(payload: bytes) -> bytes:
    return base64.b32encode(hashlib.sha1(payload).digest())


def _line(value: str) -> bytes:
    """A header value; line ends and other control characters, which would end it, are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value.strip(" ")).encode()


def _record(kind: bytes, identifier: str, date: bytes, more: Sequence[tuple[bytes, bytes]], block: bytes) -> bytes:
    head = [(b"WARC-Type", kind), (b"WARC-Record-ID", b"<" + identifier.encode() + b">"), (b"WARC-Date", date), *more,
            (b"Content-Length", b"%d" % len(block))]
    return b"\r\n".join([VERSION, *(k + b": " + v for k, v in head), b"", block]) + b"\r\n\r\n"


def page_record(page_id: int | None, url: str, payload: bytes, key: bytes, date: bytes, refers_to: str | None) -> tuple[str, bytes]:
    """(record identifier, record) of a page; a revisit if ``refers_to`` names a response."""
    own = record_id(page_id, url, key)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    more = [(b"WARC-Target-URI", _line(url)), (b"WARC-Payload-Digest", b"sha1:" + digest_of(payload)),
            (b"Content-Type", b"application/http; msgtype=response")]
    if refers_to is None:
        return own, _record(b"response", own, date, more, http + payload)
    more += [(b"WARC-Profile", PROFILE), (b"WARC-Refers-To", b"<" + refers_to.encode() + b">"), (b"WARC-Truncated", b"length")]
    return own, _record(b"revisit", own, date, more, http)


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(header fields by lower-case name, block, end) of the record at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:stop].split(b"\r\n")
    if first != VERSION:
        raise ValueError(f"no record at {at}")
    head = {k.lower(): v for k, v in (line.decode().split(": ", 1) if b": " in line else (line.decode().rstrip(":"), "") for line in lines)}
    begin = stop + 4
    end = begin + int(head["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} does not end where it says")
    return head, data[begin:end], end + 4


def page_row(head: dict[str, str], block: bytes) -> dict:
    """A page's record as a row; a response's digest and size are taken from its payload and must agree with its header."""
    http, payload = block.split(b"\r\n\r\n", 1)
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest, own, response = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-record-id"][1:-1], head["warc-type"] == "response"
    if response and (len(payload), digest_of(payload).decode()) != (size, digest):
        raise ValueError(f"{own}: the payload is not what its header says")
    refers = None if response else head["warc-refers-to"][1:-1]
    return {"record_id": own, "page_id": page_of(own), "url": head["warc-target-uri"], "record_type": head["warc-type"], "payload_bytes": size,
            "payload_digest": digest, "refers_to_record": refers, "refers_to": refers and page_of(refers), "payload": payload if response else None}


# --- bundles -----------------------------------------------------------------------------------------------------

class BundleWriter:
    """Frames of whole records to an open stream, then the seek table."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.out, self.frame_bytes = out, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self.sizes: list[tuple[int, int]] = []  # compressed and whole size of each frame
        self.held: list[bytes] = []
        self.length = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset within it of a record."""
        if self.held and self.length + len(record) > self.frame_bytes:
            self.end_frame()
        place = len(self.sizes), self.length
        self.held.append(record)
        self.length += len(record)
        return place

    def end_frame(self) -> None:
        if self.held:
            frame = self.compress(b"".join(self.held))
            self.out.write(frame)
            self.sizes.append((len(frame), self.length))
            self.written += len(frame)
            self.held, self.length = [], 0

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), DESCRIPTOR, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Frames of a bundle, found by its seek table."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        if size < 17:
            raise ValueError("no seek table")
        file.seek(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", file.read(9))
        entry = 12 if descriptor & 128 else 8  # with checksums
        whole = 8 + n * entry + 9
        if magic != SEEKABLE or whole > size:
            raise ValueError("no seek table")
        file.seek(size - whole)
        table = file.read(whole - 9)
        if struct.unpack_from("<II", table) != (SKIPPABLE, whole - 8):
            raise ValueError("no seek table")
        self.places, at = [], 0
        for i in range(n):
            packed, length = struct.unpack_from("<II", table, 8 + i * entry)
            self.places.append((at, packed, length))
            at += packed
        self.unpack = zstandard.ZstdDecompressor().decompress

    def __len__(self) -> int:
        return len(self.places)

    def frame(self, i: int) -> bytes:
        at, packed, length = self.places[i]
        self.file.seek(at)
        return self.unpack(self.file.read(packed), max_output_size=length)


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- jobs --------------------------------------------------------------------------------------------------------

def with_references(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
                    min_payload: int = 0) -> DataFrame:
    """page_id, url, payload, key (SHA-256 of the payload), and of a revisit the response's ``to_id`` and ``to_url``."""
    text = F.coalesce(F.col(payload), F.lit("" if dict(pages.dtypes)[payload] == "string" else b""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
                        text.cast("binary").alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    place = F.struct(F.col("page_id").isNotNull().alias("some"), "page_id", "url")
    groups = rows.where(F.octet_length("payload") >= min_payload).groupBy("key").agg(
        F.count(F.lit(1)).alias("count"), F.max(place).alias("to")).where("count > 1")
    joined = join_groups(rows, stored(groups, "payloads"), "key", "count", ["to"], counted=rows)
    revisit = F.col("to").isNotNull() & ~(F.col("to") == place)
    return joined.select("page_id", "url", "payload", "key", revisit.alias("revisit"), F.when(revisit, F.col("to.page_id")).alias("to_id"),
                         F.when(revisit, F.col("to.url")).alias("to_url"))


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", min_payload: int = 0,
          date: datetime | None = None, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = 3) -> DataFrame:
    """Write the pages as bundles below ``path``/bundles and the index of their records as ``path``/index; returns the index."""
    workers_import(pages.sparkSession)
    stamp = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ").encode()

    def write_bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(f"{path}/bundles")
        writer, name = None, ""
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    if writer is None:
                        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
                        store.create_dir(root, recursive=True)
                        writer = BundleWriter(store.open_output_stream(f"{root}/{name}", compression=None), frame_bytes, level)
                        info = b"software: strata\r\nformat: WARC File Format 1.1\r\n"
                        writer.add(_record(b"warcinfo", f"urn:uuid:{uuid.uuid4()}", stamp, [
                            (b"WARC-Filename", name.encode()), (b"Content-Type", b"application/warc-fields")], info))
                        writer.end_frame()
                    key = row["key"].encode()
                    to = record_id(row["to_id"], row["to_url"], key) if row["revisit"] else None
                    own, record = page_record(row["page_id"], row["url"], row["payload"], key, stamp, to)
                    frame, offset = writer.add(record)
                    index.append({"record_id": own, "bundle": name, "frame": frame, "offset": offset, "length": len(record)})
                    if writer.written >= bundle_bytes:
                        writer.close()
                        writer = None
                yield pa.RecordBatch.from_pylist(index, schema=pa.schema([
                    ("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
        finally:
            if writer is not None:
                writer.close()

    spark = pages.sparkSession
    rows = with_references(pages, page_id, url, payload, min_payload)
    rows.mapInArrow(write_bundles, INDEX).write.parquet(f"{path}/index")
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def read(spark: SparkSession, path: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles that ``index`` names, frame by frame; without ``payloads`` these are checked and left out."""
    workers_import(spark)

    def read_bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(f"{path}/bundles")
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{root}/{name}") as file:
                    bundle = BundleReader(file)
                    for i in range(len(bundle)):
                        data, at, rows = bundle.frame(i), 0, []
                        while at < len(data):
                            head, block, at = parse(data, at)
                            if head["warc-type"] != "warcinfo":
                                row = page_row(head, block)
                                rows.append(row if payloads else row | {"payload": None})
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)

    bundles = index.select("bundle").distinct()
    return bundles.repartition(max(1, bundles.count())).mapInArrow(read_bundles, RECORD)


def lookup(path: str, wanted: DataFrame, index: DataFrame) -> DataFrame:
    """The records named by ``wanted.record_id``: each read from its own frame, one decompression for neighbours in it."""
    workers_import(index.sparkSession)

    def read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(f"{path}/bundles")
        name = at = bundle = data = None
        file = None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["bundle"] != name:
                    if file is not None:
                        file.close()
                    file = store.open_input_file(f"{root}/{r['bundle']}")
                    name, at, bundle = r["bundle"], None, BundleReader(file)
                if r["frame"] != at:
                    at, data = r["frame"], bundle.frame(r["frame"])
                head, block, end = parse(data, r["offset"])
                if end - r["offset"] != r["length"] or head["warc-record-id"][1:-1] != r["record_id"]:
                    raise ValueError(f"{r['record_id']} is not where the index says")
                rows.append(page_row(head, block))
            yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)
        if file is not None:
            file.close()

    places = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    return places.select("record_id", "bundle", "frame", "offset", "length").sortWithinPartitions(
        "bundle", "frame", "offset").mapInArrow(read_records, RECORD)


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
d AS (SELECT *, CAST(octet_length(encode(html)) AS BIGINT) AS bytes, sha1(html) AS h FROM p)
SELECT page_id, bytes AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = last OR last IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < last OR page_id IS NULL THEN last END AS refers_to
FROM d
"""
