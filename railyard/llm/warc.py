"""ZIP-packaged web archives: written, then read by range (operator 9).

An archive is a ZIP file with two stored members: ``archive/data.warc.gz``
(WARC records, each a gzip member of its own) and ``indexes/index.cdx`` (one
line a record: place, packed length, page). The reader parses the end record,
the ZIP64 end record and the central directory itself, finds where the stored
members begin, reads the index, and then fetches records by byte range;
nothing is extracted.

Archives are files in a shared folder, named by URI and opened through
``pyarrow.fs`` (local or shared paths, object stores, HDFS). A writing task
names its files at random and lists them in its result, which Spark commits as
a Parquet manifest: files of a lost or repeated attempt are in no manifest.

Records: a payload of at least ``REVISIT_BYTES`` that others share is stored
once, with the largest page_id; the others are revisit records that name it.

Defined cases: a null html is an empty payload; a null url is written empty; a
null page_id counts as smaller than all others; repeated rows with the largest
page_id are all responses; payloads of any length are written whole; other
columns, also those named like the ones used here, are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm.common import written
from railyard.session import scratch_path

REVISIT_BYTES = 1000
#: Packed bytes after which a task begins its next archive.
ARCHIVE_BYTES = 32 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Fixed value: the profile of a revisit with the same payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"


# ------------------------------------------------------------------ records


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, gzip-packed. Revisits keep the HTTP header only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {RECORD_DATE}",
        "WARC-Target-URI: " + quote(url or "", safe=":/?#[]@!$&'()*+,;=%~"),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=4, mtime=0)


def parse_record(packed: bytes) -> dict:
    """Type, ids, digest and size of a record; a response's payload is checked."""
    raw = zlib.decompress(packed, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page = fields["WARC-Record-ID"].removeprefix("<urn:page:").rstrip(">")
    refers = fields.get("WARC-Refers-To", "").removeprefix("<urn:page:").rstrip(">")
    if fields["WARC-Type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
        raise ValueError(f"payload of page {page} does not match its digest")
    return {
        "page_id": int(page) if page else None,
        "url": fields["WARC-Target-URI"],
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(refers) if refers else None,
    }


# ---------------------------------------------------------------------- ZIP


class RangeReader:
    """Byte ranges of one file."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()

    def at(self, place: int, length: int) -> bytes:
        return self.file.read_at(length, place)

    def close(self) -> None:
        self.file.close()


def _ends(file: RangeReader) -> tuple[int, int, int]:
    """Number of members, size and place of the central directory."""
    tail_at = max(0, file.size - 65_557)
    tail = file.at(tail_at, file.size - tail_at)
    end = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end + 3)  # in a comment: look before it
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    count, size, place = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or size == 0xFFFFFFFF or place == 0xFFFFFFFF:
        locator = file.at(tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("ZIP64 locator missing")
        record = file.at(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("ZIP64 end record missing")
        count, size, place = struct.unpack_from("<QQQ", record, 32)
    return count, size, place


def members(file: RangeReader) -> dict[str, tuple[int, int]]:
    """Place and length of the bytes of every stored member, by name."""
    count, size, place = _ends(file)
    directory, at, found = file.at(place, size), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("central directory is broken")
        method, packed, length = struct.unpack_from("<10xH8xII", directory, at)
        names, extras, comment = struct.unpack_from("<HHH", directory, at + 28)
        (header,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + names].decode()
        extra = directory[at + 46 + names : at + 46 + names + extras]
        wide = [v for v in (length, packed, header) if v == 0xFFFFFFFF]
        if wide:
            values = iter(_zip64(extra, len(wide)))
            length, packed, header = (next(values) if v == 0xFFFFFFFF else v for v in (length, packed, header))
        if method == zipfile.ZIP_STORED:
            # The local header has name and extra lengths of its own.
            local = file.at(header, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError(f"local header of {name} is broken")
            found[name] = (header + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
        at += 46 + names + extras + comment
    return found


def _zip64(extra: bytes, n: int) -> tuple[int, ...]:
    at = 0
    while at + 4 <= len(extra):
        tag, length = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            return struct.unpack_from(f"<{n}Q", extra, at + 4)
        at += 4 + length
    raise ValueError("ZIP64 field missing")


class ArchiveWriter:
    """Streams records into one archive; ``close`` adds the index."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.sink = system.open_output_stream(f"{path}/{self.uri.rsplit('/', 1)[1]}")
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.bytes, self.index = 0, io.StringIO()
        self.records = 0

    def add(self, packed: bytes, page_id: int | None) -> None:
        self.data.write(packed)
        self.index.write(f"{self.bytes} {len(packed)} {'' if page_id is None else page_id}\n")
        self.bytes += len(packed)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), self.index.getvalue())
        self.zip.close()
        self.sink.close()
        return self.uri, self.records, self.bytes


def read_archive(uri: str) -> Iterator[dict]:
    """Every record of an archive, fetched by the ranges its index gives."""
    file = RangeReader(uri)
    try:
        found = members(file)
        data, _ = found[DATA]
        for line in file.at(*found[INDEX]).decode().splitlines():
            place, length, _ = line.split(" ")
            yield parse_record(file.at(data + int(place), int(length)))
    finally:
        file.close()


# -------------------------------------------------------------------- Spark


def with_record_type(pages: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to`` (null: response).

    Shared digests are found from small rows with map-side combine. Payloads
    that cannot be shared join on a key of their own, so that no group of
    short or empty pages meets in one task; a shared digest in a third of all
    rows is a skewed join, which Spark splits.
    """
    d = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    d = d.withColumn("payload_digest", F.sha1("payload"))
    d = d.withColumn("long", F.length("payload") >= min_bytes)
    shared = (
        d.where("long")
        .groupBy("payload_digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("keeper"))
        .where((F.col("n") > 1) & F.col("keeper").isNotNull())
        .select(F.col("payload_digest").alias("key"), "keeper")
    )
    own = F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    d = d.withColumn("key", F.when(F.col("long"), F.col("payload_digest")).otherwise(own))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return d.join(shared, "key", "left").select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``records`` (see with_record_type) and return the manifest:
    ``uri, records, bytes`` of every archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: ArchiveWriter | None = None
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                out = out or ArchiveWriter(folder)
                out.add(record_bytes(page_id, url, payload, digest, refers_to), page_id)
                if out.bytes >= archive_bytes:
                    yield _manifest(out.close())
                    out = None
        if out:
            yield _manifest(out.close())

    return written(records.mapInArrow(run, "uri string, records long, bytes long"), "manifest")


def _manifest(row: tuple[str, int, int]) -> pa.RecordBatch:
    return pa.record_batch([[v] for v in row], names=["uri", "records", "bytes"])


RECORD_DDL = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives in ``manifest``, one archive a task at a time."""
    names = [c.split(" ")[0] for c in RECORD_DDL.split(", ")]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        for r in rows:
            r["payload"] = r["payload"] if payloads else None
        return pa.record_batch([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            for uri in b.column(0).to_pylist():
                for row in read_archive(uri):
                    held.append(row)
                    if len(held) >= 256:
                        yield batch(held)
                        held = []
        yield batch(held)

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("uri").repartition(tasks, "uri").mapInArrow(run, RECORD_DDL)


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives, as a URI."""
    path = scratch_path(spark, "archives")
    if path.startswith("/"):
        return f"file://{path}"
    return re.sub("^file:/(?!/)", "file:///", path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages into archives and read the records back."""
    records = with_record_type(pages)
    manifest = write_archives(records, archive_folder(pages.sparkSession))
    return read_archives(manifest, payloads=False)
