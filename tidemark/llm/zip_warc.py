"""Web archives packaged as ZIP files: written per task, found again through the ZIP directories, read by ranges.

An archive holds two stored members: gzipped WARC records one after another, and an index of where each begins. A
reader takes the end of the file, the central directory it names (with its 64-bit forms), the index, and from then on
ranges of the record member alone; no archive is extracted or read whole by one task. Files are reached through
``pyarrow.fs``, so the folder may be on any store it knows by URI.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, bounded, small_batches

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Bytes after which a task begins another archive, of one range, and of the ranges that a task reads.
ARCHIVE_BYTES, RANGE_BYTES, READ_BYTES = 1 << 30, 4 << 20, 32 << 20
_DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RESPONSE, REVISIT = "response", "revisit"


def open_store(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as URI or absolute path."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", folder))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records


def _head(fields: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or with ``refers_to`` a revisit record without the payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    block = http + (payload if refers_to is None else b"")
    fields = [("WARC-Type", RESPONSE if refers_to is None else REVISIT), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>")]
    fields += [("WARC-Date", _DATE), ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""))]
    fields += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return b"WARC/1.1\r\n" + _head([*fields, ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


@dataclass
class Record:
    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def parse_record(data: bytes) -> Record:
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return Record(fields, _fields(http), payload)


def _page(reference: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", reference or "")
    return int(found[1]) if found else None


def _deflated(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# --- writing


class _Archive:
    """One ZIP file, written front to back and given its name when complete; no other attempt has that name."""

    def __init__(self, store: pafs.FileSystem, folder: str, name: str):
        self.store, self.target = store, f"{folder}/{name}"
        self.temporary = f"{folder}/.{name}"
        self.stream = store.open_output_stream(self.temporary)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index, self.size = io.StringIO(), 0

    def add(self, data: bytes) -> None:
        packed = _deflated(data)
        self.member.write(packed)
        self.index.write(f"{self.size} {len(packed)}\n")
        self.size += len(packed)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), self.index.getvalue())
        self.zip.close()
        self.stream.close()
        self.store.move(self.temporary, self.target)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, records): writes ``pages`` (page_id, url, html, refers_to) below ``folder``, one archive a task or more.

    Archives are named by the attempt that wrote them, and the rows are those of the attempts that count. Rows may come to
    an attempt in another order than to the one before it; archives of one that was lost are in no row.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        attempt, done, archive, records = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}", [], None, 0
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if archive is None:
                    name, records = f"part-{attempt}-{len(done):04d}.wacz.zip", 0
                    archive = _Archive(store, root, name)
                archive.add(record(page_id, url, (html or "").encode("utf-8"), refers_to))
                records += 1
                if archive.size >= archive_bytes:
                    archive.close()
                    done.append((name, records))
                    archive = None
        if archive is not None:
            archive.close()
            done.append((name, records))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["archive", "records"])

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(write, "archive string, records long")


# --- ZIP directories


@dataclass
class Member:
    name: str
    method: int
    packed: int
    size: int
    header: int


_END, _END64, _LOCATOR, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def directory(read, size: int) -> dict[str, Member]:
    """Members by name. ``read(offset, length)`` returns bytes; only the tail and the directory are read."""
    tail_at = max(0, size - 65557 - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END)
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == _LOCATOR:
        end64 = read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack_from("<QQQ", end64, 32)
    raw, members, at = read(offset, length), {}, 0
    for _ in range(count):
        if raw[at : at + 4] != _ENTRY:
            raise ValueError("damaged central directory")
        method = struct.unpack_from("<H", raw, at + 10)[0]
        packed, whole, n, extra, comment = struct.unpack_from("<IIHHH", raw, at + 20)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + n].decode("utf-8", "replace")
        more, k = raw[at + 46 + n : at + 46 + n + extra], 0
        while k + 4 <= len(more):
            kind, m = struct.unpack_from("<HH", more, k)
            if kind == 1:  # 64-bit values, of the fields that are full
                values = iter(struct.unpack_from(f"<{m // 8}Q", more, k + 4))
                whole = next(values) if whole == 0xFFFFFFFF else whole
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            k += 4 + m
        members[name] = Member(name, method, packed, whole, header)
        at += 46 + n + extra + comment
    return members


def stored_at(read, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is not stored")
    head = read(member.header, 30)
    if head[:4] != _LOCAL:
        raise ValueError(f"{member.name} has no local header")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


# --- reading


def record_ranges(archives: DataFrame, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(archive, start, lengths): runs of records of about ``range_bytes`` bytes, from the indexes inside the archives."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{root}/{name}") as file:
                    read = lambda at, n: file.read_at(n, at)
                    members = directory(read, file.size())
                    base = stored_at(read, members[DATA])
                    lines = read(stored_at(read, members[INDEX]), members[INDEX].size).split(b"\n")
                runs: list[tuple[int, list[int]]] = []
                for line in filter(None, lines):
                    at, n = map(int, line.split())
                    if not runs or sum(runs[-1][1]) >= range_bytes:
                        runs.append((base + at, []))
                    runs[-1][1].append(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(runs)), pa.array([r[0] for r in runs], pa.int64()), pa.array([r[1] for r in runs], pa.list_(pa.int64()))],
                    names=["archive", "start", "lengths"],
                )

    return archives.select("archive").mapInArrow(index, "archive string, start long, lengths array<long>")


def _spread(ranges: DataFrame) -> DataFrame:
    """The ranges over as many tasks as their bytes ask for: the rows that say where to read are few and small."""
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    told = ranges.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    at_once = ranges.sparkSession.sparkContext.defaultParallelism
    return ranges.repartition(max(1, min(told["n"], max(at_once, -(-told["bytes"] // READ_BYTES)))))


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read_records(ranges: DataFrame, folder: str) -> DataFrame:
    """The records of all ranges. A response's size and digest are those of the payload read, which must agree with its
    header; a revisit's are the ones it was written with."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for name, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(f"{root}/{name}") as file:
                    data = file.read_at(sum(lengths), start)
                rows, at = [], 0
                for n in lengths:
                    one = parse_record(zlib.decompress(data[at : at + n], 31))
                    at += n
                    stated = one.fields["warc-payload-digest"].removeprefix("sha1:")
                    kind = one.fields["warc-type"]
                    if kind == RESPONSE and digest(one.payload) != stated:
                        raise ValueError(f"{name}: payload of {one.fields['warc-record-id']} is damaged")
                    size = len(one.payload) if kind == RESPONSE else int(one.http["content-length"])
                    rows.append((_page(one.fields["warc-record-id"]), size, stated, kind, _page(one.fields.get("warc-refers-to")), one.fields["warc-target-uri"]))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[x.split()[0] for x in RECORD.split(", ")])

    return ranges.mapInArrow(read, RECORD)


def with_originals(pages: DataFrame, scratch: Scratch, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) and ``refers_to``: the largest page_id with the same payload, null on that page itself.

    Payloads below ``min_bytes`` refer to none. Pages without an id refer to the largest id, or to none if no page of the
    payload has one.
    """
    rows = pages.withColumn("__sha", F.sha1(F.col("html").cast("binary")))
    groups = rows.where(F.octet_length("html") >= min_bytes).groupBy("__sha").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    groups = scratch.keep(groups.where("n > 1 and first is not null").drop("n"))
    joined = rows.join(bounded(groups), "__sha", "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def archive_pages(
    pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write ``pages`` to archives and read them back: one row per page as in RECORD.

    Without a ``folder`` the archives go below the shared working folder. Null html is an empty payload, null urls are
    empty, white space and control characters in urls are percent-encoded. Repeated rows are written each; those of the
    largest page_id are all responses. Other columns are not archived. An empty table writes no archive.
    """
    small_batches(pages.sparkSession)
    scratch = Scratch(pages.sparkSession, "archives")
    folder = folder or f"{scratch.folder}/files"
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html")
    )
    archives = scratch.keep(write_archives(with_originals(rows, scratch, min_bytes), folder, archive_bytes))
    ranges = scratch.keep(record_ranges(archives, folder))
    return read_records(_spread(ranges), folder)
