"""Web archives in ZIP packages: stored WARC members with an index, read by ranges.

A package is a ZIP file whose members are stored, not compressed: one or more
WARC members (each record is a gzip member of its own) and one index per WARC
member with the place of every record. A reader needs the end of the package to
find the central directory, the index member, and then only the bytes of the
records it wants; nothing is extracted. Tasks write packages as files into the
shared folder and read them by seeking. Packages larger than 4 GB, or with more
than 65,535 members, use the ZIP64 directory; the reader takes either.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.rows import field, in_small_batches
from tallyloom.session import new_path, saved

# Fixed values of the formats.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
BIG32, BIG16 = 0xFFFFFFFF, 0xFFFF
WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
# Payloads below this many bytes are never revisits.
LEAST = 1000
# A package is closed when its records exceed this many bytes.
PACKAGE = 8 << 20

Fetch = Callable[[int, int], bytes]


def gzip_member(data: bytes, level: int = 3) -> bytes:
    coder = zlib.compressobj(level, zlib.DEFLATED, 31)
    return coder.compress(data) + coder.flush()


def warc_record(kind: str, uri: str, payload: bytes, headers: list[tuple[str, str]]) -> bytes:
    """One WARC record: header lines, an empty line, the block, two empty lines."""
    lines = [("WARC-Type", kind), ("WARC-Target-URI", uri), ("WARC-Date", DATE), *headers,
             ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(headers["content-length"])
    if len(rest) < size:
        raise ValueError("a record is cut short")
    return headers, rest[:size]


class Package:
    """Writes a ZIP file of stored members."""

    def __init__(self, zip64: bool = False) -> None:
        self.parts: list[bytes] = []
        self.size, self.members, self.zip64 = 0, [], zip64

    def add(self, name: str, data: bytes) -> None:
        raw, crc, start = name.encode(), zlib.crc32(data), self.size
        large = self.zip64 or len(data) >= BIG32
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if large else b""
        short = BIG32 if large else len(data)
        self._put(struct.pack("<4s5H3L2H", LOCAL, 45 if large else 20, 0x800, 0, 0, 33, crc, short, short, len(raw), len(extra)) + raw + extra)
        self._put(data)
        self.members.append((raw, crc, len(data), start))

    def _put(self, data: bytes) -> None:
        self.parts.append(data)
        self.size += len(data)

    def close(self) -> bytes:
        start = self.size
        for raw, crc, size, offset in self.members:
            large = self.zip64 or size >= BIG32 or offset >= BIG32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset) if large else b""
            self._put(struct.pack("<4s6H3L5H2L", CENTRAL, 45, 45 if large else 20, 0x800, 0, 0, 33, crc, BIG32 if large else size,
                                  BIG32 if large else size, len(raw), len(extra), 0, 0, 0, 0, BIG32 if large else offset) + raw + extra)
        length, count = self.size - start, len(self.members)
        if self.zip64 or start >= BIG32 or length >= BIG32 or count >= BIG16:
            at = self.size
            self._put(struct.pack("<4sQ2H2L4Q", END64, 44, 45, 45, 0, 0, count, count, length, start))
            self._put(struct.pack("<4sLQL", LOCATOR64, 0, at, 1))
            self._put(struct.pack("<4s4H2LH", END, 0, 0, BIG16, BIG16, BIG32, BIG32, 0))
        else:
            self._put(struct.pack("<4s4H2LH", END, 0, 0, count, count, length, start, 0))
        return b"".join(self.parts)


def directory(fetch: Fetch, size: int, with_others: bool = False):
    """(offset of the local header, length) of each stored member, from the central directory.

    ``with_others`` also gives the names of members that are not stored as they are.
    """
    tail_at = max(0, size - (22 + BIG16))
    tail = fetch(tail_at, size - tail_at)
    at = tail.rfind(END)
    # A note at the end may hold the mark itself: the right one is followed by exactly its note.
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a central directory")
    count, length, start = struct.unpack_from("<H2L", tail, at + 10)
    if BIG16 == count or BIG32 in (length, start):
        place = tail_at + at - 20
        locator = fetch(place, 20) if place >= 0 else b""
        if locator[:4] == LOCATOR64:
            end64 = fetch(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != END64:
                raise ValueError("no ZIP64 end of a central directory")
            count, length, start = struct.unpack_from("<3Q", end64, 32)
    table, out, others, at = fetch(start, length), {}, [], 0
    for _ in range(count):
        if table[at:at + 4] != CENTRAL:
            raise ValueError("a damaged central directory")
        flags, method = struct.unpack_from("<2H", table, at + 8)
        packed, whole = struct.unpack_from("<2L", table, at + 20)
        name_size, extra_size, note_size = struct.unpack_from("<3H", table, at + 28)
        offset = struct.unpack_from("<L", table, at + 42)[0]
        name = table[at + 46:at + 46 + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = table[at + 46 + name_size:at + 46 + name_size + extra_size], 0
        while k + 4 <= len(extra):
            kind, width = struct.unpack_from("<2H", extra, k)
            if kind == 1:
                # Only the fields that did not fit are there, in this order.
                values = iter(struct.unpack_from(f"<{width // 8}Q", extra, k + 4))
                whole = next(values) if whole == BIG32 else whole
                packed = next(values) if packed == BIG32 else packed
                offset = next(values) if offset == BIG32 else offset
            k += 4 + width
        if method == 0:
            out[name] = (offset, packed)
        else:
            others.append(name)
        at += 46 + name_size + extra_size + note_size
    return (out, others) if with_others else out


def member_start(fetch: Fetch, offset: int) -> int:
    """Where the bytes of a member begin: its local header has a length of its own."""
    head = fetch(offset, 30)
    if head[:4] != LOCAL:
        raise ValueError("no local header")
    name_size, extra_size = struct.unpack_from("<2H", head, 26)
    return offset + 30 + name_size + extra_size


def read_records(fetch: Fetch, size: int) -> Iterator[tuple[dict, dict[str, str], bytes]]:
    """(index entry, headers, block) of every indexed record, one range each.

    A WARC member that no stored index covers is an error: its records would be
    left out without a word.
    """
    members, skipped = directory(fetch, size, with_others=True)
    covered: set[str] = set()
    for name, (offset, length) in members.items():
        if not name.endswith(".cdxj"):
            continue
        lines = fetch(member_start(fetch, offset), length).splitlines()
        starts: dict[str, int] = {}
        for line in lines:
            entry = json.loads(line.split(b" ", 2)[2])
            home = entry["filename"]
            covered.add(home)
            if home not in members:
                raise ValueError(f"an index of {home}, which is no stored member")
            if home not in starts:
                starts[home] = member_start(fetch, members[home][0])
            if not 0 <= entry["offset"] <= entry["offset"] + entry["length"] <= members[home][1]:
                raise ValueError("an index entry outside its member")
            data = zlib.decompress(fetch(starts[home] + entry["offset"], entry["length"]), 31)
            yield entry, *parse_record(data)
    empty = {name for name, (_, length) in members.items() if not length}
    left = [n for n in [*members, *skipped] if n.endswith((".warc", ".warc.gz")) and n not in covered | empty]
    if left:
        raise ValueError(f"no stored index covers {left}")


def record_id(digest: str, ident: str) -> str:
    """The id of a record: the same page and payload have the same one, whoever writes it again."""
    return f"<urn:sha1:{hashlib.sha1(f'{digest} {ident}'.encode()).hexdigest()}>"


def _files(folder: str):
    """The file system of a folder and the folder's path in it, as tasks use them."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _write_file(folder: str, data: bytes) -> str:
    """Writes a package under the hash of its bytes; a task that runs twice writes the same file."""
    system, base = _files(folder)
    system.create_dir(base, recursive=True)
    name = f"{hashlib.sha1(data).hexdigest()}.zip"
    part = f"{base}/{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, f"{base}/{name}")
    return name


def _packed(limit: int, folder: str):
    def run(batches):
        package: list[bytes] = []
        index: list[str] = []
        size = 0

        def closed():
            out = Package()
            out.add(WARC, b"".join(package))
            out.add(INDEX, "".join(index).encode())
            data = out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{_write_file(folder, data)}"], pa.string()), pa.array([len(data)], pa.int64())], names=["path", "size"])

        for batch in batches:
            for ident, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                data = (payload or "").encode()
                uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
                headers = [("WARC-Record-ID", record_id(digest, "" if ident is None else str(ident))),
                           ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(data)))]
                headers += [] if ident is None else [("X-Page-Id", str(ident))]
                if first is not None:
                    headers += [("WARC-Refers-To", record_id(digest, str(first))), ("X-Refers-To-Page", str(first)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                kind = "response" if first is None else "revisit"
                record = gzip_member(warc_record(kind, uri, b"" if first is not None else data, headers))
                entry = {"url": uri, "digest": digest, "type": kind, "filename": WARC, "offset": size, "length": len(record)}
                index.append(f"{uri.replace(' ', '%20') or '-'} {DATE} {json.dumps(entry)}\n")
                package.append(record)
                size += len(record)
                if size >= limit:
                    yield closed()
                    package, index, size = [], [], 0
        if package:
            yield closed()

    return run


def write_packages(pages: DataFrame, ident: str = "page_id", url: str = "url", page: str = "html",
                   least: int = LEAST, limit: int = PACKAGE) -> DataFrame:
    """(path, size): ZIP packages with a record for each row, files in the shared folder.

    Of rows with equal payloads of at least ``least`` bytes the one with the
    largest id is a response and the others revisit it; rows that share that id
    are all responses. A null id revisits the largest id if there is one. Null
    pages have the empty payload. The rows keep their partitions; a package
    holds ``limit`` bytes of records and one more record at most. Other columns
    are ignored; an empty table gives no package.
    """
    in_small_batches(pages)
    payload = F.coalesce(field(pages, page), F.lit("")).cast("binary")
    rows = pages.select(field(pages, ident).cast("long").alias("ident"), field(pages, url).alias("url"),
                        field(pages, page).alias("page"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    again = rows.where(F.col("size") >= least).groupBy("digest").agg(F.max("ident").alias("first"), F.count("*").alias("n")).where(
        "n > 1 and first is not null").select(F.col("digest").alias("same"), "first")
    # Only payloads that repeat are listed, so the joined side is small unless most pages are copies.
    linked = rows.join(saved(again, "copies"), F.col("digest") == F.col("same"), "left")
    refers = F.when((F.col("ident") != F.col("first")) | F.col("ident").isNull(), F.col("first"))
    folder = new_path(pages.sparkSession, "archives")
    return saved(linked.select("ident", "url", "page", "digest", refers.alias("refers")).mapInArrow(_packed(limit, folder), "path string, size long"), "packages")


def _rows_of(fetch: Fetch, size: int) -> Iterator[tuple]:
    for entry, headers, block in read_records(fetch, size):
        ident, refers = headers.get("x-page-id"), headers.get("x-refers-to-page")
        kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and hashlib.sha1(block).hexdigest() != digest:
            raise ValueError(f"a payload does not match its digest: {entry}")
        yield (None if ident is None else int(ident), headers["warc-target-uri"], int(headers["x-payload-length"]), digest, kind,
               None if refers is None else int(refers), headers["warc-record-id"], headers.get("warc-refers-to"), block)


READ = ("id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "record_id string, refers_to_record string, block binary")
KINDS = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())


def _batches(rows: Iterator[tuple], most: int = 1000) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), KINDS)], names=[c.split()[0] for c in READ.split(", ")])


def _read_files(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, place = _files(path)
            with system.open_input_file(place) as file:
                yield from _batches(_rows_of(lambda start, length, file=file: file.read_at(length, start), file.size()))


def _read_contents(batches):
    for batch in batches:
        for content in batch.column(0).to_pylist():
            view = memoryview(content)
            yield from _batches(_rows_of(lambda start, length, view=view: bytes(view[start:start + length]), len(view)))


def read_package_files(files: DataFrame, path: str = "path") -> DataFrame:
    """(id, url, payload_bytes, payload_digest, record_type, refers_to, record_id, refers_to_record, block) of all records.

    ``files`` names packages by paths that every task can open, such as those
    that ``write_packages`` returns; packages are spread over tasks. A task
    seeks to the directory, to the index and to each record; a package of any
    size is never read whole. A damaged package, a WARC member without an index
    or a payload that does not match its digest stops the job. Null paths are
    left out.
    """
    named = files.select(field(files, path).alias("path")).where("path is not null")
    return named.repartition("path").mapInArrow(_read_files, READ)


def read_packages(packages: DataFrame, content: str = "content") -> DataFrame:
    """The rows of ``read_package_files`` from packages that are given as bytes, as Spark's binary file source does."""
    return packages.select(field(packages, content).alias("content")).where("content is not null").mapInArrow(_read_contents, READ)


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)
"""
