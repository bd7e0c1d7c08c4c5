"""Web archives packed as ZIP files: written by tasks, read by range without unpacking.

An archive holds a stored (uncompressed) member ``archive/data.warc.gz``, one gzip stream per WARC record, and a stored index
``indexes/index.cdxj`` with place and length of every record. The reader fetches the tail of the file, parses the end records (with ZIP64), the central
directory and the index, and then reads each record's range alone. Files go to the cluster's shared folder under names of their own; a table of
the archives is written afterwards, so files of failed or repeated tasks are never read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from overspend.llm.common import map_batches, written
from overspend.session import shared_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payloads of at least so many bytes are stored once.
SHARED_BYTES = 1000
#: An archive is closed when its member reaches this size.
ARCHIVE_BYTES = 64 << 20
AHEAD = 1 << 20


def place_of(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


# ---- records ----------------------------------------------------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit carries the HTTP head only, whose length field tells the size of the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    target = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    fields = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
              "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{sha1}", "Content-Type": "application/http; msgtype=response"}
    if refers_to is not None:
        fields |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    lines = "".join(f"{name}: {value}\r\n" for name, value in (fields | {"Content-Length": len(block)}).items())
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


def parse_record(raw: bytes) -> dict:
    """The page, type, size, digest and target of one record; the digest of a stored payload is computed and must be the stated one."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
    page = fields["warc-record-id"][len("<urn:page:"):-1]
    refers = fields.get("warc-refers-to")
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(_fields(http)["content-length"])
    if refers is None and (hashlib.sha1(payload).hexdigest() != stated or len(payload) != size):
        raise ValueError(f"damaged record of page {page}")
    url = fields["warc-target-uri"].replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    return {"page_id": int(page) if page else None, "url": url, "payload": payload if refers is None else None, "payload_bytes": size,
            "payload_digest": stated, "record_type": fields["warc-type"], "refers_to": int(refers[len("<urn:page:"):-1]) if refers else None}


# ---- writing ----------------------------------------------------------------------------------------------------------------

class Archive:
    """One ZIP file that is being written; it never seeks, so any store will do."""

    def __init__(self, folder: str) -> None:
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, path = place_of(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member, self.size, self.index = self.zip.open(DATA, "w", force_zip64=True), 0, []

    def add(self, page_id: int | None, raw: bytes) -> None:
        packed = gzip.compress(raw, 4, mtime=0)
        self.member.write(packed)
        self.index.append(json.dumps({"page": page_id, "offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> dict:
        self.member.close()
        self.zip.writestr(INDEX, "\n".join(self.index))
        self.zip.close()
        self.out.close()
        return {"uri": [self.uri], "records": [len(self.index)], "bytes": [self.size]}


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every row as a record and return (uri, records, bytes) of the archives.

    Among equal payloads of at least 1000 bytes the one with the largest key is stored, others refer to it. A null payload is empty. Rows
    without a key are always stored; rows that repeat the largest key are each stored.
    """
    text = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), text.cast("binary").alias("payload"), F.sha1(text.cast("binary")).alias("sha1"),
                        F.when(F.octet_length(text) >= SHARED_BYTES, F.sha2(text, 256)).alias("same"))
    stored = rows.where("same is not null").groupBy("same").agg(F.max("page_id").alias("stored"), F.count("*").alias("n")).where("n > 1").select("same", "stored")
    joined = rows.join(written(stored, "stored-payloads"), "same", "left")
    refers = F.when(F.col("stored") > F.col("page_id"), F.col("stored")).alias("refers_to")

    def run(batches):
        archive = None
        for batch in batches:
            for page_id, target, payload, sha1, refers_to in zip(*(batch[n] for n in ("page_id", "url", "payload", "sha1", "refers_to"))):
                archive = archive or Archive(folder)
                archive.add(page_id, record(page_id, target, payload, sha1, refers_to))
                if archive.size >= ARCHIVE_BYTES:
                    yield archive.close()
                    archive = None
        if archive:
            yield archive.close()

    return written(map_batches(joined.select("page_id", "url", "payload", "sha1", refers), run, "uri string, records long, bytes long"), "archives")


# ---- reading ----------------------------------------------------------------------------------------------------------------

class Ranges:
    """Range reads of one file. Reads that follow each other are served from one fetched stretch."""

    def __init__(self, uri: str) -> None:
        system, path = place_of(uri)
        self.file = system.open_input_file(path)
        self.size, self.at, self.held = self.file.size(), 0, b""

    def read(self, start: int, length: int) -> bytes:
        if start < self.at or start + length > self.at + len(self.held):
            self.held = self.file.read_at(max(length, min(AHEAD, self.size - start)), start)
            self.at = start
        return self.held[start - self.at:start - self.at + length]


def members(ranges: Ranges) -> dict[str, tuple[int, int, int]]:
    """(offset of the local header, stored size, method) of each member, from the central directory."""
    size = ranges.size
    tail_at = max(0, size - 22 - 0xFFFF)
    tail = ranges.read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06", 0, len(tail) - 18)
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if tail_at + end >= 20 and ranges.read(tail_at + end - 20, 4) == b"PK\x06\x07":
        where = struct.unpack("<Q", ranges.read(tail_at + end - 20 + 8, 8))[0]
        big = ranges.read(where, 56)
        if big[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", big, 32)
    directory, found, at = ranges.read(start, length), {}, 0
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, plain, names, extras, notes = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + names].decode("utf-8")
        extra, end_of = at + 46 + names, at + 46 + names + extras
        while extra + 4 <= end_of:
            tag, size_of = struct.unpack_from("<HH", directory, extra)
            if tag == 1:
                # The ZIP64 field lists, in this order, only the values that did not fit.
                values = iter(struct.unpack_from(f"<{size_of // 8}Q", directory, extra + 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            extra += 4 + size_of
        found[name] = header, packed, method
        at = end_of + notes
    return found


def member_start(ranges: Ranges, header: int) -> int:
    """Where a member's bytes begin: its local header may have another extra field than the directory."""
    local = ranges.read(header, 30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    names, extras = struct.unpack_from("<HH", local, 26)
    return header + 30 + names + extras


def read_archive(uri: str) -> Iterator[dict]:
    """The records of one archive, in the order of its index."""
    ranges = Ranges(uri)
    parts = members(ranges)
    for name in (DATA, INDEX):
        if parts[name][2] != 0:
            raise ValueError(f"{name} is not stored as it is")
    header, size, _ = parts[INDEX]
    lines = ranges.read(member_start(ranges, header), size).decode().splitlines()
    base = member_start(ranges, parts[DATA][0])
    for line in lines:
        entry = json.loads(line)
        yield parse_record(gzip.decompress(ranges.read(base + entry["offset"], entry["length"])))


#: Tasks that read archives; beyond this many archives a task reads several, one after the other.
MOST_TASKS = 100_000
FIELDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives named in ``uri``; a revisit has no payload of its own. ``payloads=False`` leaves that column out."""
    names = [part.split()[0] for part in FIELDS.split(", ") if payloads or not part.startswith("payload ")]

    def run(batches):
        for batch in batches:
            for uri in batch["uri"]:
                rows, size = [], 0
                for row in read_archive(uri):
                    rows.append(row)
                    size += row["payload_bytes"]
                    if size > AHEAD:
                        yield {name: [r[name] for r in rows] for name in names}
                        rows, size = [], 0
                yield {name: [r[name] for r in rows] for name in names}

    # Ranges of names with an explicit number, so that the small list is not merged into one task.
    names_only = archives.select("uri")
    tasks = names_only.repartitionByRange(min(MOST_TASKS, max(1, names_only.count())), "uri")
    return map_batches(tasks, run, ", ".join(part for part in FIELDS.split(", ") if part.split()[0] in names))


def archive_round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write all rows, then read all archives. An empty table gives no archive and no row."""
    folder = shared_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), payloads)
