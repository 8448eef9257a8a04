"""WARC records in ZIP packages, and a reader that fetches records by range without unpacking.

A package holds two members, both stored (not deflated): ``archive/data.warc.gz``, in which each record is a gzip
member of its own, and ``indexes/index.cdxj`` with each record's offset and length there. The reader parses the end
records, the ZIP64 ones where there are any, and the central directory, finds where the stored members begin, reads
the index, and then reads each record by its range.

Records with equal payloads of at least ``LEAST_BYTES`` are written once: the one with the smallest id is a
response, the others are revisits that name it and its digest.

Defined results: a null payload is empty; a record with a null id revisits any that has one, and is a response if
none has; rows that repeat the smallest id and its payload are all responses; a null URL is written as an empty one; other columns are
not looked at; an empty table gives no package and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import new_folder, prepare, stored
from rankforge.llm.storage import opened, own_name

LEAST_BYTES = 100
#: A package is closed when its archive has so many bytes.
PACKAGE_BYTES = 8 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Fixed values of the ZIP format: signatures, and the sizes that say "see the ZIP64 record".
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    crc: int
    header_at: int


def package(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP file of stored members; ``zip64`` (or sizes that need it) puts sizes and places into ZIP64 fields."""
    out, central = bytearray(), bytearray()
    for name, data in members:
        crc, at, raw = zlib.crc32(data), len(out), name.encode()
        wide = zip64 or len(data) >= FULL32 or at >= FULL32
        size = FULL32 if wide else len(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if wide else b""
        out += LOCAL + struct.pack("<HHHHHIIIHH", 45 if wide else 20, 0x800, 0, 0, 33, crc, size, size, len(raw), len(extra)) + raw + extra + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if wide else b""
        central += CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45 if wide else 20, 0x800, 0, 0, 33, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, FULL32 if wide else at) + raw + extra
    at = len(out)
    out += central
    if zip64 or at >= FULL32 or len(members) >= FULL16:
        end = len(out)
        out += END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, len(members), len(members), len(central), at)
        out += LOCATOR64 + struct.pack("<IQI", 0, end, 1)
        out += END + struct.pack("<HHHHIIH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0)
    else:
        out += END + struct.pack("<HHHHIIH", 0, 0, len(members), len(members), len(central), at, 0)
    return bytes(out)


class PackageReader:
    """The members of a ZIP file, and ranges of its stored ones, read in place."""

    def __init__(self, source):
        self.source, self.size = source, source.size()
        self.members = {m.name: m for m in self._directory()}
        self._begin: dict[str, int] = {}

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def _directory(self) -> list[Member]:
        tail_at = max(0, self.size - 22 - FULL16)  # a comment of up to 65,535 bytes may stand last
        tail = self._read(tail_at, self.size - tail_at)
        k = len(tail)
        while True:
            k = tail.rfind(END, 0, k)
            if k < 0:
                raise ValueError("no end of a central directory")
            if len(tail) - k >= 22 and struct.unpack_from("<H", tail, k + 20)[0] == len(tail) - k - 22:
                break
            k += 3
        count, size, at = struct.unpack_from("<HII", tail, k + 10)
        if FULL16 == count or FULL32 in (size, at):
            locator = self._read(tail_at + k - 20, 20)
            if locator[:4] == LOCATOR64:
                end = self._read(struct.unpack_from("<Q", locator, 8)[0], 56)
                if end[:4] != END64:
                    raise ValueError("no ZIP64 end of the central directory")
                count, size, at = struct.unpack_from("<QQQ", end, 32)
        data, at, found = self._read(at, size), 0, []
        for _ in range(count):
            if data[at:at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            method, crc, packed, full, n, n_extra, n_comment, where = struct.unpack_from("<10x H 4x III HHH 8x I", data, at)
            name, extra = data[at + 46:at + 46 + n], data[at + 46 + n:at + 46 + n + n_extra]
            while len(extra) >= 4:
                kind, length = struct.unpack_from("<HH", extra)
                if kind == 1:  # ZIP64: those of the fields that are full, in this order
                    values = list(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                    full = values.pop(0) if full == FULL32 else full
                    packed = values.pop(0) if packed == FULL32 else packed
                    where = values.pop(0) if where == FULL32 else where
                extra = extra[4 + length:]
            found.append(Member(name.decode(), method, full, crc, where))
            at += 46 + n + n_extra + n_comment
        return found

    def begin(self, name: str) -> int:
        """Where a stored member's bytes begin: behind its local header, whose length may differ from the directory's."""
        if name not in self._begin:
            member = self.members[name]
            head = self._read(member.header_at, 30)
            if head[:4] != LOCAL or member.method != 0:
                raise ValueError(f"{name} is not a stored member")
            n, extra = struct.unpack_from("<HH", head, 26)
            self._begin[name] = member.header_at + 30 + n + extra
        return self._begin[name]

    def read(self, name: str, at: int = 0, size: int | None = None) -> bytes:
        size = self.members[name].size - at if size is None else size
        return self._read(self.begin(name) + at, size)

    def index(self) -> list[dict]:
        return [json.loads(line.split(b" ", 2)[2]) for line in self.read(INDEX).splitlines()]

    def records(self):
        """Each record that the index lists, fetched by its range: (header fields, block)."""
        for entry in self.index():
            yield parse_record(gzip.decompress(self.read(DATA, entry["offset"], entry["length"])))


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> tuple[bytes, dict]:
    """A WARC/1.1 record and what the index says of it. A revisit has the HTTP head alone."""
    name = "null" if page_id is None else str(page_id)
    digest = hashlib.sha256(payload).hexdigest()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{'null' if refers_to is None else refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return text.encode() + block + b"\r\n\r\n", {"page": name, "digest": f"sha256:{digest}"}


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


def with_first_copies(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, and for payloads of at least ``least`` bytes that occur more than once the smallest id
    of the equal ones. Copies are counted before anything is shuffled by digest, so a payload that a third of
    all rows share is one row a task there; the join back can be split."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    digest = F.sha2("payload", 256)
    firsts = (rows.filter(F.octet_length("payload") >= least).groupBy(digest.alias("digest"))
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    return rows.withColumn("digest", F.when(F.octet_length("payload") >= least, digest)).join(firsts, "digest", "left").drop("digest")


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   package_bytes: int = PACKAGE_BYTES, zip64: bool = False) -> DataFrame:
    """Write a record for every row; returns the manifest: path, n_records, bytes."""
    prepare(pages.sparkSession)

    def write(batches):
        part, out, index = TaskContext.get().partitionId(), bytearray(), []
        store, path = opened(folder)
        store.create_dir(path, recursive=True)

        def closed():
            name, data = own_name(part, "wacz"), package([(DATA, bytes(out)), (INDEX, b"".join(index))], zip64)
            with store.open_output_stream(f"{path}/{name}") as f:
                f.write(data)
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(index)], pa.int64()), pa.array([len(data)], pa.int64())], ["path", "n_records", "bytes"])
            out.clear()
            index.clear()
            return row

        for batch in batches:
            for page, url, payload, first in zip(*(c.to_pylist() for c in batch.columns)):
                raw, entry = record(page, url, payload, first, first is not None and page != first)
                raw = gzip.compress(raw, 3, mtime=0)
                index.append(f"{entry['page']} 0 {json.dumps(entry | {'offset': len(out), 'length': len(raw), 'filename': 'data.warc.gz'})}\n".encode())
                out += raw
                if len(out) >= package_bytes:
                    yield closed()
        if index:
            yield closed()

    rows = with_first_copies(pages, id_col, url_col, payload_col).select("page_id", "url", "payload", "first_id")
    return stored(rows.mapInArrow(write, "path string, n_records long, bytes long"), "warc-manifest")


def read_packages(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the packages: page_id, url, record_type, refers_to, payload_digest, payload_bytes (of the full
    payload), payload (null in revisits)."""
    prepare(spark)

    def number(urn: str | None) -> int | None:
        text = "null" if urn is None else urn.removeprefix("<urn:page:").removesuffix(">")
        return None if text == "null" else int(text)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def read(batches):
        store, path = opened(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{path}/{name}") as source:
                    rows: list[tuple] = []
                    size = 0
                    for fields, block in PackageReader(source).records():
                        head, _, payload = block.partition(b"\r\n\r\n")
                        length = int(next(x for x in head.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
                        revisit = fields["WARC-Type"] == "revisit"
                        rows.append((number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"], number(fields.get("WARC-Refers-To")), fields["WARC-Payload-Digest"].removeprefix("sha256:"), length, None if revisit else payload))
                        size += len(payload)
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path").repartition(tasks).mapInArrow(read, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


def archive_and_read(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    return read_packages(spark, write_packages(pages, folder, **options), folder)
