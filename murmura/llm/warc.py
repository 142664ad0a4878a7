"""WARC archives packed in ZIP files: written in parallel, read by ranges and never unpacked.

An archive is a ZIP file with two stored members: `archive/data.warc.gz` (one gzip member per record) and
`indexes/index.cdxj` (a line for each record with its offset and length). The reader takes the end of the file,
finds the central directory (also its ZIP64 form), finds the stored members and the index, and then reads each
record's range alone.

Files are opened through pyarrow's file systems, so the folder is any URI those know (a shared mount, HDFS,
object stores). Every attempt of a task writes under names of its own, whole files only; the table of archives
lists those of the attempts that Spark accepted, so a repeated or speculative task neither doubles nor loses rows.

Defined cases: a null payload is empty; null urls stay null; records repeated with one id are each written;
payloads are equal if length and SHA-1 are; an empty table gives no archives and no records; other columns of
the input are not carried.
"""

from __future__ import annotations

import hashlib
import json
import math
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from murmura.llm.common import among, beside, shared_folder, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payloads from this size on are deduplicated.
REVISIT_FROM = 1000

ARCHIVES = T.StructType([T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("records", T.LongType())])
ENTRIES = T.StructType([T.StructField(n, T.StringType() if n == "path" else T.LongType()) for n in ("path", "offset", "length")])
RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# The record layout and the ZIP signatures of the published formats.
def _record(page_id: int, url: str | None, refers_to: int | None, size: int, digest: str, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {json.dumps(url)[1:-1]}")
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse_record(raw: bytes) -> dict:
    """One WARC record, its gzip member not yet unpacked."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(h.split(b":")[1]) for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload doesn't match its length and digest")

    def page(urn: str | None) -> int | None:
        name = urn.removeprefix("<urn:page:").removesuffix(">") if urn else "None"
        return None if name == "None" else int(name)

    url = fields.get("warc-target-uri")
    return {
        "page_id": page(fields["warc-record-id"]),
        "url": None if url is None else json.loads(f'"{url}"'),
        "record_type": kind,
        "refers_to": page(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def plan(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, size, digest and refers_to: of large equal payloads the largest page_id stays."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha1(payload).alias("digest"),
    )
    kept = (
        rows.filter(F.col("size") >= REVISIT_FROM)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "size", "keeper")
    )
    # Few payloads have a partner, so only those that may have one are dealt.
    kept = written(kept)
    alone = beside(rows, kept, "digest").withColumn("keeper", F.lit(None).cast("long"))
    paired = among(rows, kept, "digest").join(kept, ["digest", "size"], "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("keeper")), F.col("keeper"))
    return alone.unionByName(paired).withColumn("refers_to", refers).drop("keeper")


def write(pages: DataFrame, folder: str | None = None, most: int = 64 << 20) -> DataFrame:
    """Write the archives; path, bytes and records of each. A file is closed once it holds `most` bytes."""
    folder = folder or shared_folder(pages.sparkSession)
    arrow = to_arrow_schema(ARCHIVES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _file_system(folder)
        system.create_dir(top, recursive=True)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        rows = (row for batch in batches for at in range(0, batch.num_rows, 100) for row in batch.slice(at, 100).to_pylist())
        row, number = next(rows, None), 0
        while row is not None:
            name = f"part-{part:05d}-{number:05d}-{attempt}.wacz"
            draft = f"{top}/.{name}"
            with system.open_output_stream(draft) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
                index, at = [], 0
                with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as member:
                    while row is not None and at < most:
                        revisit = row["refers_to"] is not None
                        raw = _gzip(_record(row["page_id"], row["url"], row["refers_to"], row["size"], row["digest"], b"" if revisit else row["payload"]))
                        member.write(raw)
                        index.append(json.dumps({"id": row["page_id"], "offset": at, "length": len(raw)}))
                        at += len(raw)
                        row = next(rows, None)
                z.writestr(zipfile.ZipInfo(INDEX), "\n".join(index))
            system.move(draft, f"{top}/{name}")
            size = system.get_file_info(f"{top}/{name}").size
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "bytes": size, "records": len(index)}], schema=arrow)
            number += 1

    columns = ["page_id", "url", "payload", "size", "digest", "refers_to"]
    return written(plan(pages).select(*columns).mapInArrow(run, ARCHIVES))


class Member(NamedTuple):
    name: str
    method: int
    packed: int
    size: int
    header: int


class Zip:
    """A ZIP file read by ranges: its directory, and where stored members' bytes lie."""

    def __init__(self, path: str):
        system, name = _file_system(path)
        self.file = system.open_input_file(name)
        self.bytes = self.file.size()
        self.members = {m.name: m for m in self._directory()}

    def range(self, offset: int, length: int) -> bytes:
        got = self.file.read_at(length, offset)
        if len(got) != length:
            raise ValueError("the archive ends too early")
        return got

    def _directory(self) -> list[Member]:
        tail = self.range(max(0, self.bytes - 65_557), min(self.bytes, 65_557))
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
            end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise ValueError("no end of central directory")
        count, size, start = struct.unpack("<HII", tail[end + 10 : end + 20])
        place = self.bytes - len(tail) + end - 20
        if place >= 0 and self.range(place, 4) == b"PK\x06\x07":
            record = self.range(int.from_bytes(self.range(place + 8, 8), "little"), 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, size, start = struct.unpack("<QQQ", record[32:56])
        data, at, members = self.range(start, size), 0, []
        for _ in range(count):
            if data[at : at + 4] != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            method, packed, full, n, extra, comment, header = struct.unpack("<10xH8xIIHHH8xI", data[at : at + 46])
            name = data[at + 46 : at + 46 + n].decode()
            fields, end_of = at + 46 + n, at + 46 + n + extra
            while fields + 4 <= end_of:
                kind, length = struct.unpack("<HH", data[fields : fields + 4])
                if kind == 1:  # ZIP64: those values that don't fit, in this order
                    wide = iter(struct.unpack(f"<{length // 8}Q", data[fields + 4 : fields + 4 + length // 8 * 8]))
                    full = next(wide) if full == 0xFFFFFFFF else full
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    header = next(wide) if header == 0xFFFFFFFF else header
                fields += 4 + length
            members.append(Member(name, method, packed, full, header))
            at = end_of + comment
        return members

    def stored(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes in the file."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is compressed, not stored")
        head = self.range(m.header, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name}: no local header")
        n, extra = struct.unpack("<HH", head[26:30])
        return m.header + 30 + n + extra, m.size


def entries(archives: DataFrame) -> DataFrame:
    """path, offset and length (in the file) of every record, from the archives' indexes."""
    arrow = to_arrow_schema(ENTRIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column("path").to_pylist()):
            z = Zip(path)
            with z.file:
                base, size = z.stored(DATA)
                lines = [json.loads(x) for x in z.range(*z.stored(INDEX)).decode().split("\n") if x]
            if any(x["offset"] + x["length"] > size for x in lines):
                raise ValueError(f"{path}: the index points outside the archive")
            columns = [[path] * len(lines), [base + x["offset"] for x in lines], [x["length"] for x in lines]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return archives.select("path").repartition("path").mapInArrow(run, ENTRIES)


def read(archives: DataFrame, stretch: int = 4 << 20, a_task: int = 64 << 20) -> DataFrame:
    """All records of the archives; a task takes stretches of files, so a large archive is many tasks' work.

    The number of tasks is named, by the archives' bytes: the index rows that are dealt are so small that adaptive
    execution would bring them together, whatever they point at.
    """
    arrow = to_arrow_schema(RECORDS)
    place = [F.col("path"), F.floor(F.col("offset") / stretch)]
    total = archives.agg(F.sum("bytes")).first()[0] or 0
    usual = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(math.ceil(total / a_task), min(usual, math.ceil(total / stretch)), 1)
    spread = entries(archives).repartition(tasks, *place).sortWithinPartitions("path", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, z = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                out = []
                for row in batch.slice(at, 100).to_pylist():
                    if row["path"] != path:
                        if z is not None:
                            z.file.close()
                        path = row["path"]
                        z = Zip(path)
                    out.append(parse_record(z.range(row["offset"], row["length"])))
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return spread.mapInArrow(run, RECORDS)
