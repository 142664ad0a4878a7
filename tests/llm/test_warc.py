import hashlib
import io
import os
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from murmura.llm import warc
from murmura.llm.queries import op8_warc

BIG = "é" * 600


def brute(rows):
    out = []
    for page, _, text in rows:
        data = (text or "").encode()
        same = [p for p, _, t in rows if (t or "").encode() == data and p is not None]
        keeper = max(same, default=None) if len(data) >= 1000 and len([1 for _, _, t in rows if (t or "").encode() == data]) > 1 else page
        other = keeper is not None and keeper != page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if other else "response", keeper if other else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    rows = [
        (1, "http://a/\r\nx", BIG), (2, None, BIG), (9, "u", BIG), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (6, "ü\"\\", "x" * 300_000),
        (7, "u", "\r\n\r\nWARC/1.1\r\n"), (9, "u", BIG), (8, "u", "y" * 1000), (10, "u", "y" * 1000),
    ]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    archives = warc.write(pages, str(tmp_path / "a"), most=1000)
    got = warc.read(archives).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    by_id = {p: (u, h) for p, u, h in rows}
    for r in got:
        assert r.url == by_id[r.page_id][0]
        if r.record_type == "response":
            assert bytes(r.payload) == (by_id[r.page_id][1] or "").encode()
    # The files are ordinary archives; nothing of a draft is left.
    names = os.listdir(tmp_path / "a")
    assert len(names) > 3 and all(n.endswith(".wacz") for n in names)
    for n in names:
        assert zipfile.ZipFile(tmp_path / "a" / n).testzip() is None


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(pages, str(tmp_path / "e"))).collect() == []


def zip64(members, comment=b""):
    """A ZIP file with ZIP64 records throughout, written by hand."""
    out, entries = io.BytesIO(), []
    for name, data in members.items():
        at = out.tell()
        out.write(b"PK\x03\x04" + bytes(22) + len(name).to_bytes(2, "little") + (5).to_bytes(2, "little") + name.encode() + b"extra" + data)
        wide = b"".join(x.to_bytes(8, "little") for x in (len(data), len(data), at))
        extra = b"\x99\x99\x02\x00ab" + b"\x01\x00" + len(wide).to_bytes(2, "little") + wide
        entries.append(
            b"PK\x01\x02" + bytes(6) + bytes(2) + bytes(8) + b"\xff" * 8 + len(name).to_bytes(2, "little")
            + len(extra).to_bytes(2, "little") + bytes(2) + bytes(8) + b"\xff" * 4 + name.encode() + extra
        )
    start, directory = out.tell(), b"".join(entries)
    out.write(directory)
    end = out.tell()
    out.write(b"PK\x06\x06" + (44).to_bytes(8, "little") + bytes(12) + len(entries).to_bytes(8, "little") * 2)
    out.write(len(directory).to_bytes(8, "little") + start.to_bytes(8, "little"))
    out.write(b"PK\x06\x07" + bytes(4) + end.to_bytes(8, "little") + (1).to_bytes(4, "little"))
    out.write(b"PK\x05\x06" + bytes(4) + b"\xff" * 12 + len(comment).to_bytes(2, "little") + comment)
    return out.getvalue()


def test_zip64_directory_and_misleading_comments(tmp_path):
    path = tmp_path / "z.zip"
    for comment in (b"", b"PK\x05\x06 not the end " * 40):
        path.write_bytes(zip64({"a": b"first", "b/c": b"x" * 70_000}, comment))
        z = warc.Zip(str(path))
        assert z.range(*z.stored("a")) == b"first" and z.range(*z.stored("b/c")) == b"x" * 70_000


def test_damage_is_told(tmp_path):
    path = tmp_path / "z.zip"
    path.write_bytes(b"no archive")
    with pytest.raises(ValueError, match="end of central directory"):
        warc.Zip(str(path))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "x" * 100)
    with pytest.raises(ValueError, match="compressed"):
        warc.Zip(str(path)).stored("a")
    good = warc._gzip(warc._record(1, "u", None, 3, hashlib.sha1(b"abd").hexdigest(), b"abc"))
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(good)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert sorted((tuple(r) for r in op8_warc(spark, "/root/testdata/sf0.001").collect()), key=str) == brute(rows)


def test_a_large_archive_is_read_by_many_tasks(spark, tmp_path):
    """One archive; adaptive execution would bring its few index rows into one task."""
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" + "x" * (i * 37 % 400)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    archives = warc.write(pages, str(tmp_path / "a"))
    assert archives.count() == 1
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    try:
        read = warc.read(archives, stretch=1 << 10, a_task=4 << 10).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    tasks = Counter(r.task for r in read)
    assert len(read) == 300 and len(tasks) >= 6 and max(tasks.values()) < 150
