import os
import zlib
from collections import Counter, defaultdict

from murmura.llm import sharding
from murmura.llm.queries import op6_rendezvous_sharding


def test_sizes_checksums_slots_and_growth(spark, corpus):
    _, texts = corpus
    rows = op6_rendezvous_sharding(spark, "/root/testdata/sf0.001").collect()
    by_id = dict(texts)
    slots = defaultdict(list)
    for r in rows:
        data = by_id[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8


def test_weights_and_moves(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    rows = sharding.assign(keys, "doc_id", [1.0, 2.0, 0.0, 1.0], [1.0, 2.0, 0.0, 1.0, 1.0]).collect()
    n = Counter(r.shard for r in rows)
    assert abs(n[1] - 10_000) < 400 and abs(n[0] - 5_000) < 300 and n[2] == 0
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert all(r.grown_shard == 4 for r in moved) and abs(len(moved) - 4_000) < 300


def test_odd_rows(odd_docs, make_docs):
    rows = sharding.assign(odd_docs.select("doc_id", "text"), "doc_id", [1.0] * 3).collect()
    assert len(rows) == odd_docs.count() and len({r.shard for r in rows if r.doc_id is None}) == 1
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert sharding.assign(make_docs([]).select("doc_id"), "doc_id", [1.0]).collect() == []


def test_written_shards(spark, make_docs, tmp_path):
    docs = make_docs([f"t{i}" for i in range(100)])
    sharding.write_shards(docs.select("doc_id", "text"), "doc_id", [1.0] * 4, str(tmp_path / "out"), files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    want = {r.doc_id: r.shard for r in sharding.assign(docs.select("doc_id"), "doc_id", [1.0] * 4).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == want and len(os.listdir(tmp_path / "out")) >= 4
