import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from murmura.llm import exactdedup


def brute(rows, largest):
    """(doc_id, keep_id, size) of every row, and the number of rows that stay."""
    same = defaultdict(list)
    for doc, text in rows:
        same[text or ""].append(doc)
    out = []
    for docs in same.values():
        known = [d for d in docs if d is not None]
        keep = (max if largest else min)(known) if known else None
        out += [(d, keep, len(docs)) for d in docs]
    return sorted(out, key=str), len(same)


def check(docs, keep, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = exactdedup.groups(docs, keep, {"text": F.coalesce("text", F.lit(""))}, **options).collect()
    want, kept = brute(rows, keep == "largest")
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == want
    stay = [r for r in got if r.kept]
    assert len(stay) == kept == len({r.text for r in stay}) and all(r.doc_id == r.keep_id for r in stay)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_odd_rows(odd_docs, make_docs, keep):
    check(odd_docs, keep)
    check(make_docs([]), keep)
    check(make_docs(["a", "a", "a", "b", "b "], [3, 3, None, None, 1]), keep)


def test_whole_table(corpus):
    docs, _ = corpus
    check(docs, "largest")


def test_hot_group_and_small_bitmap(make_docs):
    """A third of all rows is one text; a map of 64 bits lets every text through."""
    docs = make_docs(["hot text"] * 300 + [f"t{i // 2}" for i in range(600)])
    check(docs, "largest")
    check(docs, "smallest", bits=64)


def test_collisions_are_told_apart_by_bytes(make_docs):
    """Four hashes for all texts: nearly every group of a hash holds several texts."""
    docs = make_docs([f"t{i % 40}" for i in range(100)] + [None, "", "alone"])

    def weak(c):
        return F.substring(F.md5(c.cast("binary")), 1, 1)

    check(docs, "largest", hash_of=weak)
    one_clean = F.when(F.col("text") == "alone", F.lit("x"))
    check(docs, "smallest", hash_of=lambda c: F.coalesce(one_clean, weak(c)))


def test_keep_is_checked(make_docs):
    with pytest.raises(ValueError):
        exactdedup.groups(make_docs(["a"]), "newest")


def test_digest_of_the_query(spark):
    from murmura.llm.queries import op13_exact_dedup

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op13_exact_dedup(spark, folder).collect()
    assert len(rows) == len(texts)
    assert all(r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)


def test_no_python_in_the_plan(spark):
    from murmura.llm.queries import op13_exact_dedup

    plan = op13_exact_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Cartesian" not in plan
