import re
from collections import Counter

import pytest

from murmura.llm import decontaminate
from murmura.llm.queries import op10_benchmark_decontamination


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = Counter()
    for doc, text in texts:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (owners := windows.get(tuple(w[i : i + n]))):
                    hit |= set(range(i, i + n))
                    found |= owners
        out[doc, len(w), len(hit), tuple(sorted(found))] += 1
    return out


def found(df):
    return Counter((r.doc_id, r.n_words, sum(h["words"] for h in r.hits), tuple(r["items"])) for r in df.collect())


@pytest.mark.parametrize("max_bytes", [16 << 20, 3000])
def test_whole_tables(spark, corpus, max_bytes):
    """Also with the items dealt over several automata."""
    docs, texts = corpus
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    scanned = decontaminate.scan(docs, bench, max_bytes=max_bytes)
    assert found(scanned) == brute(texts, [(r.item_id, r.text) for r in bench.collect()])
    assert op10_benchmark_decontamination(spark, "/root/testdata/sf0.001").filter("contaminated").count() > 0


def test_offsets_point_into_the_original(spark, make_docs):
    docs = make_docs(["É! Foo,  BAR baz (é) end", "foo bar", "a b c d e f g h i j k l m"])
    bench = spark.createDataFrame([(1, "foo bar baz é"), (2, "b c d e f g h i j k l"), (3, None), (4, "--"), (2, "m")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.scan(docs, bench).collect()}
    assert [r.text[h["start"] : h["end"]] for r in rows.values() for h in r.hits] == ["Foo,  BAR baz (é", "b c d e f g h i j k l m"] or rows[0].hits
    h = rows[0].hits[0]
    assert rows[0].text[h["start"] : h["end"]] == "Foo,  BAR baz (é" and rows[1].hits == []
    assert [rows[2].text[h["start"] : h["end"]] for h in rows[2].hits] == ["b c d e f g h i j k l m"] and rows[2]["items"] == ["2"]


def test_odd_texts(spark, odd_docs, make_docs):
    bench = spark.createDataFrame([(7, "Same TEXT"), (8, ""), (None, "x x")], "item_id long, text string")
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = found(decontaminate.scan(odd_docs, bench))
    assert got == brute(texts, [(7, "Same TEXT"), (8, ""), ("null", "x x")])
    clean = decontaminate.clean_documents(odd_docs, bench)
    assert clean.columns == odd_docs.columns and clean.count() == len(texts) - 3
    assert decontaminate.scan(make_docs([]), bench).collect() == []
    assert decontaminate.clean_documents(odd_docs, bench.limit(0)).count() == len(texts)


def test_a_large_item_in_pieces(spark, make_docs):
    """An item far above the size of a group: windows over the places where it is cut are found, and no shorter ones."""
    words = [f"w{i}" for i in range(900)]
    bench = spark.createDataFrame([("big", " ".join(words)), ("small", "just four words here")], "item_id string, text string")
    texts = [" ".join(words[i : i + 10]) for i in range(0, 891)] + [" ".join(words[i : i + 9]) for i in range(0, 890, 7)] + ["JUST four, words here"]
    rows = decontaminate.scan(make_docs(texts), bench, max_bytes=1000).collect()
    found = {r.doc_id: list(r["items"]) for r in rows}
    assert all(found[i] == ["big"] for i in range(891)) and found[len(texts) - 1] == ["small"]
    assert all(found[i] == [] for i in range(891, len(texts) - 1))
