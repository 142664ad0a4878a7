import re
from collections import Counter

import numpy as np

from murmura.llm import quality
from murmura.llm.queries import op3_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated)


def same_counts(df, texts):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect())
    want = Counter()
    for doc, text in texts:
        n = brute(text)
        want[(doc, *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert got == want


def test_counts(spark, corpus, odd_docs):
    docs, texts = corpus
    same_counts(quality.judge(docs), texts)
    same_counts(quality.judge(odd_docs), [(r.doc_id, r.text) for r in odd_docs.collect()])


def test_empty_table(make_docs):
    assert quality.judge(make_docs([])).collect() == []
    assert quality.kept_documents(make_docs([])).collect() == []


def test_agrees_with_labels(spark):
    """No label is used; the verdicts are held against them."""
    folder = "/root/testdata/sf0.01"
    got = op3_quality_rules(spark, folder)
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("n_words >= 50").collect()
    good = [r for r in rows if r.quality == 1]
    poor = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in poor) >= 0.95 * len(poor)


def test_em_finds_planted_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(40_000) < 0.8
    on_good, on_bad = [0.98, 0.95, 0.99, 0.97], [0.7, 0.6, 0.8, 0.5]
    patterns = Counter()
    for is_good in good:
        votes = tuple(
            None if rng.random() < 0.2 else int(rng.random() < g) if is_good else int(rng.random() >= b) for g, b in zip(on_good, on_bad)
        )
        patterns[votes] += 1
    model = quality.fit(patterns, 4)
    assert abs(model.prior - good.mean()) < 0.03
    assert np.allclose(model.on_good, on_good, atol=0.03) and np.allclose(model.on_bad, on_bad, atol=0.08)


def test_kept_documents_keeps_all_columns_and_repeated_rows(make_docs):
    fine = " ".join(f"wort{chr(97 + i % 26)}{i % 7}" for i in range(120)) + "."
    docs = make_docs([fine, fine, "x", None], [1, 1, 2, None])
    rows = quality.kept_documents(docs)
    assert rows.columns == docs.columns and [r.doc_id for r in rows.collect()] == [1, 1]


def test_toxic_texts_against_labels(spark):
    """English texts of good quality that are labelled toxic are flagged, and no text that isn't labelled so."""
    folder = "/root/testdata/sf0.01"
    flagged = op3_quality_rules(spark, folder).withColumnRenamed("toxic", "flag")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = flagged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").join(docs, "doc_id").collect()
    assert not any(r.flag for r in rows if not r.toxic)
    planted = [r.flag for r in rows if r.toxic and r.quality and r.lang == "en"]
    assert planted and all(planted)
    assert sum(r.flag for r in rows) == 33
