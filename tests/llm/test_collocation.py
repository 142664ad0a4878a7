import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.llm import collocation

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def brute(rows, least, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans(UPPER, LOWER))):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        found = [p for p, a in f.items() if len(p) > 1 and a >= least]
        above = defaultdict(int)
        for p in found:
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        above[p[i:j]] = max(above[p[i:j]], f[p])
        best = []
        for p in found:
            if 100 * above[p] >= 80 * f[p]:
                continue
            score, _, l, r = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -f[p], " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def got(found):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[n] for n in names) for r in found.collect())


def table(make_docs, rows):
    docs = make_docs([t for _, t in rows])
    langs = {i: lang for i, (lang, _) in enumerate(rows)}
    pick = F.create_map([F.lit(x) for i, lang in langs.items() if lang is not None for x in (i, lang)]) if any(langs.values()) else None
    return docs.withColumn("lang", F.try_element_at(pick, F.col("doc_id").cast("int")) if pick is not None else F.lit(None).cast("string"))


def some_rows(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "é", "x|y", "\x00", "中文", "a b"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "; "]) for _ in range(rng.randint(0, 40))]
        rows.append((rng.choice(["en", "en", "de", None]), "".join(parts) + "Tail phrase in every text"))
    return rows


@pytest.mark.parametrize("shard_words, bits", [(1 << 22, collocation.BITS), (50, collocation.BITS), (50, 64)])
def test_against_brute_force(make_docs, shard_words, bits):
    """One shard or many; a full bitmap keeps nothing back and changes nothing."""
    rows = some_rows(1)
    assert got(collocation.phrases(table(make_docs, rows), least=4, shard_words=shard_words, bits=bits)) == brute(rows, 4)


def test_frequent_first_words_are_dealt_apart(make_docs, monkeypatch):
    monkeypatch.setattr(collocation, "HOT", 10)
    rows = some_rows(5)
    assert got(collocation.phrases(table(make_docs, rows), least=3, shard_words=200)) == brute(rows, 3)


def test_top_and_ties(make_docs):
    rows = [("en", "b a, c a, a c. a b")] * 5
    found = got(collocation.phrases(table(make_docs, rows), least=5, top=3))
    assert found == brute(rows, 5, 3) and [r[2] for r in found] == ["a b", "a c", "b a"]


def test_odd_texts(odd_docs, make_docs):
    rows = [(r.lang, r.text) for r in odd_docs.select("lang", "text").collect()]
    assert got(collocation.phrases(odd_docs, least=2)) == brute(rows, 2)
    assert collocation.phrases(make_docs([])).collect() == []
    assert collocation.phrases(make_docs([None, "", " . "])).collect() == []


def test_long_text_in_pieces(make_docs, monkeypatch):
    """Phrases go on over the places where a long text is cut for reading."""
    monkeypatch.setattr(collocation, "_CHUNK", 10)
    rows = [("en", "one two three four five " * 40 + "w" * 100 + " one two")]
    shard = collocation._Shard()
    shard.add(rows[0][1].encode())
    assert len(shard.numbers) == len(rows[0][1].split()) + 2
    assert got(collocation.phrases(table(make_docs, rows), least=3)) == brute(rows, 3)


def test_whole_table(spark, corpus):
    docs, _ = corpus
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert got(collocation.phrases(docs, least=5, shard_words=5000)) == brute(rows, 5)


@pytest.mark.parametrize("seed", range(4))
def test_index_counts_every_phrase(seed):
    """Intervals of the transform against counting; the rows of a ring sorted by four numbers, whatever follows."""
    rng = np.random.default_rng(seed)
    numbers = np.append(0, rng.integers(0, 4, 500)).astype(np.int32)
    numbers[-1] = 0
    if seed == 3:
        numbers = numbers * 60_000  # four numbers need more than 62 bits
    bwt = collocation.transform(numbers)
    psi = collocation.psi_of(bwt)
    first = collocation._first(bwt, psi)
    second, third = first[psi], first[psi][psi]
    fourth = third[psi]
    ring = numbers.tolist()
    for parts in ([first, second], [first, second, third], [first, second, third, fourth]):
        start, size = collocation.intervals(*parts)
        found = {tuple(int(p[s]) for p in parts): int(n) for s, n in zip(start, size)}
        m = len(parts)
        want = Counter(tuple((ring + ring)[i : i + m]) for i in range(len(ring)))
        assert found == {k: n for k, n in want.items() if 0 not in k}
