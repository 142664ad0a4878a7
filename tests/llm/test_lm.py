import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from murmura.llm import lm


def tokens(text):
    return [*(text or "").encode().lower().split(), lm.END]


def brute_base(texts):
    counts = Counter()
    for doc, text in texts:
        if zlib.crc32(str("null" if doc is None else doc).encode()) % 5 != 1:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in texts:
        t = tokens(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out.append((doc, len(t), sum(counts[w] > 0 for w in t), n, base))
    return sorted(out, key=str)


def same_base(df, texts):
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in df.collect()), key=str)
    want = brute_base(texts)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-9)


def test_whole_table(corpus):
    docs, texts = corpus
    scored = lm.score(docs, size=60_000, pairs_in_part=5_000).cache()
    same_base(scored, texts)
    held = scored.filter("held_out").collect()
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    again = {(r.doc_id, r.score) for r in lm.score(docs, size=60_000, pairs_in_part=5_000).collect()}
    assert again == {(r.doc_id, r.score) for r in scored.collect()}


def test_odd_texts(odd_docs, make_docs):
    same_base(lm.score(odd_docs), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert lm.score(make_docs([])).collect() == []
    only_held = make_docs(["a b"] * 1, [next(i for i in range(99) if lm.held_out(i))])
    row = lm.score(only_held).collect()[0]
    assert row.train_tokens == 0 and row.n_known == 0 and math.isclose(row.score, 0.0, abs_tol=1e-9)


def test_word_order_counts(make_docs):
    """Held-out texts of known pairs score above the same words in another order, and above one unknown word."""
    train = [i for i in range(400) if not lm.held_out(i)][:60]
    held = [i for i in range(400) if lm.held_out(i)][:3]
    rng = np.random.default_rng(1)
    chains = [f"a{k} b{k} c{k}" for k in range(9)]
    texts = [" ".join(rng.choice(chains, 12)) for _ in train]
    probes = ["a3 b3 c3 a5 b5 c5", "b3 c5 a3 c3 b5 a5", "a3 b3 new a5 b5 c5"]
    rows = {r.doc_id: r for r in lm.score(make_docs([*texts, *probes], [*train, *held])).collect()}
    known, mixed, unknown = (rows[i].score for i in held)
    assert known > mixed + 3 and known > unknown + 1 and known > rows[held[0]].base_score + 2


def brute_marginal(counts, discount, strength, parent):
    """Exact distribution of the table counts of one restaurant with a fixed parent."""
    s = np.exp(lm.log_stirling(max(counts), discount))
    weights = {}
    for t in product(*(range(1, c + 1) for c in counts)):
        total = sum(t)
        w = np.prod([strength + discount * k for k in range(1, total)]) * (strength + 0.0)
        for c, k in zip(counts, t):
            w *= s[c, k] * parent**k
        weights[t] = w
    z = sum(weights.values())
    return {t: w / z for t, w in weights.items()}


def test_gibbs_samples_the_posterior():
    counts, d, theta, p = np.array([3, 2, 5]), 0.5, 1.0, 0.2
    want = brute_marginal(counts.tolist(), d, theta, p)
    seats = lm.seat(np.zeros(3, np.int64), counts, np.arange(3), 3, d, theta, np.random.default_rng(0), parent=p)
    n = 20_000
    seen = Counter(tuple(int(x) for x in next(seats)) for _ in range(n))
    mean = [sum(t[i] * w for t, w in want.items()) for i in range(3)]
    got = [sum(t[i] * w for t, w in seen.items()) / n for i in range(3)]
    # Cells are drawn together, given the others' last tables: the means agree closely, not the joint law.
    assert np.allclose(mean, got, atol=0.12)


def test_large_dishes_get_about_as_many_tables_as_one_by_one_seating():
    d, theta, p, c = 0.5, 1.0, 0.3, 500
    rng = np.random.default_rng(3)
    one_by_one = []
    for _ in range(1500):
        t = 1
        for k in range(1, c):
            new = p * (theta + d * t)
            t += rng.random() < new / (new + k - d * t)
        one_by_one.append(t)
    many = 3000
    seats = lm.seat(np.arange(many), np.full(many, c), np.zeros(many, np.int64), 1, d, theta, rng, parent=p)
    assert np.mean(next(seats)) == pytest.approx(np.mean(one_by_one), rel=0.1)


def test_stirling_numbers():
    s = np.exp(lm.log_stirling(4, 0.5))
    # Three customers: one table (1 - d)(2 - d); two tables 3 (1 - d); three tables 1.
    assert np.allclose(s[3, 1:4], [0.5 * 1.5, 3 * 0.5, 1.0])


def test_packed_arrays_come_back():
    for a in (np.zeros(0, np.uint8), np.arange(1000, dtype=np.uint64) << np.uint64(30), np.array([-1, 5], np.int64)):
        assert np.array_equal(lm._unpack(lm._pack(a)), a) and lm._unpack(lm._pack(a)).dtype == a.dtype
