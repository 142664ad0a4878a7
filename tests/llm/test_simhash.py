import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from murmura.llm import simhash
from murmura.llm.components import components


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """rows: (doc_id, fp). Component of each row by all pairs."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [least.get(root(i)) for i in range(len(rows))]


def compare(df, texts):
    rows = [(d, brute_fingerprint(t)) for d, t in texts]
    want = sorted(((d, fp, c) for (d, fp), c in zip(rows, brute_components(rows))), key=repr)
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in df.collect()), key=repr)
    assert got == want


def test_whole_table(corpus):
    docs, texts = corpus
    compare(simhash.groups(docs), texts)


def test_odd_texts(odd_docs):
    compare(simhash.groups(odd_docs), [(r.doc_id, r.text) for r in odd_docs.collect()])


def test_empty_table(make_docs):
    assert simhash.groups(make_docs([])).collect() == []


def test_pairs_within_three_bits_share_an_anchor():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64)
    cells = []
    for fps in (x, y):
        found = [set() for _ in fps]
        for w, c in zip(*(a.tolist() for a in simhash.anchors(fps))):
            found[w].add(c)
        cells.append(found)
    assert all(a & b for a, b in zip(*cells))


@pytest.mark.parametrize("most", [50_000, 20])
def test_links_connect_what_all_pairs_connect(spark, most):
    """A cloud of near fingerprints, a chain and noise; also with anchors split into blocks."""
    rnd = random.Random(4)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    centre = rnd.getrandbits(64)
    fps |= {centre ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) for _ in range(200)}
    chain = rnd.getrandbits(64)
    for b in range(60):
        chain ^= 1 << b
        fps.add(chain)
    fps = sorted(fps)
    signed = [(f - 2**64 if f >> 63 else f,) for f in fps]
    found = components(simhash.links(spark.createDataFrame(signed, "fp long"), most=most)).collect()
    root = {r.a: r.b for r in found}
    got = {}
    for (f,) in signed:
        got.setdefault(root.get(f, f), set()).add(f % 2**64)
    want = {}
    for f, c in zip(fps, brute_components(list(zip(range(len(fps)), fps)))):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_one_of_each(make_docs):
    text = " ".join(f"word{i}" for i in range(300))
    docs = make_docs([text, text.upper(), text, "something else", "something else"], [5, 3, 3, 9, 9])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 9]


def test_rows_without_an_id_are_told_apart_by_their_text(make_docs):
    docs = make_docs(["alpha beta gamma", "delta epsilon zeta", "alpha beta gamma", "eta theta iota", "eta theta iota"], [None, None, None, 4, None])
    kept = sorted((r.doc_id is None, r.text) for r in simhash.one_of_each(docs).collect())
    assert kept == [(False, "eta theta iota"), (True, "alpha beta gamma"), (True, "delta epsilon zeta")]


def jaccard_sets(texts, words=5):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else {()})
    return out


def similar_components(texts, least=0.8, words=5):
    """All pairs: (root by text, pairs of different texts at the similarity or above)."""
    sets = jaccard_sets(texts, words)
    by_shingle = {}
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    root, pairs = list(range(len(texts))), set()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        met = Counter(j for x in s for j in by_shingle[x] if j < i)
        for j, k in met.items():
            if k >= least * (len(s) + len(sets[j]) - k):
                root[max(find(i), find(j))] = min(find(i), find(j))
                if s != sets[j]:
                    pairs.add((j, i))
    return [find(i) for i in range(len(texts))], pairs


def edited(words, rng, share):
    """A copy with some words replaced, and some lines' worth of words left out."""
    return [rng.choice(["neu", "andr", "etwas"]) + str(rng.randrange(99)) if rng.random() < share else w for w in words]


def test_recall_of_near_copies(make_docs):
    """Copies edited in up to two of a hundred words: links found against all pairs."""
    rng = random.Random(7)
    texts = []
    for _ in range(60):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 400))]
        texts.append(" ".join(base))
        texts += [" ".join(edited(base, rng, rng.choice([0.0, 0.005, 0.01, 0.02]))) for _ in range(4)]
        texts.append(" ".join(base[: int(len(base) * 0.85)]))
    rng.shuffle(texts)
    want, pairs = similar_components(texts)
    rows = simhash.similar_groups(make_docs(texts)).collect()
    root = {r.doc_id: r.root for r in rows}
    caught = sum(root[i] == root[j] for i, j in pairs)
    assert len(pairs) > 300 and caught >= 0.98 * len(pairs)
    assert all(want[i] == want[j] for i in range(len(texts)) for j in range(i) if root[i] == root[j])


def test_links_at_the_threshold_are_all_found(make_docs):
    """Pairs just at a similarity of 0.8 and above it: ends cut off, words replaced, texts of a few words."""
    rng = random.Random(11)
    texts = []
    for i in range(150):
        base = [f"v{rng.randrange(5000)}" for _ in range(rng.randrange(14, 120))]
        cut = base[: -(-4 * (len(base) - 4) // 5) + 4]
        at = rng.randrange(len(base))
        texts += [" ".join(base), " ".join(cut), " ".join([*base[:at], "anders", *base[at + 1 :]])]
    # Many texts that hold one passage and share no more, and copies in a chain whose ends are far apart.
    passage = [f"p{i}" for i in range(60)]
    texts += [" ".join([*passage, *(f"q{i}x{j}" for j in range(4 + i % 14))]) for i in range(120)]
    texts += [" ".join(f"c{j}" for j in range(i * 6, i * 6 + 80)) for i in range(40)]
    rng.shuffle(texts)
    want, pairs = similar_components(texts)
    assert len(pairs) > 300
    rows = simhash.similar_groups(make_docs(texts)).collect()
    root = {r.doc_id: r.root for r in rows}
    assert [root[i] == root[j] for i in range(len(texts)) for j in range(i)] == [want[i] == want[j] for i in range(len(texts)) for j in range(i)]


def test_near_copies_of_the_table(corpus):
    docs, texts = corpus
    want, pairs = similar_components([t for _, t in texts])
    root = {r.doc_id: r.root for r in simhash.similar_groups(docs).collect()}
    ids = [d for d, _ in texts]
    assert sum(root[ids[i]] == root[ids[j]] for i, j in pairs) >= 0.9 * len(pairs)
    kept = {r.doc_id for r in simhash.one_of_each(docs).collect()}
    assert len(kept) == len(set(root.values())) and {min(d for d in ids if root[d] == r) for r in root.values()} == kept


def test_one_of_each_on_odd_rows(odd_docs, make_docs):
    rows = simhash.one_of_each(odd_docs).collect()
    texts = {(r.text or "").encode().lower().decode() for r in odd_docs.collect()}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [0, 3, 4, 5, 6, 7, 9]  # none, "", blanks: one; "same text here": one
    assert sum(r.doc_id is None for r in rows) == 1 and len(texts) > len(rows)
    assert simhash.one_of_each(make_docs([])).collect() == []
    again = make_docs(["a b c d e f", "a b c d e f", "x"], [1, 1, 1])
    assert sorted(r.text for r in simhash.one_of_each(again).collect()) == ["a b c d e f", "x"]


def test_a_group_of_many_similar_texts(make_docs):
    """A third of all texts are near copies of one; classes in one group that are not similar go on without the hub."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(edited(base, rng, 0.004)) for _ in range(150)] + [" ".join(f"u{i}x{j}" for j in range(80)) for i in range(300)]
    kept = [r.doc_id for r in simhash.one_of_each(make_docs(texts)).collect()]
    assert sum(d < 150 for d in kept) == len(set(similar_components(texts[:150])[0])) and sum(d >= 150 for d in kept) == 300
