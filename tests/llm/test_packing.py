import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from murmura.llm import packing
from murmura.llm.queries import op2_best_fit_packing, tokenizer_path


def check(rows, texts, capacity=2048):
    """Every piece once, whole texts, gapless sequences within the capacity."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    got, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for doc, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            want[doc].append((piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in want.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def packed(docs):
    return packing.place(packing.pieces(docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids")))


def test_whole_table(spark, corpus):
    _, texts = corpus
    rows = op2_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    n = check(rows, texts)
    assert n <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_odd_texts(odd_docs):
    check(packed(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])


def test_empty_table(make_docs):
    assert packed(make_docs([])).collect() == []


def test_fast_path_equals_the_tokenizer():
    bpe = packing.ByteBpe(tokenizer_path())
    rnd = random.Random(3)
    signs = ["a", "bc", "É", "ß", "1", "23", " ", "  ", "\n", "\t", "\r\n", "!", "?!", "-", "'s", "'", "中", "\x85", "\xa0", "\x1c", "×", "<|endoftext|>"]
    for chosen in (signs, signs[:14]):
        texts = ["".join(rnd.choices(chosen, k=rnd.randint(0, 40))) for _ in range(3000)]
        assert all(map(np.array_equal, bpe.encode(texts), bpe.encode_whole(texts)))


def test_words_of_one_hash_keep_their_own_ids():
    """The Thue-Morse word and its mirror image have equal polynomial hashes modulo 2^64."""
    bpe = packing.ByteBpe(tokenizer_path())
    for bits in (10, 11, 12):
        word = "".join("ab"[i.bit_count() % 2] for i in range(1 << bits))
        mirror = word.translate(str.maketrans("ab", "ba"))
        texts = [word, mirror, f"{word} {mirror} end"]
        assert all(map(np.array_equal, bpe.encode(texts), bpe.encode_whole(texts)))
        # Also when the first has been met before.
        assert np.array_equal(bpe.encode([mirror])[0], bpe.encode_whole([mirror])[0])


def test_plan_places_every_length_once_and_packs_well():
    rnd = random.Random(5)
    for _ in range(200):
        capacity = rnd.choice([10, 37, 100])
        histogram = {n: rnd.randint(1, 9) for n in range(1, capacity + 1) if rnd.random() < 0.4}
        seen, bins = defaultdict(set), defaultdict(list)
        for length, rank, first, many, each, offset in packing.plan(histogram, capacity):
            for k in range(many * each):
                seen[length].add(rank + k)
                bins[first + k // each].append((offset + k % each * length, length))
        assert {n: len(v) for n, v in seen.items()} == histogram
        for places in bins.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
            assert sum(3 * n > capacity for _, n in places) <= 2
        assert len(bins) <= best_fit_decreasing(histogram, capacity)


def best_fit_decreasing(histogram, capacity):
    gaps = []
    for n in sorted(Counter(histogram).elements(), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_sequences_hold_the_ids(make_docs):
    docs = make_docs(["a b c", "d e", None])
    cut = packing.pieces(docs, tokenizer_path(), capacity=4)
    rows = packing.sequences(packing.place(cut, capacity=4)).collect()
    ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in rows])
    assert Counter(ids.tolist()) == Counter(np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in cut.collect()]).tolist())
    assert all(len(r.ids) <= 16 for r in rows)
