"""Matching by vectors against all pairs, and how many pairs it compares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura import constants as K
from murmura.operators import embeddings as E
from murmura.operators import vectormatch as VM

PAIN = "pid int, dor_especifica string, categoria string, familia string, produto string, embedding array<double>"
CANONICAL = "id string, canonical_text string, categoria string, familia string, produto string, embedding array<double>, creation_date date, confidence_score double, usage_count int"


def clustered(rng, n, centres, spread):
    at = centres[rng.integers(0, len(centres), n)]
    return at + spread * rng.normal(size=at.shape)


def tables(spark, rng, pains, canonicals):
    def context(i):
        return (f"c{i % 2}", K.UNKNOWN if i % 5 == 0 else f"f{i % 3}", f"p{i % 4}")

    p = [(i, f"texto {i % 50}" if i % 9 == 0 else f"dor {i}", *context(i), v.tolist()) for i, v in enumerate(pains)]
    c = [(f"k{i:04}", f"texto {i}" if i < 40 else f"canonica {i}", *context(i + 1), v.tolist(), None, 0.3 + 0.7 * rng.random(), int(rng.integers(0, 9)))
         for i, v in enumerate(canonicals)]
    return p, c, spark.createDataFrame(p, PAIN), spark.createDataFrame(c, CANONICAL).withColumn("creation_date", F.lit("2024-01-01").cast("date"))


def all_pairs(pains, canonicals, band=True):
    out = {}
    for pid, text, cat, fam, prod, v in pains:
        best = None
        for cid, ctext, ccat, cfam, cprod, w, _, conf, usage in canonicals:
            v_, w_ = np.array(v), np.array(w)
            if ccat != cat or not v_.any() or not w_.any():
                continue
            score = min(max((v_ @ w_ / np.linalg.norm(v_) / np.linalg.norm(w_) + 1) / 2, 0), 1)
            by = K.METHOD_FACTORS["embedding_plus_llm" if band and 0.6 <= score <= 0.8 else "embeddings_only"]
            if text == ctext:
                score = by = 1.0
            for no, name, factor in K.TIERS:
                if no < 3 and not (fam == cfam != K.UNKNOWN) or no == 1 and prod != cprod:
                    continue
                adjusted = min(score * (0.8 + 0.2 * conf) * (1.05 if usage > 5 else 1) * factor * by, 1.0)
                if adjusted >= K.INITIAL_THRESHOLDS[name]:
                    offer = (no, -adjusted, cid)
                    best = min(best, offer) if best else offer
        out[pid] = best
    return out


def check(frame, want):
    rows = frame.collect()
    levels = {no: name for no, name, _ in K.TIERS}
    assert len(rows) == len(want)
    for r in rows:
        offer = want[r.pid]
        if offer is None:
            assert r.canonical_id is None and r.similarity_score is None
        else:
            assert (r.canonical_id, r.context_level) == (offer[2], levels[offer[0]]) and abs(r.similarity_score + offer[1]) < 1e-9
    return sum(r.pairs for r in rows)


@pytest.mark.parametrize("band", [True, False])
def test_as_all_pairs(spark, monkeypatch, band):
    """Random vectors, where no ball can be left out, zeros and small cuts."""
    monkeypatch.setattr(VM, "CUT", 16)
    rng = np.random.default_rng(1)
    pains, canonicals = rng.normal(size=(60, 6)), rng.normal(size=(90, 6))
    pains[3] = canonicals[5] = 0
    p, c, pf, cf = tables(spark, rng, pains, canonicals)
    check(VM.match_vectors(pf, cf, band=band, many=8), all_pairs(p, c, band))


def test_clusters_are_pruned(spark):
    """Vectors around forty centres: the results of all pairs from a fraction of them."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 32))
    p, c, pf, cf = tables(spark, rng, clustered(rng, 240, centres, 0.05), clustered(rng, 400, centres, 0.05))
    compared = check(VM.match_vectors(pf, cf, tiers=(3,), many=128), all_pairs_semantic(p, c))
    assert compared < 0.3 * 240 * 400 / 2


def all_pairs_semantic(pains, canonicals):
    return all_pairs([(a, b, c, K.UNKNOWN, d, v) for a, b, c, _, d, v in pains], canonicals)


def test_empty_sides_missing_vectors_and_copies(spark):
    rng = np.random.default_rng(3)
    p, c, pf, cf = tables(spark, rng, rng.normal(size=(12, 4)), rng.normal(size=(6, 4)))
    assert all(r.canonical_id is None for r in VM.match_vectors(pf, cf.limit(0)).collect())
    assert VM.match_vectors(pf.limit(0), cf).collect() == []
    loose = pf.withColumn("embedding", F.when(F.col("pid") > 5, F.col("embedding")))
    rows = VM.match_vectors(loose.unionByName(loose), cf).collect()
    assert len(rows) == 24 and all(r.canonical_id is None for r in rows if r.pid <= 5)


def test_each_text_is_embedded_once_and_joined_back(spark):
    texts = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "text_norm string")
    known = spark.createDataFrame([("a", [1.0, 0.0])], "text_norm string, embedding array<double>")
    missing = E.misses(texts, known)
    made = missing.withColumn("embedding", F.array(F.lit(0.0), F.lit(1.0)))
    rows = E.with_vectors(texts, known.unionByName(made)).collect()
    assert sorted((r.text_norm, r.embedding) for r in rows) == [("a", [1.0, 0.0])] * 2 + [("b", [0.0, 1.0]), ("c", [0.0, 1.0])]


def test_small_balls_share_a_bin(spark):
    """A pain travels once for each cut of a bin; it went once for each ball before."""
    ball = F.when(F.col("id") < 500, F.col("id") % 50).otherwise(50).cast("int")
    inside = spark.range(20_500).select(F.lit("b").alias("block"), ball.alias("ball"), F.lit(0.1).alias("angle"), F.lit(1.0).alias("factor"))
    rows = VM._binned(inside, spark.range(3000).select(F.lit("b").alias("block"))).collect()
    assert len(rows) == 51 and {(r.bin, r.cuts) for r in rows} == {(0, 4)} and {r.parts for r in rows} == {3}
