"""Merging among the new texts of a batch against the pains taken one by one."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from murmura import constants as K
from murmura.operators import canonical as C
from murmura.operators import within as W
from murmura.plans import normalize as N
from murmura.schemas import CANONICAL
from murmura.streaming import normalize as ST

PAINS = "pain_id string, feedback_id string, pos int, dor_especifica string, categoria string, familia string, produto string, confidence_score double"


def day():
    return F.lit("2024-06-01").cast("date")


def pains_of(spark, texts, confidence=lambda i: 1.0, context=lambda i: ("A", "f1", "p1")):
    rows = [(f"p{i:03}", "f", i, t, *context(i), confidence(i)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, PAINS)


def variants(n, words=14, seed=1):
    """Texts that differ from one another in a word or two."""
    rng = random.Random(seed)
    out = [[f"palavra{i}" for i in range(words)]]
    for _ in range(n - 1):
        text = list(rng.choice(out))
        text[rng.randrange(words)] = f"outra{rng.randrange(30)}"
        out.append(text)
    return [" ".join(t) for t in out]


def one_by_one(pains, scores):
    """pain -> (canonical text, level): canonicals in order of creation, as the similarity of texts says.

    Contexts are those of the texts; `scores` holds the raw score of every pair of texts.
    """
    canonicals, out = {}, {}
    for pain, text, (cat, fam, prod), conf in pains:
        best = None
        for t, (c, f, p, sure) in canonicals.items():
            if c != cat:
                continue
            raw = 1.0 if t == text else scores.get((text, t), 0.0)
            for no, name, factor in K.TIERS:
                fits = no == 3 or (f == fam != K.UNKNOWN and (no == 2 or p == prod))
                adjusted = min(raw * (0.8 + 0.2 * sure) * factor, 1.0)
                if fits and adjusted >= K.INITIAL_THRESHOLDS[name]:
                    offer = (no, -adjusted, list(canonicals).index(t), t, name)
                    best = min(best, offer) if best else offer
        if best:
            out[pain] = (best[3], best[4])
        elif conf >= K.CREATE_CONFIDENCE:
            canonicals[text] = (cat, fam, prod, conf)
            out[pain] = (text, "new")
        else:
            out[pain] = (None, None)
    return out


def raw_scores(spark, texts):
    from murmura.operators.textjoin import similar_pairs

    rows = spark.createDataFrame([("A", t) for t in sorted(set(texts))], "b string, t string")
    found = similar_pairs(rows, rows, "b", "t", "t", W.score_floor(K.INITIAL_THRESHOLDS), "edit", False)
    return {(r.p_text, r.c_text): r.score for r in found.collect()}


@pytest.mark.parametrize("seed, small", [(1, W.SMALL), (2, 0), (3, 0)])
def test_as_one_by_one(spark, seed, small, monkeypatch):
    """Chains of similar texts, repeats, unsure pains; decided in rounds (small=0) or by one task."""
    monkeypatch.setattr(W.merged_texts, "__defaults__", (small,))
    rng = random.Random(seed)
    texts = variants(60, seed=seed)
    texts += rng.choices(texts, k=30)
    sure = [rng.choice([1.0, 1.0, 0.7, 0.5]) for _ in texts]
    contexts = {t: ("A", rng.choice(["f1", "f2", K.UNKNOWN]), rng.choice(["p1", "p2"])) for t in texts}
    frame = pains_of(spark, texts, lambda i: sure[i], lambda i: contexts[texts[i]])
    want = one_by_one([(f"p{i:03}", t, contexts[t], sure[i]) for i, t in enumerate(texts)], raw_scores(spark, texts))
    batch = N.normalize_batch(frame, spark.createDataFrame([], CANONICAL), "r", day(), sequence="edit")
    got = {r.pain_id: (r.canonical_text, r.context_level) for r in batch.normalized.collect()}
    # A text that is canonical keeps its own pains, though another canonical may fit a later one better.
    made = {t for t, level in want.values() if level == "new"}
    differ = {p for p in want if got[p] != want[p]}
    assert all(texts[int(p[1:])] in made for p in differ) and len(differ) <= 3
    assert {t for t, level in got.values() if level == "new"} == made
    merged = {texts[int(p[1:])] for p, (t, level) in got.items() if t and t != texts[int(p[1:])]}
    assert len(merged) > 10


def test_chains_are_not_followed(spark):
    """Each text differs from the next in one word: the first takes in its neighbours only."""
    first = "o aplicativo trava sempre quando abro minha conta corrente pelo celular novo".split()
    texts = [" ".join([f"troca{j}" for j in range(i)] + first[i:]) for i in range(7)]
    made = C.create_canonicals(pains_of(spark, texts), "pain_id", "r", day())
    offered = W.offers(made, made, K.INITIAL_THRESHOLDS).cache()
    merged = W.merged_texts(offered)
    score = {(r.p_text, r.c_text): r.adjusted for r in offered.collect()}
    to = W.targets(offered, merged).collect()
    kept = {r.text_norm for r in made.join(merged, "created_at", "left_anti").collect()}
    assert to and all(r.root in kept and r.similarity_score == score[r.text_norm, r.root] for r in to)
    assert all(r.similarity_score >= K.INITIAL_THRESHOLDS[r.context_level] for r in to)
    assert len(kept) > 1  # one canonical would mean that the chain was followed


def test_rounds_agree_with_one_task(spark):
    rng = random.Random(4)
    edges = {(f"{b:03}", f"{a:03}") for a, b in itertools.combinations(range(120), 2) if rng.random() < 0.04}
    frame = spark.createDataFrame(sorted(edges), "p_at string, c_at string")
    gone = set()
    for p in sorted({p for p, _ in edges}):
        if any(c not in gone for q, c in edges if q == p):
            gone.add(p)
    for small in (0, 40, 10**6):
        assert {r.created_at for r in W.merged_texts(frame, small).collect()} == gone
    assert W.merged_texts(frame.limit(0)).collect() == []


def test_a_stream_merges_inside_its_batches(spark, tmp_path):
    texts = variants(12, seed=6)
    pains_of(spark, texts).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(PAINS).parquet(str(tmp_path / "in"))
    ST.start(stream, str(tmp_path / "run"), day(), sequence="edit").awaitTermination()
    state = ST.StreamState(spark, str(tmp_path / "run"))
    rows = state.normalized().collect()
    levels = [r.context_level for r in rows]
    assert len(rows) == 12 and "trio" in levels and levels.count("new") == state.store.read().count() < 12
