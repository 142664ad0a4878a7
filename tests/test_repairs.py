"""Nothing is dropped at the mouth of the pipeline, and counts follow what was extracted."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from murmura import constants as K
from murmura.functions import casts
from murmura.functions.similarity import canonical_factor
from murmura.functions.text import sentences
from murmura.operators import batches as B
from murmura.operators import classify as CL
from murmura.operators import extract as EX
from murmura.operators import lexicon as L
from murmura.plans import job
from murmura.plans import normalize as N
from murmura.plans.results import pain_lists
from murmura.schemas import CANONICAL
from tests.test_plans import canonicals, day, lexicons


def test_every_word_is_in_a_piece(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choices(["a", "bcd ", "efghij ", ", ", "; ", ".", "\n", "  ", "x" * 60 + " ", "é"], k=rnd.randint(0, 900))) for _ in range(60)]
    texts += ["", ".", "w" * 1200, "short. a. b. c", "no stops " * 300]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", sentences(F.col("t")).alias("s")).collect()
    for r in rows:
        assert re.sub(r"[.!?\s]", "", r.t) == re.sub(r"\s", "", "".join(r.s))
        assert all(0 < len(p) <= K.MAX_PAIN_CHARS for p in r.s)
        if all(len(w) <= K.MAX_PAIN_CHARS for w in re.split(r"[.!?\s]+", r.t)):
            assert re.findall(r"[^\s.!?]+", r.t) == [w for p in r.s for w in p.split()]


def test_no_cap_by_default(spark):
    text = ". ".join(f"o aplicativo tem erro numero {i}x" for i in range(30))
    fb = spark.createDataFrame([("f", text)], "feedback_id string, feedback_text string")
    cues = spark.createDataFrame([("erro",)], "term string")
    assert EX.extract_pains(fb, cues).count() == 30
    assert EX.extract_pains(fb, cues, cap=7).count() == 7


def test_soft_int_of_numbers(spark):
    row = spark.sql("select 9.0d a, double('nan') b, 1e12 c, '9.0' d").select(
        casts.soft_int(F.col("a"), True).alias("a"), casts.soft_int(F.col("b"), True).alias("b"),
        casts.soft_int(F.col("c"), True).alias("c"), casts.soft_int(F.col("d")).alias("d")).first()
    assert (row.a, row.c, row.d) == (9, None, None) and row.b in (0, None)


@pytest.mark.parametrize("confidence,factor", [(1.2, 1.0), (-1.0, 0.8), (None, 1.0)])
def test_confidence_is_held_to_its_range(spark, confidence, factor):
    row = spark.createDataFrame([(confidence, 0)], "c double, u int").select(canonical_factor(F.col("c"), F.col("u")).alias("f")).first()
    assert row.f == pytest.approx(factor)


def test_counts_of_invalid_pains(spark):
    cols = "feedback_id string, pos int, canonical_id string, context_level string, confidence double"
    normalized = spark.createDataFrame([("a", 0, "c", "new", 1.0)], cols)
    extracted = spark.createDataFrame([("a",), ("a",), ("b",)], "feedback_id string")
    got = {r.feedback_id: (r.total_dores_extraidas, r.total_dores_normalizadas, r.invalid_filtered) for r in pain_lists(normalized, extracted).collect()}
    assert got == {"a": (2, 1, 1), "b": (1, None, 1)}


def test_job_counts_and_reasons(spark):
    fb = spark.createDataFrame(
        [("1", "App muito lento, demora para abrir. Erro no app, zzz xxx yyy www"), ("2", "tudo com erro aqui, nada funciona"), ("3", "Excelente")],
        "feedback_id string, feedback_text string")
    catalog = spark.createDataFrame([("Canais", "Aplicativo")], "familia string, produto string")
    lex = lexicons(spark) | {"domain": spark.createDataFrame([("lento",)], "term string")}
    rows, _ = job.run(fb, spark.createDataFrame([], CANONICAL), lex, catalog, "r", F.lit("2024-06-01"), sequence="edit")
    got = {r.feedback_id: (r.total_dores_extraidas, json.loads(r.normalizacao_stats_json)) for r in rows.collect()}
    assert got["1"][0] == 2 and got["1"][1]["invalid_filtered"] == 1 and got["1"][1]["normalized_count"] == 1
    assert got["2"][1]["early_exit_reasons"] == ["all_unknown"] and got["2"][0] == 1
    assert got["3"][1]["early_exit_reasons"] == ["no_pains", "low_confidence"] and got["3"][0] == 0


def test_an_inactive_row_is_not_replaced(spark):
    pain = spark.createDataFrame([("p", "f", 0, "fila enorme na agencia", "A", "f1", "p1")],
                                 "pain_id string, feedback_id string, pos int, dor_especifica string, categoria string, familia string, produto string")
    first = N.normalize_batch(pain, spark.createDataFrame([], CANONICAL), "r1", day(), sequence="edit")
    old = first.created.withColumns({"is_active": F.lit(False), "usage_count": F.lit(500).cast("long")})
    second = N.normalize_batch(pain, old, "r2", day(), sequence="edit")
    after = sorted((r.is_active, r.usage_count) for r in N.next_store(old, second).collect())
    assert after == [(False, 500), (True, 1)]


def test_classification_forms_agree(spark):
    texts = spark.createDataFrame([(1, "a b b c", "x"), (2, "c", "y"), (3, "", None), (4, None, "x"), (5, "a b z q", "x")], "k int, t string, f string")
    for lex in (
        spark.createDataFrame([("L1", "a"), ("L2", "b"), ("L3", "c"), ("L1", "c"), ("L4", "a b")], "label string, term string"),
        spark.createDataFrame([("L1", "a", "x"), ("L2", "b", "y"), ("L3", "c", "y")], "label string, term string, f string"),
        spark.createDataFrame([], "label string, term string"),
    ):
        for ties in (False, True):
            both = [sorted(f(texts, "k", "t", lex, "n", max_words=2, keep=("f",), ties_unknown=ties).collect(), key=str) for f in (CL.classify, CL.classify_by_join)]
            assert both[0] == both[1]


def test_batches_over_many_spans(spark, monkeypatch):
    monkeypatch.setattr(B, "FAN", 3)
    rows = spark.range(500).select((F.col("id") * 7).alias("o"))
    got = {r.o: r.batch_index for r in B.batch_assign(rows, "o", F.floor(F.col("o") / 50), 10).collect()}
    assert got == {7 * i: i // 10 for i in range(500)}


def test_emergent_terms_need_no_language(spark):
    texts = spark.createDataFrame([(f"fila longa {i}",) for i in range(60)], "t string")
    found = L.emergent_terms(texts, "t", spark.createDataFrame([("fila",)], "term string"))
    assert [r.categoria for r in found.collect()] == ["LONGA"]


def test_similar_new_texts_of_a_batch_merge(spark):
    texts = ["o aplicativo trava ao abrir a conta hoje", "o aplicativo trava ao abrir a conta", "fila enorme na agencia do centro",
             "o aplicativo trava ao abrir a conta hoje sempre", "o aplicativo trava ao abrir a conta hoje"]
    rows = [(f"p{i}", "f", i, t, "A", "f1", "p1", 0.4 if i == 1 else 1.0) for i, t in enumerate(texts)]
    pains = spark.createDataFrame(rows, "pain_id string, feedback_id string, pos int, dor_especifica string, categoria string, familia string, produto string, confidence_score double")
    empty = spark.createDataFrame([], CANONICAL)
    apart = N.normalize_batch(pains, empty, "r", day(), sequence="edit", merge_within=False)
    assert apart.created.unionByName(apart.updated).count() == 3
    batch = N.normalize_batch(pains, empty, "r", day(), sequence="edit")
    got = {r.pain_id: (r.context_level, r.canonical_text) for r in batch.normalized.collect()}
    assert got["p3"] == ("trio", texts[0]) and got["p4"] == ("trio", texts[0]) and got["p2"][0] == "new"
    assert len(got) == 5
    store = N.next_store(empty, batch)
    # The unsure pain p1 creates nothing, but merges into the canonical before it.
    assert got["p1"] == ("trio", texts[0])
    assert {r.canonical_text: r.usage_count for r in store.collect()} == {texts[0]: 4, texts[2]: 1}
