"""Costly expressions and inputs are worked out once."""

import random

import pandas as pd
from pyspark.sql import functions as F

from murmura.functions import similarity as S
from murmura.functions.batch import edit_distances
from murmura.functions.text import sentences
from murmura.operators import canonical as C
from murmura.operators import classify as CL
from murmura.operators import lexicon as L
from murmura.operators import validate as V


def test_grounding_by_words_of_the_feedback(spark):
    """The words of a feedback, worked out once for its pains, give what its text gives."""
    rows = [(1, "App caiu!", "O app caiu de novo."), (2, "pix lento", "O app caiu"), (3, "", "x"), (4, "app", None), (5, None, "app")]
    pains = spark.createDataFrame(rows, "n int, dor_especifica string, feedback_text string")
    terms = spark.createDataFrame([("app",), ("pix",)], "term string")
    by_words = pains.withColumn("feedback_text", V.source_words(F.col("feedback_text")))
    cols = ["n", "semantic_coherence", "domain_relevance", "is_valid", "confidence_score", "overall_quality"]
    want = V.validate_grounding(pains, terms).select(*cols).orderBy("n").collect()
    assert V.validate_grounding(by_words, terms).select(*cols).orderBy("n").collect() == want
    assert [r.semantic_coherence for r in want] == [1.0, 0.0, 0.0, 0.0, 0.0]


def test_emergent_terms_read_their_texts_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def passed(frames):
        for frame in frames:
            seen.add(len(frame))
            yield pd.DataFrame({"t": ["boleto atrasado" if i % 2 else None if i % 4 else "boleto" for i in frame["id"]]})

    texts = spark.range(100).mapInPandas(passed, "t string")
    known = spark.createDataFrame([("atrasado",)], "term string")
    got = L.emergent_terms(texts, "t", known).collect()
    assert [(r.categoria, r.n, r.confidence) for r in got] == [("BOLETO", 75, 0.75)]
    assert seen.value == 100


def test_no_terms_emerge_from_few_texts(spark):
    texts = spark.createDataFrame([("boleto",)] * 49, "t string")
    known = spark.createDataFrame([("pix",)], "term string")
    assert L.emergent_terms(texts, "t", known).count() == 0
    assert L.emergent_terms(texts.limit(0), "t", known).count() == 0


def test_many_short_pieces_join_as_one_by_one(spark):
    text = "a. bb. ccc! dddddddddddd. e? " * 40 + "f" * 349 + ". g. " + "h, " * 50
    want: list[str] = []
    for piece in ["a", "bb", "ccc", "dddddddddddd", "e"] * 40 + ["f" * 349, "g"]:
        small = want and (len(want[-1]) < 10 or len(piece) < 10) and len(want[-1]) + 1 + len(piece) <= 350
        want = [*want[:-1], f"{want[-1]} {piece}"] if small else [*want, piece]
    got = spark.createDataFrame([(text,)], "t string").select(sentences(F.col("t")).alias("s")).first().s
    assert got[: len(want) - 1] == want[:-1] and got[len(want) - 1].startswith("g h,")
    assert " ".join(got).count("h,") == 50
    # The pieces are joined by marks, not by a list that is copied for each of them.
    plan = spark.createDataFrame([(text,)], "t string").select(sentences(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert "slice(" not in plan


def test_documents_are_chosen_before_they_are_cut(spark, tmp_path):
    """Only the documents that a side takes are cut into sentences; a join above the cutting would cut them all."""
    from workload.inputs import Tables

    docs = [(i, f"Texto {i}. Outro.", "pt", "src1", 15) for i in range(6)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(4)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    t = Tables(spark, str(tmp_path))
    assert {r.feedback_id for r in t.pains.collect()} == {"0", "2", "4", "5"} and t.store.count() == 2
    for side in (t.pains, t.store):
        plan = side._jdf.queryExecution().optimizedPlan().toString().splitlines()
        generate = next(i for i, line in enumerate(plan) if "Generate posexplode" in line)
        join = next(i for i, line in enumerate(plan) if "LeftAnti" in line or "LeftSemi" in line)
        assert generate < join


def test_single_blanks_are_left_alone(spark):
    from murmura import constants as K
    from murmura.functions.text import normalize_text

    rows = [" A  B\t\tc  d e ", "um dois tres", "a \n", "\t x", "fim... ja!!! ok. so!", "", None]
    df = spark.createDataFrame([(x,) for x in rows], "t string")
    got = [r[0] for r in df.select(normalize_text(F.col("t"))).collect()]
    assert got == ["a b c d e", "um dois tres", "a", "x", "fim. ja! ok. so!", "", None]
    changed = df.select(F.regexp_replace("t", K.UNEVEN_SPACE, "#")).collect()
    assert changed[1][0] == "um dois tres" and changed[2][0] == "a#"


def test_texts_are_normalised_once_below_tests_for_null(spark):
    from murmura.operators import match as M

    rows = [("Caiu  o App", "c", None, "p"), (None, "c", "f", "p")]
    df = spark.createDataFrame(rows, "t string, categoria string, familia string, produto string")
    normed = M.with_context(df, "t")
    assert [(r.familia, r.text_norm) for r in normed.collect()] == [(M.K.UNKNOWN, "caiu o app"), ("f", None)]
    kept = normed.filter(F.col(M.NORM).isNotNull()).select(*M.KEY).distinct()
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1
    assert kept.count() == 1


def test_edit_distances_of_a_batch(spark):
    pick = random.Random(3)
    texts = ["", "a", "ab" * 32, "ab" * 32 + "a", "aé漢😀" * 40]
    texts += ["".join(pick.choice("abc d") for _ in range(pick.choice([3, 63, 64, 65, 128, 129, 200]))) for _ in range(30)]
    pairs = [(a, b) for a in texts for b in texts]
    want = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.levenshtein("a", "b").alias("n")).collect()
    assert edit_distances([r.a for r in want], [r.b for r in want]).tolist() == [r.n for r in want]


def test_medoid_compares_two_texts_once(spark):
    """In Arrow batches and with the scores of the expression, which compares all ordered pairs and twice more."""
    pick = random.Random(5)
    words = ["app", "caiu", "pix", "lento", "não", "abre", "caiu"]
    lists = [[" ".join(pick.choices(words, k=pick.randint(0, 40))) for _ in range(pick.randint(1, 8))] for _ in range(60)]
    lists += [["um", None, "dois"], [None, "um"], ["um"], ["", "", " "]]
    rows = spark.createDataFrame(
        [(str(i), x[0], x[1:], None, None, None) for i, x in enumerate(lists)],
        "id string, canonical_text string, variants array<string>, consolidation_count long, last_consolidation string, improvement_reason string",
    )

    def got(**options):
        return C.consolidate_medoid(rows, "r", F.lit("2024-06-01"), gate=0.5, mean="mean", **options)

    assert got().orderBy("id").collect() == got(sequence=lambda a, b: S.edit_score(a, b)).orderBy("id").collect()
    assert "levenshtein" not in got()._jdf.queryExecution().optimizedPlan().toString()


def test_words_of_a_pain_are_found_once_for_all_runs(spark):
    texts = spark.createDataFrame([(1, "App caiu de novo"), (2, None), (3, "x")], "n int, t string")
    lexicon = spark.createDataFrame([("A", "app"), ("B", "de novo"), ("B", "novo")], "label string, term string")
    out = CL.classify(texts, "n", "t", lexicon, "l", max_words=3).orderBy("n")
    assert [(r.l, r.l_alternatives) for r in out.collect()] == [("B", ["A"]), ("INCONCLUSIVO", []), ("INCONCLUSIVO", [])]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1


def test_an_empty_store_keys_no_text(spark):
    from murmura.operators import match as M
    from murmura.schemas import CANONICAL

    pains = spark.createDataFrame([("1", "x", "f", "p", "app caiu")], "pain_id string, categoria string, familia string, produto string, dor_especifica string")
    out = M.match_cascade(pains, spark.createDataFrame([], CANONICAL), sequence="edit")
    assert out.columns == [*pains.columns, "canonical_id", "canonical_text", "similarity_score", "context_level"]
    assert [tuple(r)[5:] for r in out.collect()] == [(None, None, None, None)]
    assert "MapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_medoid_of_long_lists(spark, monkeypatch):
    """All variants take part, a bounded number of pairs at a time; the centre lies before the last five."""
    from murmura.functions import batch

    monkeypatch.setattr(batch, "PAIRS", 7)
    texts = ["q w e", *["o app caiu de novo"] * 6, "xyz abc", "um dois tres", "nada a ver", "zebra", "outra coisa"]
    means, firsts = batch.centrality([[*texts, None], ["um"], []])
    assert [len(x) for x in means] == [len(texts) + 1, 1, 0] and round(firsts[1][0], 9) == 1 and firsts[0][-1] == 1
    rows = spark.createDataFrame(
        [("1", texts[0], texts[1:], None, None, None)],
        "id string, canonical_text string, variants array<string>, consolidation_count long, last_consolidation string, improvement_reason string",
    )

    def got(**options):
        return C.consolidate_medoid(rows, "r", F.lit("2024-06-01"), gate=0.0, mean="mean", **options).collect()

    whole = got(read=None)
    assert whole == got(read=None, sequence=lambda a, b: S.edit_score(a, b))
    assert whole[0].canonical_text == "o app caiu de novo" and got()[0].canonical_text != "o app caiu de novo"


def test_the_medoid_query_compares_all_sentences(spark, tmp_path):
    from __spark_entry__ import queries

    text = "O app caiu de novo. " * 5 + " ".join(f"Frase {'abcdef'[i] * 9} bem outra {'uvwxyz'[i] * 7}." for i in range(6))
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["consolidate_medoid"](spark, str(tmp_path)).collect()
    assert [(r.id, r.medoid) for r in got] == [("1", "o app caiu de novo")]


def test_sequence_ratio_is_that_of_the_library(spark):
    from difflib import SequenceMatcher

    from murmura.functions.batch import sequence_ratio

    pick = random.Random(11)
    texts = ["", "a", "aaaa", "abab" * 30, "x" * 260 + "y", "caiu o app é 漢😀"]
    texts += ["".join(pick.choices("ab " if i % 2 else "abcdefgh ", k=pick.randint(1, 260))) for i in range(60)]
    texts += [t[: len(t) // 2] + "q" + t[len(t) // 3 :] for t in texts[-20:]]
    for a in texts:
        for b in texts[::3]:
            assert sequence_ratio(a, b) == SequenceMatcher(None, a, b, autojunk=False).ratio()
