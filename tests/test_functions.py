"""Scalars on hand-made rows."""

from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from murmura.functions import casts
from murmura.functions import similarity as S
from murmura.functions import text as X


def one(spark, col, **values):
    names = list(values)
    schema = ", ".join(f"{n} {'string' if v is None or isinstance(v, str) else 'array<double>'}" for n, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(col).first()[0]


@pytest.mark.parametrize("raw,want", [
    ("  Ação   É!!  fim... ", "acao e! fim."), ("", ""), ("A \tB\n\nC", "a b c"), ("ÑÜ", "nu"),
])
def test_normalize(spark, raw, want):
    assert one(spark, X.normalize_text(F.col("a")), a=raw) == want


@pytest.mark.parametrize("a,b,want", [("", "", 1.0), ("a", "", 0.0), ("a b", "b c", 1 / 3), ("a a", "a", 1.0)])
def test_jaccard(spark, a, b, want):
    assert one(spark, S.jaccard(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(want)


@pytest.mark.parametrize("a,b,want", [("abc", "xabcx", 1.0), ("xabcx", "abc", 1.0), ("abc", "abd", 0.0), ("", "a", 1.0)])
def test_containment(spark, a, b, want):
    assert one(spark, S.containment(F.col("a"), F.col("b")), a=a, b=b) == want


def order_score(a, b):
    wa, wb = a.split(), b.split()
    last_a, last_b = ({w: i for i, w in enumerate(ws)} for ws in (wa, wb))
    common = set(wa) & set(wb)
    return sum(1 - abs(last_a[w] / len(wa) - last_b[w] / len(wb)) for w in common) / len(common) if common else 0.0


@pytest.mark.parametrize("a,b", [("a b c", "c b a"), ("x", "y"), ("a b a", "a c"), ("", "a")])
def test_word_order(spark, a, b):
    assert one(spark, S.word_order(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(order_score(a, b))


@pytest.mark.parametrize("a,b", [("abcd", "bcda"), ("", ""), ("x" * 210 + "y", "y" + "x" * 210)])
@pytest.mark.parametrize("junk", [True, False])
def test_sequence_ratio(spark, a, b, junk):
    want = SequenceMatcher(None, a, b, autojunk=junk).ratio()
    assert one(spark, S.sequence_ratio(junk)(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(want)


def test_cosine(spark):
    c = S.cosine_mapped(F.col("a"), F.col("b"))
    assert one(spark, c, a=[1.0, 0.0], b=[0.0, 0.0]) == 0.0
    assert one(spark, c, a=[1.0, 0.0], b=[0.0, 2.0]) == pytest.approx(0.5)
    assert one(spark, c, a=[1.0, 2.0], b=[2.0, 4.0]) == pytest.approx(1.0)


@pytest.mark.parametrize("usage,popular,want", [(5, False, 1.0), (6, False, 1.05), (21, False, 1.05), (21, True, 1.10)])
def test_factor(spark, usage, popular, want):
    got = spark.range(1).select(S.canonical_factor(F.lit(1.0), F.lit(usage), popular)).first()[0]
    assert got == pytest.approx(want)


def test_generalize(spark):
    assert one(spark, X.generalize_text(F.col("a")), a="Taxa de 15% ao mês em 01/02/2024 de R$ 1.000,50") == "Taxa de ao mês em de"


def test_soft_casts(spark):
    assert one(spark, casts.soft_int(F.col("a")), a=" 7 ") == 7
    assert one(spark, casts.soft_int(F.col("a")), a="7.9") is None
    assert str(one(spark, casts.soft_timestamp(F.col("a")), a="2024-01-02")) == "2024-01-02 00:00:00"
    assert one(spark, casts.soft_timestamp(F.col("a")), a="02/01/2024") is None
    assert one(spark, casts.json_strings(F.col("a")), a="[bad") == []
    assert one(spark, casts.json_strings(F.col("a")), a='["x"]') == ["x"]
    assert one(spark, casts.json_strings(F.col("a")), a=None) == []
