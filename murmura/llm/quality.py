"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule votes good, bad or abstains on a document. The votes of all documents are counted by pattern (three
to the power of the rules, a bound that no corpus exceeds), and EM on these counts estimates the share of good
documents and each rule's accuracy on good and on bad ones; abstentions carry no weight. A document is kept if
the posterior probability of good is one half or more.

Toxic texts are told apart by a lexicon of insults, whatever their quality: `toxic` is true from `MIN_TOXIC` such
words and `TOXIC_SHARE` of all words on. It is a verdict of its own and takes no part in `kept`.

Defined cases: null texts have no words; a text without words gets abstentions only; ties (posterior one half)
are kept; repeated rows are judged alike and each counts as a vote; an empty table gives an empty table; other
columns of the input are carried by `kept_documents` only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.llm.common import map_batches, with_defaults, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: English insults, as in the texts labelled toxic; other languages need words of their own.
TOXIC_WORDS = frozenset(b"clown disgusting idiot loser moron pathetic scum stupid trash worthless".split())
MIN_TOXIC, TOXIC_SHARE = 2, 0.005

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_WIDE = bytes(range(128, 256))
_APART = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_MARKS = bytes(c for c in range(33, 128) if not chr(c).isalnum())

STATS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType())]
    + [
        T.StructField(n, T.LongType())
        for n in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_wide", "n_bare", "n_top_word", "n_toxic")
    ]
)


def n_bytes(data: bytes, kinds: bytes) -> int:
    return len(data) - len(data.translate(None, kinds))


def text_stats(text: str | None) -> tuple[int, ...]:
    """The counts of STATS of one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "surrogatepass"))
    lines = [line for line in text.split("\n") if line.encode("utf-8", "surrogatepass").split()]
    grams = list(zip(words, words[1:], words[2:]))
    repeats = 0
    if len(set(grams)) < len(grams):
        counts = Counter(grams)
        reach = 0  # words before this index are counted
        for i, g in enumerate(grams):
            if counts[g] > 1:
                repeats += i + 3 - max(reach, i)
                reach = i + 3
    upper = n_bytes(joined, _UPPER)
    letters = n_bytes(joined, _LETTERS)
    wide = chars - len(joined.translate(None, _WIDE))
    bare = n - len(b" ".join(words).translate(None, _MARKS).split())
    top = Counter(words).most_common(1)[0][1] if n else 0
    toxic = sum(map(TOXIC_WORDS.__contains__, text.encode("utf-8", "surrogatepass").lower().translate(_APART).split()))
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeats, upper, letters, wide, bare, top, toxic


def stats(docs: DataFrame) -> DataFrame:
    """One row per document with the counts that the rules read, over whole texts."""

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        found = [text_stats(t) for t in batch.column("text").to_pylist()]
        columns = list(zip(*found)) if found else [()] * (len(STATS) - 2)
        return {n: batch.column(n) for n in STATS.names[:2]} | dict(zip(STATS.names[2:], columns))

    rows = with_defaults(docs, doc_id="long", text="string")
    return map_batches(rows.withColumn("text_hash", F.xxhash64("text")), run, STATS)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def toxic() -> Column:
    return (F.col("n_toxic") >= MIN_TOXIC) & (F.col("n_toxic") >= TOXIC_SHARE * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Name to vote: 1 good, 0 bad, null abstains."""
    n = F.col("n_words")

    def share(part: str, of: Column | str, good: float, bad: float, least: int = 1) -> Column:
        of = F.col(of) if isinstance(of, str) else of
        x = F.col(part) / F.greatest(of, F.lit(1))
        return F.when(of < least, None).when(x <= good, 1).when(x >= bad, 0)

    letters = (F.col("n_letters") + F.col("n_wide")) / F.greatest(F.col("word_chars"), F.lit(1))
    mean = F.col("word_chars") / F.greatest(n, F.lit(1))
    return {
        "symbols": share("n_symbols", n, 0.02, 0.1),
        "letters": F.when(F.col("word_chars") < 20, None).when(letters >= 0.9, 1).when(letters <= 0.8, 0),
        "bare_marks": share("n_bare", n, 0.02, 0.15, least=10),
        "repeats": share("n_repeat_words", n, 0.15, 0.35, least=10),
        "lines": share("n_dup_lines", "n_lines", 0.1, 0.35, least=4),
        "capitals": share("n_upper", "n_letters", 0.12, 0.4, least=20),
        "top_word": share("n_top_word", n, 0.12, 0.3, least=30),
        "word_length": F.when(n < 10, None).when(mean.between(3.5, 8.0), 1).when((mean < 2.5) | (mean > 12.0), 0),
    }


class Model(NamedTuple):
    prior: float
    #: For each rule: the chance of a good vote on a good document and of a bad vote on a bad one.
    on_good: list[float]
    on_bad: list[float]


def fit(patterns: Mapping[tuple[int | None, ...], int], n_rules: int, steps: int = 200) -> Model:
    """EM over vote patterns with their counts. Starts from rules that are seldom wrong on good documents."""
    votes = np.array([[-1 if v is None else v for v in p] for p in patterns], dtype=int).reshape(-1, n_rules)
    weight = np.array(list(patterns.values()), dtype=float)
    prior, good, bad = 0.9, np.full(n_rules, 0.99), np.full(n_rules, 0.4)
    for _ in range(steps if len(weight) else 0):
        p = _posterior(votes, prior, good, bad)
        old = prior
        g, b = weight * p, weight * (1 - p)
        prior = float(np.clip((g.sum() + 9) / (weight.sum() + 10), 0.01, 0.99))
        for j in range(n_rules):
            voted, yes = votes[:, j] >= 0, votes[:, j] == 1
            # A rule that says nothing stays near its start; none may turn round.
            good[j] = np.clip((g[yes].sum() + 9.9) / (g[voted].sum() + 10), 0.5, 0.9999)
            bad[j] = np.clip((b[voted & ~yes].sum() + 4) / (b[voted].sum() + 10), 0.01, 0.9999)
        if abs(prior - old) < 1e-10:
            break
    return Model(prior, good.tolist(), bad.tolist())


def _posterior(votes: np.ndarray, prior: float, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    yes, no = votes == 1, votes == 0
    odds = np.log(prior / (1 - prior)) + yes @ np.log(good / (1 - bad)) + no @ np.log((1 - good) / bad)
    return 1 / (1 + np.exp(-odds))


def posterior(model: Model, votes: Sequence[Column]) -> Column:
    odds = F.lit(float(np.log(model.prior / (1 - model.prior))))
    for vote, good, bad in zip(votes, model.on_good, model.on_bad):
        odds = odds + F.when(vote == 1, float(np.log(good / (1 - bad)))).when(vote == 0, float(np.log((1 - good) / bad))).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame) -> DataFrame:
    """The counts of each document, base_failed, toxic, the posterior p_good, and kept."""
    named = rules()
    counted = written(stats(docs))
    voted = counted.select(*[c.cast("int").alias(n) for n, c in named.items()])
    found = voted.groupBy(*named).count().collect()  # 3 ** rules rows at most
    model = fit({tuple(r[n] for n in named): r["count"] for r in found}, len(named))
    p = posterior(model, list(named.values()))
    return counted.withColumns({"base_failed": base_failed(), "toxic": toxic(), "p_good": p}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5)
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that are kept."""
    kept = judge(docs).filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__hash"))
    return docs.join(kept, same, "left_semi")
