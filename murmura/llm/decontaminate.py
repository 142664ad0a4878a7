"""Benchmark decontamination by one Aho-Corasick automaton over normalised test items.

Words are runs of a-z, 0-9 and non-ASCII characters after A-Z are lower-cased. A window is ten consecutive
words of an item; an item of fewer words is one window. The automaton runs over word numbers, and each text
is scanned once; hits are mapped back to character offsets of the original text.

The automaton is built in each Python worker from the items' words, which are broadcast. Their size is
checked: items, large ones in pieces that overlap by a window, are dealt by hash into groups of about `max_bytes` of
text, each with its own automaton and pass, so a huge benchmark means more passes and never a larger automaton. The
driver holds one group at a time.

Defined cases: null texts have no words and no hits; items without words never occur; items that repeat an
id count as one; a null item id is the id "null"; empty tables give no rows or no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.llm.common import ASCII_LOWER, ASCII_UPPER, written

WINDOW = 10
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_KEPT = "0123456789" + ASCII_LOWER
_TABLE = bytes(c if c >= 128 or chr(c) in _KEPT else ord(chr(c).lower()) if chr(c) in ASCII_UPPER else 32 for c in range(256))
_LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)

HITS = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("word", "words", "start", "end")]))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Scanner:
    """The automaton of a group of items: a list of (item id, words)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            for i in range(max(1, len(ids) - window + 1)) if ids else ():
                owners.setdefault(tuple(ids[i : i + window]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, found in owners.items():
            self.automaton.add_word(ids, (len(ids), found))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged [first, last) runs of hit words, and the items found."""
        if self.empty or not words:
            return [], set()
        known = self.numbers.get
        runs: list[tuple[int, int]] = []
        found: set[str] = set()
        for last, (n, items) in self.automaton.iter(tuple([known(w, 0) for w in words])):
            start = last - n + 1
            while runs and runs[-1][1] >= start:
                start = min(start, runs.pop()[0])
            runs.append((start, last + 1))
            found |= items
        return runs, found


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pieces(benchmark: DataFrame, window: int, most: int) -> DataFrame:
    """item_id, text: items whose text has more than `most` bytes in pieces that share window - 1 words, so no window is lost."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str]] = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                at = 0
                while at < len(words):
                    size = np.cumsum([len(w) + 1 for w in words[at : at + most]])
                    n = max(int(np.searchsorted(size, most)), 2 * window)
                    out.append((item, b" ".join(words[at : at + n]).decode("utf-8", "surrogatepass")))
                    if at + n >= len(words):
                        break
                    at += n - window + 1
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in (0, 1)], names=["item_id", "text"])

    return items.filter("text IS NOT NULL").mapInArrow(run, items.schema)


def _groups(benchmark: DataFrame, window: int, max_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in groups of about `max_bytes`; the driver holds one at a time, and tasks cut them into words."""
    pieces = written(_pieces(benchmark, window, max(max_bytes // 16, 1)))
    total = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // max_bytes))
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for g in range(n):
        yield [(r.item_id, r.text) for r in pieces.filter(group == g).toLocalIterator()]


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = 16 << 20, carry: Sequence[str] = ()
) -> DataFrame:
    """doc_id, text, n_words, hits (runs of hit words with their character offsets), items (sorted ids).

    `carry` names further columns, given back in the struct `row`.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), rest.alias("row"))
    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("hits", HITS),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    hit_type = pa.list_(pa.struct([(n, pa.int32()) for n in ("word", "words", "start", "end")]))
    out = (
        rows.select("row", "doc_id", "text")
        .withColumn("n_words", F.lit(0).cast("long"))
        .withColumn("hits", F.array().cast(HITS))
        .withColumn("items", F.array().cast("array<string>"))
    )
    for items in _groups(benchmark, window, max_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            scanner = Scanner([(item, words_of(text)) for item, text in sent.value], window)
            for whole in batches:
                for at in range(0, whole.num_rows, 1000):
                    batch = whole.slice(at, 1000)
                    counts, hits, items = [], [], []
                    earlier = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
                    for text, old, had in zip(batch.column("text").to_pylist(), *earlier):
                        words = words_of(text)
                        runs, found = scanner.scan(words)
                        counts.append(len(words))
                        if runs:
                            runs = _merge([*runs, *((h["word"], h["word"] + h["words"]) for h in old)])
                            spans = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
                            old = [
                                {"word": a, "words": b - a, "start": spans[a][0], "end": spans[b - 1][1]}
                                for a, b in runs
                            ]
                            had = sorted({*had, *found})
                        hits.append(old)
                        items.append(had)
                    columns = [batch.column(c) for c in ("row", "doc_id", "text")] + [pa.array(counts, pa.int64())]
                    columns += [pa.array(hits, hit_type), pa.array(items, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        out = out.mapInArrow(run, schema)
    return out if carry else out.drop("row")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs, all columns, without a benchmark window in their text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    clean = scan(docs, benchmark, window, carry=rest).filter(F.size("hits") == 0)
    return clean.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
