"""Collocations of two to four words, counted in an FM-index per shard over word ids.

Shards. Every task turns its texts into word numbers of its own, per language, cut to shards of a bounded number of
words; 0 stands where no phrase goes on (piece ends). Words are summed over shards, and what is too rare for any
phrase becomes a 0 too, as a phrase is no more frequent than its words.

Index. A shard's rows (the suffixes of its numbers, as a ring) are sorted by their first four words, which is all
that phrases of four words can tell apart, and kept as their Burrows-Wheeler transform. A stable sort of the
transform gives `psi`, from each row to the row one word further on, the inverse of backward search's step. Rows
that begin with a phrase are an interval. A phrase of m + 1 words is where an interval of m words is split by the
intervals that psi leads to: the interval itself is the phrase without its last word (so this extends to the right),
the one reached by psi the phrase without its first (to the left), and both come with their counts.

Sums. Pairs of words are summed over the shards first. Phrases of three and four words are given out only if all
their pairs may be frequent in the whole corpus, by a bitmap of the frequent pairs. The bitmap has a fixed number of
bits, which bounds what is broadcast; the fuller it is, the fewer rare phrases it keeps back, while sums and results
stay the same. Phrases are named by the ids of their words and dealt by their first word, frequent first words also by
what follows, so that none is one task's work; a shard gives out a row of arrays for each hand that is dealt.

Defined cases: null texts are empty; a null language is `und`; texts without words add nothing; repeated rows count
each; a text of any length is read in bounded pieces; ties are broken by frequency, then by phrase, in UTF-8 byte
order; an empty table gives an empty table; other columns are not carried.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from murmura.llm.common import written

WORDS = 4
SHARD_WORDS = 1 << 22
#: Shards one task may give out: shard numbers are task * SHARDS_A_TASK + i.
SHARDS_A_TASK = 1 << 12
_CHUNK = 1 << 20
_BREAKS = b",;:!?\n\x0b\x0c\r"
_SPACED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _BREAKS, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(_BREAKS))

SHARDS = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("words", T.ArrayType(T.BinaryType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("numbers", T.BinaryType()),
    ]
)
INDEX = T.StructType([T.StructField(n, T.BinaryType()) for n in ("bwt", "ids", "splits")])
#: Bits of the map of frequent phrases.
BITS = 1 << 26
#: Words of a frequency above this have their phrases dealt apart; hands dealt for each shuffle partition.
HOT, HANDS = 1 << 20, 8


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed byte by byte of significance: most upper bytes are alike."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _without_runs(numbers: np.ndarray) -> np.ndarray:
    """Runs of breaks say no more than one."""
    return numbers[np.append(True, (numbers[1:] != 0) | (numbers[:-1] != 0))]


class _Numbers(dict):
    """Word to number, from 1 on in order of first use; the mark of a break is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1


class _Shard:
    def __init__(self) -> None:
        self.of, self.numbers = _Numbers({b".": 0}), array("i", [0])

    def add(self, text: bytes) -> None:
        at = 0
        while at < len(text):
            stop = min(at + _CHUNK, len(text))
            while stop < len(text) and text[stop] not in b" \t.,;:!?\n\x0b\x0c\r":
                stop += 1
            words = text[at:stop].translate(_SPACED).replace(b".", b" . ").split()
            self.numbers.extend(map(self.of.__getitem__, words))
            at = stop
        self.numbers.append(0)

    def row(self, shard: int, lang: str) -> dict:
        """Words are numbered by their count, so that frequent ones have small numbers."""
        used = _without_runs(np.array(self.numbers, np.int32))
        counts = np.bincount(used, minlength=len(self.of))[1:]
        order = np.argsort(-counts, kind="stable")
        number = np.zeros(len(self.of), np.int32)
        number[order + 1] = np.arange(1, len(order) + 1)
        words = list(self.of)[1:]
        return {"shard": shard, "lang": lang, "words": [words[i] for i in order], "counts": counts[order], "numbers": _pack(number[used])}


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Word numbers, words and their counts, a row for each shard of a language."""
    arrow = to_arrow_schema(SHARDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, given = TaskContext.get().partitionId(), 0
        open_: dict[str, _Shard] = {}
        held = 0

        def out(lang: str) -> pa.RecordBatch:
            nonlocal given, held
            if given == SHARDS_A_TASK:
                raise ValueError(f"a task gives out {SHARDS_A_TASK} shards at most: use larger shards or smaller input splits")
            full = open_.pop(lang)
            held -= len(full.numbers)
            row = full.row(task * SHARDS_A_TASK + given, lang)
            given += 1
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], type=f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                shard = open_.setdefault(lang, _Shard())
                held -= len(shard.numbers)
                shard.add(text.as_py())
                held += len(shard.numbers)
                # What a task holds is bounded, whatever the number of languages.
                while held >= shard_words:
                    yield out(max(open_, key=lambda x: len(open_[x].numbers)))
        for lang in sorted(open_):
            yield out(lang)

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    return docs.select(lang, text).filter(F.octet_length("text") > 0).mapInArrow(run, SHARDS)


def _words(shards: DataFrame, least: int) -> DataFrame:
    """own (shard and number there), lang, word, frequency f and id (the least own) of frequent words, per shard."""
    listed = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("i", "w"))
    rows = listed.select(
        "lang", F.col("w.words").alias("word"), F.col("w.counts").alias("n"), (F.shiftleft("shard", 32) + F.col("i") + 1).alias("own")
    )
    same = Window.partitionBy("lang", "word")  # a row for each shard at most
    return rows.withColumns({"f": F.sum("n").over(same), "id": F.min("own").over(same)}).filter(F.col("f") >= least).drop("n")


def transform(numbers: np.ndarray, depth: int = WORDS) -> np.ndarray:
    """The Burrows-Wheeler transform of a ring of numbers, its rows sorted by their first `depth` numbers."""
    base = int(numbers.max(initial=0)) + 1
    key, keys, width = np.zeros(len(numbers), np.int64), [], 1
    for k in range(depth):
        if width > (1 << 62) // base:
            keys.append(key)
            key, width = np.zeros(len(numbers), np.int64), 1
        key = key * base + np.roll(numbers, -k)
        width *= base
    keys.append(key)
    order = np.argsort(key, kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    return numbers[order - 1]


def psi_of(bwt: np.ndarray) -> np.ndarray:
    """From each row to the row one number further on."""
    return np.argsort(bwt, kind="stable")


def intervals(*parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first rows of the intervals in which all parts are constant and none is negative, their sizes)."""
    change = np.zeros(max(len(parts[0]) - 1, 0), bool)
    good = parts[0] >= 0
    for part in parts:
        change |= part[1:] != part[:-1]
    for part in parts[1:]:
        good &= part >= 0
    start = np.append(0, np.flatnonzero(change) + 1) if len(good) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(good)))
    here = good[start]
    return start[here], size[here]


def _first(bwt: np.ndarray, psi: np.ndarray) -> np.ndarray:
    """The first word of each row, -1 where a row begins with a break."""
    first = bwt[psi].astype(np.int64)
    return np.where(first == 0, -1, first)


def index(shards: DataFrame, words: DataFrame) -> DataFrame:
    """The transform of each shard over its frequent words, the words' ids and the tasks their phrases are dealt to."""
    arrow = to_arrow_schema(INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, known in zip(batch.column("numbers"), batch.column("known")):
                numbers = _unpack(data.as_py(), np.int32)
                number, ids, splits = (known.values.field(c).to_numpy() for c in ("number", "id", "splits"))
                order = np.argsort(number)
                dense = np.zeros(max(int(numbers.max()), int(number.max())) + 1, np.int32)
                dense[number[order]] = np.arange(1, len(number) + 1)
                columns = [_pack(transform(_without_runs(dense[numbers]))), _pack(ids[order]), _pack(splits[order])]
                yield pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    number = F.col("own").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("number")
    known = F.struct(number, "id", (F.lit(1) + F.col("f") / HOT).cast("int").alias("splits"))
    # No more than a shard holds.
    of_shard = words.groupBy(F.shiftright("own", 32).alias("shard")).agg(F.collect_list(known).alias("known"))
    return shards.select("shard", "numbers").join(of_shard, "shard").mapInArrow(run, INDEX)


def _slots(words: list[np.ndarray], bits: int) -> np.ndarray:
    """The bit of a phrase, from the ids of its words."""
    mixed = np.zeros(len(words[0]), np.uint64)
    for ids in words:
        mixed = (mixed ^ ids.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(bits)).astype(np.int64)


def _bitmap(phrases: DataFrame, names: list[str], bits: int) -> np.ndarray:
    """The slots of phrases as 64-bit words; bits / 64 rows at most come to the driver."""
    schema = T.StructType([T.StructField("slot", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = _slots([batch.column(c).to_numpy() for c in names], bits)
            yield pa.RecordBatch.from_arrays([pa.array(slots)], names=["slot"])

    slots = phrases.select(names).mapInArrow(run, schema)
    found = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("set")).toArrow()
    bitmap = np.zeros(-(-bits // 64), np.uint64)
    bitmap[found.column("at").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return bitmap


def counts(indexed: DataFrame, lengths: tuple[int, ...], frequent: np.ndarray | None = None, bits: int = BITS) -> DataFrame:
    """w1 to w4 and the count `a` in the whole corpus of phrases of these lengths; ids of words not there are 0.

    `frequent` is the bitmap of frequent pairs of words; without it all phrases are counted.
    """
    most = max(lengths)
    names = [f"w{i + 1}" for i in range(most)]
    long = T.LongType()
    schema = T.StructType(
        [T.StructField("deal", long), *[T.StructField(n, T.ArrayType(long)) for n in names], T.StructField("n", T.ArrayType(T.IntegerType()))]
    )
    hands = HANDS * int(indexed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrow = to_arrow_schema(schema)
    shared = None if frequent is None else indexed.sparkSession.sparkContext.broadcast(frequent)

    def of_shard(bwt: np.ndarray, ids: np.ndarray, splits: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, psi = np.append(0, ids), psi_of(bwt)
        words = [_first(bwt, psi)]
        for _ in range(most - 1):
            words.append(words[-1][psi])
        pair = np.ones(len(bwt), bool)
        if shared is not None:
            # The rows that begin with a frequent pair, by the intervals of pairs.
            start, size = intervals(*words[:2])
            slots = _slots([ids[w[start]] for w in words[:2]], bits)
            good = (shared.value[slots >> 6] >> (slots & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            rows = np.repeat(start - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
            pair = np.zeros(len(bwt), bool)
            pair[rows] = np.repeat(good, size)
        phrases, sizes = [], []
        allowed = pair
        for m in range(2, most + 1):
            if m in lengths:
                start, size = intervals(np.where(allowed, words[0], -1), *words[1:m])
                phrases.append([words[i][start] if i < m else np.zeros(len(start), np.int64) for i in range(most)])
                sizes.append(size)
            allowed = pair & allowed[psi]  # one pair more
        phrase, size = [np.concatenate(p) for p in zip(*phrases)], np.concatenate(sizes)
        ids_of = [ids[p] for p in phrase]
        after = _slots(ids_of[1:], 1 << 31) % np.append(1, splits)[phrase[0]]
        deal = (_slots(ids_of[:1], 1 << 31) + after) % hands
        order = np.lexsort((*phrase[::-1], deal))
        deal = deal[order]
        at = np.append(0, np.flatnonzero(deal[1:] != deal[:-1]) + 1) if len(order) else np.zeros(0, np.int64)
        if len(at):
            offsets = pa.array(np.append(at, len(order)).astype(np.int32))
            columns = [pa.array(deal[at])] + [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (*ids_of, size)]
            whole = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
            for i in range(0, len(at), 64):
                yield whole.slice(i, 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bwt, ids, splits in zip(*[batch.column(c) for c in INDEX.names]):
                yield from of_shard(_unpack(bwt.as_py(), np.int32), _unpack(ids.as_py(), np.int64), _unpack(splits.as_py(), np.int32))

    dealt = indexed.mapInArrow(run, schema).repartition("deal")
    listed = dealt.select("deal", F.explode(F.arrays_zip(*names, "n")).alias("x")).select("deal", "x.*")
    return listed.groupBy("deal", *names).agg(F.sum("n").alias("a")).drop("deal")


def _cut(k: int, first: Column, rest: Column) -> Column:
    """Score, cut and both counts of one cut; exact, as products may pass 64 bits."""
    twice = F.col("a").cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)")
    both = first.cast("decimal(20,0)") + rest.cast("decimal(20,0)")
    score = ((twice - twice % both) / both).cast("long")
    return F.struct(score.alias("score"), F.lit(k).alias("k"), first.alias("l"), rest.alias("r"))


def _joined(words: list[str]) -> Column:
    return F.array_join(F.array(*[F.col(w).cast("string") for w in words]), " ").alias("phrase")


def phrases(
    docs: DataFrame, least: int = 30, top: int = 2000, contained: tuple[int, int] = (100, 80), shard_words: int = SHARD_WORDS, bits: int = BITS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language by their lowest-scoring cut.

    a: the phrase's count; l, r: the counts of both parts of the cut; n: the language's words. Phrases inside a
    longer one with `contained[0]` * its count >= `contained[1]` * a are left out.
    """
    held = written(shards(docs, shard_words))
    totals = held.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)).alias("n"))
    words = written(_words(held, least))
    indexed = written(index(held, words))
    often = F.col("a") >= least
    found = {2: written(counts(indexed, (2,)).filter(often))}
    longer = written(counts(indexed, (3, 4), _bitmap(found[2], ["w1", "w2"], bits), bits).filter(often))
    found |= {3: longer.filter("w4 = 0").drop("w4"), 4: longer.filter("w4 <> 0")}

    c = F.col
    word = words.filter("own = id").select("id", "lang", "word", "f")

    def of(i: int) -> DataFrame:
        return word.select(c("id").alias(f"w{i}"), c("word").alias(f"t{i}"), c("f").alias(f"f{i}"), *["lang"] * (i == 1))

    two = written(found[2].join(of(1), "w1").join(of(2), "w2"))
    head = two.select("w1", "w2", "lang", "t1", "t2", "f1", c("a").alias("f12"))
    tail = two.select(c("w1").alias("w2"), c("w2").alias("w3"), c("t2").alias("t3"), c("f2").alias("f3"), c("a").alias("f23"))
    three = written(found[3].join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]))
    head = three.select("w1", "w2", "w3", "lang", "t1", "t2", "t3", "f1", "f12", c("a").alias("f123"))
    tail = three.select(
        *[c(f"w{i}").alias(f"w{i + 1}") for i in (1, 2, 3)], c("t3").alias("t4"), c("f3").alias("f4"), c("f23").alias("f34"), c("a").alias("f234")
    )
    four = found[4].join(head, ["w1", "w2", "w3"]).join(tail, ["w2", "w3", "w4"])

    def above(longer: DataFrame, m: int) -> DataFrame:
        """The greatest count of a phrase one word longer; whatever holds a phrase holds such a one that is as frequent."""
        parts = [F.struct(*[c(f"w{i + k}").alias(f"w{i}") for i in range(1, m + 1)]) for k in (0, 1)]
        return longer.select(F.explode(F.array(*parts)).alias("p"), "a").groupBy("p").agg(F.max("a").alias("inside")).select("p.*", "inside")

    cuts = {
        2: [_cut(1, c("f1"), c("f2"))],
        3: [_cut(1, c("f1"), c("f23")), _cut(2, c("f12"), c("f3"))],
        4: [_cut(1, c("f1"), c("f234")), _cut(2, c("f12"), c("f34")), _cut(3, c("f123"), c("f4"))],
    }
    by, to = (F.lit(x).cast("decimal(10,0)") for x in contained)
    whole = c("inside").isNull() | (by * c("inside").cast("decimal(20,0)") < to * c("a").cast("decimal(20,0)"))
    candidates = None
    for m, table in ((2, two), (3, three), (4, four)):
        if m < WORDS:
            table = table.join(above(found[m + 1], m), [f"w{i + 1}" for i in range(m)], "left").filter(whole)
        # Equal scores go to the first cut.
        cut = F.array_min(F.array(*cuts[m]))
        rows = table.select("lang", _joined([f"t{i + 1}" for i in range(m)]), "a", cut.alias("cut"))
        candidates = rows if candidates is None else candidates.unionByName(rows)
    order = Window.partitionBy("lang").orderBy(c("cut.score").desc(), c("a").desc(), "phrase")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).filter(c("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", c("rank").cast("long").alias("rank"), "phrase", "a", c("cut.l").alias("l"), c("cut.r").alias("r"), "n", c("cut.score").alias("score")
    )
