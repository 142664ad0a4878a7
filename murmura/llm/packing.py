"""Best-fit packing of tokenised documents with large-item matching.

Lengths are at most the capacity, so the histogram of lengths has at most `capacity` entries however many
documents there are; the packing is worked out on it. Pieces above a third of the capacity fit at most twice
into a sequence: from the largest on, each is matched with the largest other one that fits. Smaller pieces,
largest first, go to the tightest gap that takes them. The result is a list of runs: for each length, which
ranks go to which sequences at which offset. Pieces are then numbered within their length, spread over hash
buckets, and looked up in the runs, so no task sees a whole length and the driver only the histogram.

Defined cases: a null text is empty (its end token alone); repeated rows are packed each; ids are in order of
piece; pieces of one length and id are ordered by their other columns; a long text is cut into pieces, a long word
is encoded like any other; an empty table gives an empty table; other columns of the input are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.llm.common import numbered, with_defaults

CAPACITY = 2048

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


class ByteBpe:
    """A byte-level BPE file, each distinct pre-token encoded once and kept in a bounded table.

    Byte-level BPE splits a text into pre-tokens (an optional space with letters, digits or other signs; white
    space) and encodes each by itself. Texts of ASCII and Latin-1 letters are split here, many at a time. Pre-tokens
    are grouped by a hash, every one is compared with the first of its group byte by byte, and the table is keyed by
    bytes. All other texts, those with apostrophes (contractions) or a special token, and texts whose pre-tokens
    share a hash but not their bytes, go to the tokenizer whole.
    """

    PLAIN = re.compile("[\x00-&(-~\x7fÀ-ÖØ-öø-ÿ]*")
    LETTER, DIGIT, OTHER, SPACE, WHITE = range(5)

    def __init__(self, path: str, most: int = 700_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Byte-level BPE writes each byte as a printable character: itself, or the next one from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [c for c in range(256) if c not in shown]
        self.shown = {c: c for c in shown} | {c: 256 + i for i, c in enumerate(rest)}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most = most
        kind = np.full(256, self.OTHER, np.uint8)
        kind[[c for c in range(256) if chr(c).isascii() and chr(c).isalpha() or c >= 128]] = self.LETTER
        kind[[ord(c) for c in "0123456789"]] = self.DIGIT
        kind[[9, 10, 11, 12, 13]] = self.WHITE
        kind[[28, 29, 30, 31]] = self.OTHER
        kind[32] = self.SPACE
        self.kind = kind
        base = np.uint64(0x9E3779B97F4A7C15)
        self.up, self.down = np.ones(0, np.uint64), np.ones(0, np.uint64)
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.store: list[np.ndarray] = []
        self.flat = np.zeros(0, np.uint32)
        self.begin = np.zeros(1, np.int64)

    def encode_whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain, whole = [], []
        for i, t in enumerate(texts):
            fast = self.PLAIN.fullmatch(t) and not any(s in t for s in self.special)
            (plain if fast else whole).append(i)
        at = 0
        while at < len(plain):
            some, size = [], 0
            while at < len(plain) and (not some or size + len(texts[plain[at]]) < 2_000_000):
                some.append(plain[at])
                size += len(texts[plain[at]])
                at += 1
            for i, ids in zip(some, self._encode_plain([texts[i] for i in some])):
                out[i] = ids
        for i, ids in zip(whole, self.encode_whole([texts[i] for i in whole])):
            out[i] = ids
        return out

    def _encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Pre-tokens, straight to the tokenizer's model."""
        shown, tokenize = self.shown, self.model.tokenize
        return [np.array([t.id for t in tokenize(w.decode("latin-1").translate(shown))], np.uint32) for w in words]

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        parts = [t.encode() for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(parts), np.uint8)
        if not len(data):
            return [np.zeros(0, np.uint32)] * len(texts)
        if len(self.up) <= len(data):
            n = 1 << int(len(data)).bit_length()
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.base, np.uint64)]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.inverse, np.uint64)]), dtype=np.uint64)
        first = self._starts(data, ends)
        begin = np.flatnonzero(first)
        stop = np.append(begin[1:], len(data))
        with np.errstate(over="ignore"):
            total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], dtype=np.uint64)])
            key = (total[stop] - total[begin]) * self.down[begin]
            key ^= (stop - begin).astype(np.uint64) << np.uint64(52)
        order = np.argsort(key)
        ranked = key[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        example = order[new]
        which = np.empty(len(key), np.int64)
        which[order] = np.cumsum(new) - 1
        if not self._alike(data, begin, stop, example[which]):
            return self.encode_whole(texts)
        if len(self.place) > self.most:
            self.clear()
        raw = data.tobytes()
        keys = [raw[begin[e] : stop[e]] for e in example.tolist()]
        place = np.array([self.place.get(x, -1) for x in keys], np.int64)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            found = self._encode_words([keys[m] for m in missing.tolist()])
            count = len(self.place)
            for j, m in enumerate(missing.tolist()):
                self.place[keys[m]] = count + j
            place[missing] = count + np.arange(len(missing))
            sizes_new = np.array([len(f) for f in found], np.int64)
            self.flat = np.concatenate([self.flat, *found])
            self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(sizes_new))
        at = place[which]
        n_ids = self.begin[at + 1] - self.begin[at]
        upto = np.cumsum(n_ids)
        ids = self.flat[np.repeat(self.begin[at] - (upto - n_ids), n_ids) + np.arange(upto[-1])]
        cut = np.append(0, upto)[np.searchsorted(begin, ends)]
        return np.split(ids, cut[:-1])[: len(texts)]

    @staticmethod
    def _alike(data: np.ndarray, begin: np.ndarray, stop: np.ndarray, first: np.ndarray) -> bool:
        """Whether every pre-token has the bytes of the one that stands for it."""
        size = stop - begin
        if (size != size[first]).any():
            return False
        # Where each byte's pre-token stands away from the one that stands for it.
        away = np.repeat(begin[first] - begin, size)
        return bool((data == data[np.arange(len(data)) + away]).all())

    def _starts(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        k = self.kind[data]
        white = k >= self.SPACE
        edge = np.zeros(len(data) + 1, bool)  # a text begins here
        edge[0] = True
        edge[ends] = True
        before = np.append(np.uint8(self.WHITE), k[:-1])
        before_white = np.append(False, white[:-1]) & ~edge[:-1]
        # In a run of white space the last sign stands alone, or with the next word if it is a space.
        last = white & ~np.append(white[1:], True) & ~edge[1:]
        word = ~white & ((before != k) | edge[:-1]) & ~((before == self.SPACE) & before_white)
        return edge[:-1] | (white & ~before_white) | last | word


_encoders: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """One per Python worker."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit): whole texts, cut only beyond capacity.

    The first piece takes what the others, full ones, leave.
    """
    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows: list[tuple] = []
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for doc, ids in zip(batch.column("doc_id").to_pylist(), bpe.encode(texts)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    n = len(ids)
                    stop, cuts = n, []
                    while stop > 0:
                        cuts.append((max(0, stop - capacity), stop))
                        stop -= capacity
                    for piece, (a, b) in enumerate(reversed(cuts)):
                        rows.append((doc, piece, a, b - a, ids[a:b].tobytes()))
                columns = list(zip(*rows)) if rows else [[]] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return with_defaults(docs, doc_id="long", text="string").mapInArrow(run, PIECES)


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, first sequence, sequences, pieces in each, offset) that place every piece."""
    left = {n: c for n, c in histogram.items() if c}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must lie in 1 to the capacity")
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap to (first sequence, sequences)
    bins = 0

    def put(length: int, first: int, many: int, each: int, offset: int) -> None:
        runs.append((length, used[length], first, many, each, offset))
        used[length] += many * each
        left[length] -= many * each

    def opened(gap: int, first: int, many: int) -> None:
        if gap and many:
            gaps.setdefault(gap, []).append((first, many))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((n for n in large if n <= min(a, capacity - a) and left[n] > (n == a)), None)
            many = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            if b == a:
                put(a, bins, many, 2, 0)
                opened(capacity - 2 * a, bins, many)
            else:
                put(a, bins, many, 1, 0)
                if b is not None:
                    put(b, bins, many, 1, a)
                opened(capacity - a - (b or 0), bins, many)
            bins += many
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        tight = sorted(g for g in gaps if g >= n)
        for gap in tight:
            while left[n] and gaps.get(gap):
                first, many = gaps[gap].pop()
                each = gap // n
                full = min(many, left[n] // each)
                if full:
                    put(n, first, full, each, capacity - gap)
                    opened(gap - each * n, first, full)
                if full < many:
                    rest = left[n] if left[n] < each else 0
                    if rest:
                        put(n, first + full, 1, rest, capacity - gap)
                        opened(gap - rest * n, first + full, 1)
                    if many - full - bool(rest):
                        gaps[gap].append((first + full + bool(rest), many - full - bool(rest)))
                    if not left[n]:
                        break
            if not gaps.get(gap):
                gaps.pop(gap, None)
            if not left[n]:
                break
        each = capacity // n
        if left[n] >= each:
            full = left[n] // each
            put(n, bins, full, each, 0)
            opened(capacity - each * n, bins, full)
            bins += full
        if left[n]:
            rest = left[n]
            put(n, bins, 1, rest, 0)
            opened(capacity - rest * n, bins, 1)
            bins += 1
    return runs


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (doc_id, piece, length and any other columns) with sequence_id and offset. `cut` is read three times."""
    found = cut.groupBy("length").count().collect()  # `capacity` rows at most
    runs = sorted(plan({r["length"]: r["count"] for r in found}, capacity))
    table = np.array(runs, np.int64).reshape(-1, 6)
    digest = F.md5(F.concat_ws("/", F.col("doc_id").cast("string"), F.col("piece").cast("string")))
    order = [digest, *[F.col(c) for c in cut.columns]]
    ranked = numbered(cut, ["length"], order, F.substring(digest, 1, 2), "__rank")
    fields = [f for f in ranked.schema.fields if f.name != "__rank"]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    sent = cut.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        # Ranks of one length stay below 2 ** 48, lengths below 2 ** 14.
        starts = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "__rank"))
            hit = table[np.searchsorted(starts, (length << 48) + rank, side="right") - 1] if len(rank) else table[:0]
            nth = rank - hit[:, 1]
            each = hit[:, 4]
            columns = [batch.column(f.name) for f in fields]
            columns += [pa.array(hit[:, 2] + nth // np.maximum(each, 1)), pa.array(hit[:, 5] + nth % np.maximum(each, 1) * length)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return ranked.mapInArrow(run, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids (the pieces' ids in order), and the pieces in them."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return placed.groupBy("sequence_id").agg(inside.alias("pieces")).select(
        "sequence_id",
        F.aggregate("pieces", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("pieces", lambda p: p.dropFields("ids")).alias("pieces"),
    )
