"""Hierarchical Pitman-Yor language model of word pairs.

Each word seen as a context has a restaurant; its customers are the words that follow it, its dishes their
types. A customer sits at a table of its dish or at a new one; every new table sends a customer of that dish to
the parent, the root restaurant of all words, whose parent in turn is uniform over the vocabulary and one
unknown word. Table counts are sampled by Gibbs, dish by dish from their conditional distribution given the
other tables of the restaurant (generalised Stirling numbers; dishes with more than `EXACT` customers are seated
one growing batch after another). After a burn-in several samples are kept, and the predictive probabilities of
a text are averaged over them.

How it is laid out. Texts are tokenised once into blocks of some MB; a block knows its distinct words and word
pairs as hashes. It asks for what it needs: word pairs are dealt by the hash of their context over parts, each
part adds up the counts, seats its restaurants, answers every block in the order it asked, and reports its
tables to the words' parts, which seat the root and answer the blocks likewise. So nothing is broadcast or
collected that grows with the corpus but a list of hot contexts of bounded length: those with a 1/HOT of all pairs
and more are dealt by context and word, and each part sees a share of the restaurant (it scales the tables of its
share up when it weighs new tables; the tables themselves are added up exactly). While sampling, a part takes the
root's probabilities from its own restaurants' tables, a random share of all, as in distributed Gibbs samplers with local
copies that are merged afterwards.

Words are known by 64 bits of XXH64, in pairs by 40 of them.

Defined cases: null texts are empty (their end token alone); rows that repeat an id are each scored (and each
learnt from); a corpus without training texts gives uniform probabilities; null ids hash as "null"; an empty
table gives an empty table; other columns of the input are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from murmura.llm.common import with_defaults, written

DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 1.0
SAMPLES, BURN_IN, EXACT = 3, 2, 48
HOT = 200
MASK = np.uint64((1 << 40) - 1)
#: The end of a text as a word, and its start as a context; words never hold these bytes.
END, START = b"\n", b"\n\n"


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 11)


def _pack(a: np.ndarray) -> bytes:
    """Bytes of one weight together, then compressed."""
    width = a.dtype.itemsize
    head = a.dtype.str.encode().ljust(4) + len(a).to_bytes(8, "little")
    return head + zstandard.compress(a.view(np.uint8).reshape(-1, width).T.tobytes() if len(a) else b"", 1)


def _unpack(data: bytes) -> np.ndarray:
    kind, n = np.dtype(data[:4].decode().strip()), int.from_bytes(data[4:12], "little")
    flat = np.frombuffer(zstandard.decompress(data[12:]) if n else b"", np.uint8)
    return np.ascontiguousarray(flat.reshape(kind.itemsize, n).T).view(kind).ravel() if n else np.zeros(0, kind)


def _short(a: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds the values."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def _add_up(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, and the sums of the values of each."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    start = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(key) else np.zeros(0, np.int64)
    return ranked[start], [np.add.reduceat(v[order], start) if len(start) else v[:0] for v in values]


# --- blocks -------------------------------------------------------------------------------------------------

BLOCKS = T.StructType(
    [T.StructField("block", T.LongType())]
    + [T.StructField(n, T.BinaryType()) for n in ("ids", "null_ids", "held", "lengths", "tokens", "words")]
    + [T.StructField(n, T.LongType()) for n in ("n_train", "n_docs", "n_pairs")]
    + [T.StructField("hot", T.ArrayType(T.StructType([T.StructField("context", T.LongType()), T.StructField("n", T.LongType())])))]
)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(str("null" if doc_id is None else doc_id).encode()) % 5 == 1


def _block(number: int, docs: list[tuple[int | None, str | None]]) -> dict:
    vocabulary: dict[bytes, int] = {END: 0}
    tokens: list[int] = []
    lengths = []
    for _, text in docs:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        tokens += [vocabulary.setdefault(w, len(vocabulary)) for w in words]
        tokens.append(0)
        lengths.append(len(words) + 1)
    hashes = np.array([word_hash(w) for w in vocabulary], np.uint64)
    # Words in order of their hash, so that what a block asks for is in order too.
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    stream = rank[np.array(tokens, np.int64)]
    held = np.array([held_out(d) for d, _ in docs])
    lengths_ = np.array(lengths, np.uint32)
    block = {
        "block": number,
        "ids": _pack(np.array([0 if d is None else d for d, _ in docs], np.int64)),
        "null_ids": _pack(np.array([d is None for d, _ in docs], np.uint8)),
        "held": _pack(held.astype(np.uint8)),
        "lengths": _pack(lengths_),
        "tokens": _pack(stream),
        "words": _pack(hashes[order]),
        "n_train": int(lengths_[~held].sum()),
        "n_docs": len(docs),
    }
    context, _, _, _ = pairs(block)
    # Contexts with many pairs here; a context that is hot overall is so in some block.
    start = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    size = np.diff(np.append(start, len(context)))
    many = size * 2 * HOT >= len(context)
    block["n_pairs"] = len(context)
    block["hot"] = [{"context": int(c), "n": int(n)} for c, n in zip(context[start][many], size[many])]
    return block


def blocks(docs: DataFrame, size: int = 16 << 20) -> DataFrame:
    """Blocks of texts, tokenised; a block is closed once it holds `size` characters."""
    arrow = to_arrow_schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, some, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for doc, text in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)):
                    some.append((doc, text))
                    held += len(text or "")
                    if held >= size:
                        yield pa.RecordBatch.from_pylist([_block(part << 32 | n, some)], schema=arrow)
                        some, held, n = [], 0, n + 1
        if some:
            yield pa.RecordBatch.from_pylist([_block(part << 32 | n, some)], schema=arrow)

    return with_defaults(docs, doc_id="long", text="string").mapInArrow(run, BLOCKS)


def pairs(block: dict | pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context and word (40 bits) and training count of the block's distinct pairs, and each token's pair."""
    words, tokens, lengths, held = (_unpack(block[c]) for c in ("words", "tokens", "lengths", "held"))
    first = np.cumsum(lengths.astype(np.int64)) - lengths
    left = np.append(np.uint32(0), tokens[:-1]).astype(np.int64) + 1
    left[first] = 0  # the start
    key = left * (len(words) + 1) + tokens
    train = np.repeat(held == 0, lengths).astype(np.int64)
    order = np.argsort(key)
    ranked = key[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    start = np.flatnonzero(new)
    of_token = np.empty(len(key), np.int64)
    of_token[order] = np.cumsum(new) - 1
    counts = np.add.reduceat(train[order], start)
    context_hash = np.append(np.uint64(word_hash(START)), words) >> np.uint64(24)
    distinct = ranked[start]
    return context_hash[distinct // (len(words) + 1)], words[distinct % (len(words) + 1)] >> np.uint64(24), counts, of_token


# --- seating ------------------------------------------------------------------------------------------------


def log_stirling(most: int, discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers S(c, t): seatings of c customers at t tables."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[0, 0] = 0
    for c in range(1, most + 1):
        t = np.arange(1, c + 1)
        with np.errstate(divide="ignore"):
            s[c, 1 : c + 1] = np.logaddexp(s[c - 1, 0:c], s[c - 1, 1 : c + 1] + np.log(np.maximum(c - 1 - t * discount, 1e-300)))
    return s


def seat(
    group: np.ndarray, counts: np.ndarray, dish: np.ndarray, n_dishes: int, discount: float, strength: float,
    random: np.random.Generator, scale: np.ndarray | None = None, parent: float | None = None,
    parent_strength: float = ROOT_STRENGTH, parent_discount: float = ROOT_DISCOUNT,
) -> Iterator[np.ndarray]:
    """Endless samples of the table counts of (restaurant, dish) cells with `counts` customers.

    group: the restaurant of each cell; scale: how many times the cells' tables a whole restaurant has. `parent`
    fixes the chance of a dish in the parent; else it follows from all cells' tables, smoothed.
    """
    n_groups = int(group[-1]) + 1 if len(group) else 0
    stirling = log_stirling(EXACT, discount)
    tables = np.minimum(counts, 1)
    small = [np.flatnonzero(counts == c) for c in range(2, EXACT + 1)]
    big = np.flatnonzero(counts > EXACT)
    scale = np.ones(n_groups) if scale is None else scale
    while True:
        total = np.bincount(group, tables, n_groups) * scale
        served = np.bincount(dish, tables, n_dishes)
        everything = served.sum()

        def chance(cells: np.ndarray) -> np.ndarray:
            """Of the cells' dishes in the parent."""
            if parent is not None:
                return np.full(len(cells), parent)
            return np.maximum(served[dish[cells]] - parent_discount, 0.1) / (everything + parent_strength)

        for c, cells in enumerate(small, 2):
            if not len(cells):
                continue
            others = total[group[cells]] - tables[cells]
            t = np.arange(1, c + 1)
            grow = np.cumsum(np.log(strength + discount * (others[:, None] + t - 1)), axis=1)
            weight = stirling[c, 1 : c + 1] + grow + t * np.log(chance(cells))[:, None]
            weight = np.exp(weight - weight.max(axis=1, keepdims=True)).cumsum(axis=1)
            drawn = (weight < random.random(len(cells))[:, None] * weight[:, -1:]).sum(axis=1) + 1
            tables[cells] = np.minimum(drawn, c)
        if len(big):
            p = chance(big)
            others = total[group[big]] - tables[big]
            t, seated = np.ones(len(big)), np.ones(len(big))
            while (open_ := seated < counts[big]).any():
                batch = np.where(open_, np.minimum(np.maximum(1, seated // 16), counts[big] - seated), 0).astype(np.int64)
                fresh = p * (strength + discount * (others + t))
                t += random.binomial(batch, fresh / (fresh + seated - discount * t))
                seated += batch
            tables[big] = t.astype(tables.dtype)
        yield tables.copy()


def samples(seats: Iterator[np.ndarray]) -> list[np.ndarray]:
    for _ in range(BURN_IN):
        next(seats)
    return [next(seats) for _ in range(SAMPLES)]


# --- exchanges ----------------------------------------------------------------------------------------------

ASKED = T.StructType(
    [T.StructField("part", T.LongType()), T.StructField("block", T.LongType()), T.StructField("kind", T.StringType())]
    + [T.StructField(n, T.BinaryType()) for n in ("a", "b", "c")]
)
ANSWERS = T.StructType([T.StructField("to", T.StringType()), *ASKED.fields])


def _parts_of(context: np.ndarray, word: np.ndarray, n_parts: int, hot: np.ndarray) -> np.ndarray:
    mixed = context * np.uint64(0x9E3779B97F4A7C15)
    spread = np.isin(context, hot)
    mixed = np.where(spread, mixed ^ (word * np.uint64(0xC2B2AE3D27D4EB4F)), mixed)
    return (mixed >> np.uint64(33)).astype(np.int64) % n_parts


def _deal(part: np.ndarray, n_parts: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(n_parts + 1))
    for p in range(n_parts):
        if edges[p] < edges[p + 1]:
            yield p, order[edges[p] : edges[p + 1]]


def ask_pairs(made: DataFrame, n_parts: int, hot: list[int]) -> DataFrame:
    """What blocks ask of the context parts: context, word and training count of their pairs."""
    arrow, hot_ = to_arrow_schema(ASKED), np.array(hot, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1).to_pylist()[0]
                context, word, count, _ = pairs(block)
                for p, rows in _deal(_parts_of(context, word, n_parts, hot_), n_parts):
                    yield pa.RecordBatch.from_pylist(
                        [{"part": p, "block": block["block"], "kind": "pairs", "a": _pack(context[rows]), "b": _pack(word[rows]), "c": _pack(_short(count[rows]))}],
                        schema=arrow,
                    )

    return made.select("block", "words", "tokens", "lengths", "held").mapInArrow(run, ASKED)


def answer_pairs(asked: DataFrame, n_parts: int, hot: list[int]) -> DataFrame:
    """Seats each part's restaurants. Answers to blocks: count and tables of each pair, and of its context.

    Reports to words' parts: tables by word. Shares of hot contexts are answered pair by pair as all others, and
    reported as `hot` rows, to be added up.
    """
    arrow, hot_ = to_arrow_schema(ANSWERS), np.array(hot, np.uint64)

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        frame = frame.sort_values("block")
        context = np.concatenate([_unpack(x) for x in frame["a"]])
        word = np.concatenate([_unpack(x) for x in frame["b"]])
        count = np.concatenate([_unpack(x).astype(np.int64) for x in frame["c"]])
        sizes = [int.from_bytes(x[4:12], "little") for x in frame["a"]]
        order = np.lexsort((word, context))
        c, w = context[order], word[order]
        new = np.append(True, (c[1:] != c[:-1]) | (w[1:] != w[:-1]))
        start = np.flatnonzero(new)
        cell = np.empty(len(order), np.int64)
        cell[order] = np.cumsum(new) - 1
        counts = np.add.reduceat(count[order], start)
        c, w = c[start], w[start]
        group = np.cumsum(np.append(False, c[1:] != c[:-1]))
        first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        dishes, dish = _ranks(w)
        scale = np.where(np.isin(c[first], hot_), float(n_parts), 1.0)
        drawn = samples(seat(group, counts, dish, len(dishes), DISCOUNT, STRENGTH, np.random.default_rng([7, part]), scale))
        totals = [np.add.reduceat(counts, first), *(np.add.reduceat(t, first) for t in drawn)]
        rows, at = [], 0
        for block, n in zip(frame["block"], sizes):
            mine = cell[at : at + n]
            at += n
            cells = np.stack([_as32(x[mine]) for x in (counts, *drawn)])
            # A context's pairs lie together: its totals are given once for each run.
            runs = mine[np.append(True, group[mine][1:] != group[mine][:-1])]
            whole = np.stack([_as32(x[group[runs]]) for x in totals])
            rows.append(("block", part, block, "pairs", _pack(cells.ravel()), _pack(whole.ravel()), b""))
        served = [np.bincount(dish, t, len(dishes)).astype(np.int64) for t in drawn]
        for p, mine in _deal(_word_part(dishes, n_parts), n_parts):
            tables = np.stack([_as32(x[mine]) for x in served])
            if tables.any():
                rows.append(("word", p, part, "tables", _pack(dishes[mine]), _pack(tables.ravel()), b""))
        for g in np.flatnonzero(scale > 1):
            rows.append(("hot", part, int(c[first[g]]), "hot", _pack(np.array([x[g] for x in totals], np.int64)), b"", b""))
        return pd.DataFrame(rows, columns=arrow.names)

    return asked.groupBy("part").applyInPandas(run, ANSWERS)


def _as32(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint32)


def _ranks(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the place of each value."""
    order = np.argsort(a)
    ranked = a[order]
    new = np.append(True, ranked[1:] != ranked[:-1]) if len(a) else np.zeros(0, bool)
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


def _word_part(short: np.ndarray, n_parts: int) -> np.ndarray:
    """Parts of words by the 40 bits by which pairs know them."""
    return (short * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % n_parts


def ask_words(made: DataFrame, n_parts: int) -> DataFrame:
    """What blocks ask of the words' parts: words and their training counts."""
    arrow = to_arrow_schema(ASKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1).to_pylist()[0]
                words, tokens, lengths, held = (_unpack(block[c]) for c in ("words", "tokens", "lengths", "held"))
                count = np.bincount(tokens[np.repeat(held == 0, lengths)], minlength=len(words))
                for p, mine in _deal(_word_part(words >> np.uint64(24), n_parts), n_parts):
                    yield pa.RecordBatch.from_pylist(
                        [{"part": p, "block": block["block"], "kind": "words", "a": _pack(words[mine]), "b": _pack(_short(count[mine])), "c": b""}],
                        schema=arrow,
                    )

    return made.select("block", "words", "tokens", "lengths", "held").mapInArrow(run, ASKED)


def answer_words(asked: DataFrame) -> DataFrame:
    """asked: the blocks' words and the pair parts' tables. Counts of each word, and its customers and tables in
    the root for each sample; and for each part (to "sums") its distinct words, customers and tables."""
    arrow = to_arrow_schema(ANSWERS)

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        frame = frame.sort_values(["kind", "block"])
        blocks_, tables_ = frame[frame["kind"] == "words"], frame[frame["kind"] == "tables"]
        words = np.concatenate([np.zeros(0, np.uint64), *map(_unpack, blocks_["a"])])
        count = np.concatenate([np.zeros(0, np.int64), *(_unpack(x).astype(np.int64) for x in blocks_["b"])])
        distinct, place = _ranks(words)
        total = np.bincount(place, count, len(distinct)).astype(np.int64)
        short = distinct >> np.uint64(24)
        customers = [np.zeros(len(distinct), np.int64) for _ in range(SAMPLES)]
        for a, b in zip(tables_["a"], tables_["b"]):
            # Words that share their 40 bits share the dish; the first of them stands for it.
            at = np.searchsorted(short, _unpack(a))
            for s, t in enumerate(_unpack(b).reshape(SAMPLES, -1)):
                customers[s][at] += t
        root = []
        for s, n in enumerate(customers):
            # The root's parent is uniform: a dish's chance of a new table is the same for all.
            seats = seat(np.zeros(len(n), np.int64), n, np.arange(len(n)), len(n), ROOT_DISCOUNT, ROOT_STRENGTH,
                         np.random.default_rng([11, part, s]), parent=1.0 / (len(n) + 1))
            root.append(next(seats) if len(n) else n)
        rows, at = [], 0
        for block, a in zip(blocks_["block"], blocks_["a"]):
            n = int.from_bytes(a[4:12], "little")
            mine = place[at : at + n]
            at += n
            rows.append(("block", part, block, "words", _pack(np.stack([_as32(x[mine]) for x in (total, *customers, *root)]).ravel()), b"", b""))
        sums = np.array([(total > 0).sum(), *(x.sum() for x in customers), *(x.sum() for x in root)], np.int64)
        rows.append(("sums", part, 0, "sums", _pack(sums), b"", b""))
        return pd.DataFrame(rows, columns=arrow.names)

    return asked.groupBy("part").applyInPandas(run, ANSWERS)


# --- scores -------------------------------------------------------------------------------------------------

SCORES = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType())]
    + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
    + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score", "perplexity")]
)


def score(docs: DataFrame, pairs_in_part: int = 2_500_000, size: int = 16 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) and the text's perplexity."""
    made = written(blocks(docs, size))
    facts = made.agg(F.sum("n_train"), F.sum("n_pairs")).first()
    n_train, n_pairs = facts[0] or 0, facts[1] or 0
    listed = made.select(F.explode("hot").alias("h")).groupBy("h.context").agg(F.sum("h.n").alias("n"))
    hot = sorted(r[0] for r in listed.filter(F.col("n") * 2 * HOT >= n_pairs).collect())  # 2 * HOT rows at most
    n_parts = max(8, -(-n_pairs // pairs_in_part))
    first = written(answer_pairs(ask_pairs(made, n_parts, hot), n_parts, hot), "to")
    hot_totals = {c: np.zeros(1 + SAMPLES, np.int64) for c in hot}
    for r in first.filter("to = 'hot'").select("block", "a").toLocalIterator():  # a row for each part and hot context
        hot_totals[r["block"]] += _unpack(bytes(r["a"]))
    asked = ask_words(made, n_parts).unionByName(first.filter("to = 'word'").select(*ASKED.names))
    second = written(answer_words(asked), "to")
    sums = np.zeros(1 + 2 * SAMPLES, np.int64)
    for r in second.filter("to = 'sums'").select("a").toLocalIterator():  # a row for each part
        sums += _unpack(bytes(r["a"]))
    n_words, totals = int(sums[0]), sums[1:].reshape(2, SAMPLES)
    hot_list = np.array(hot, np.uint64)
    hot_table = np.array([hot_totals[c] for c in hot], np.int64).reshape(-1, 1 + SAMPLES)

    def run(key, mine: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in mine.iterrows():
            words, tokens, lengths, held, ids, null_ids = (_unpack(block[c]) for c in ("words", "tokens", "lengths", "held", "ids", "null_ids"))
            about = np.zeros((1 + 2 * SAMPLES, len(words)), np.int64)
            by_part = {r.part: r for r in answers[answers["kind"] == "words"].itertuples()}
            for p, at in _deal(_word_part(words >> np.uint64(24), n_parts), n_parts):
                about[:, at] = _unpack(by_part[p].a).reshape(about.shape[0], -1)
            count = about[0]
            context, word, _, of_token = pairs(block)
            cells, whole = (np.zeros((1 + SAMPLES, len(context)), np.int64) for _ in range(2))
            by_part = {r.part: r for r in answers[answers["kind"] == "pairs"].itertuples()}
            for p, at in _deal(_parts_of(context, word, n_parts, hot_list), n_parts):
                cells[:, at] = _unpack(by_part[p].a).reshape(1 + SAMPLES, -1)
                runs = np.cumsum(np.append(True, context[at][1:] != context[at][:-1])) - 1
                whole[:, at] = _unpack(by_part[p].b).reshape(1 + SAMPLES, -1)[:, runs]
            if len(hot_list):
                where = np.minimum(np.searchsorted(hot_list, context), len(hot_list) - 1)
                found = hot_list[where] == context
                whole[:, found] = hot_table[where[found]].T
            at_word = np.empty(len(context), np.int64)
            at_word[of_token] = tokens
            chance = np.zeros(len(context))
            for s in range(SAMPLES):
                n, t = about[1 + s], about[1 + SAMPLES + s]
                above = np.maximum(n - ROOT_DISCOUNT * t, 0) + (ROOT_STRENGTH + ROOT_DISCOUNT * totals[1, s]) / (n_words + 1)
                root = above / (totals[0, s] + ROOT_STRENGTH)
                own = np.maximum(cells[0] - DISCOUNT * cells[1 + s], 0) + (STRENGTH + DISCOUNT * whole[1 + s]) * root[at_word]
                chance += own / (whole[0] + STRENGTH) / SAMPLES
            first_of = np.cumsum(lengths.astype(np.int64)) - lengths
            base = np.log10((count[tokens] + 0.5) / (n_train + 0.5 * (n_words + 1)))
            scores = np.add.reduceat(np.log10(chance)[of_token], first_of)
            frame = pd.DataFrame(
                {
                    "doc_id": pd.array(ids, "Int64"),
                    "held_out": held > 0,
                    "n_tokens": lengths.astype(np.int64),
                    "n_known": np.add.reduceat((count[tokens] > 0).astype(np.int64), first_of),
                    "train_tokens": n_train,
                    "base_score": np.add.reduceat(base, first_of),
                    "score": scores,
                    "perplexity": 10 ** (-scores / lengths),
                }
            )
            frame.loc[null_ids > 0, "doc_id"] = pd.NA
            out.append(frame)
        return pd.concat(out) if out else pd.DataFrame({n: [] for n in SCORES.names})

    columns = ["part", "block", "kind", "a", "b"]
    answers = first.filter("to = 'block'").select(*columns).unionByName(second.filter("to = 'block'").select(*columns))
    return made.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, SCORES)
