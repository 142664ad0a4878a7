"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint pair with three differing bits at most has a half (32 bits) with one at most. On each half the
anchors are the code words of the Hamming code of length 31, which has covering radius one: every value has a
code word within one bit, its home. A fingerprint is copied to every anchor within radius plus threshold, two
bits: its home and the code words at distance two, sixteen in all. If two values differ in one bit at most, the
home of either is among the anchors of the other, so the pair meets there; it is then compared on all 64 bits.
(The half's last bit takes no part in the choice of anchors, only in the comparison.)

Equal fingerprints are one before anything is compared. Within an anchor a spanning forest of the links is
given out, not all pairs; an anchor with more than `most` fingerprints is split into blocks, and every two
blocks meet in a task of their own.

`similar_groups` and `one_of_each` find near copies at a similarity of 0.8 by an exact join on the rarest shingles of
the texts, without fingerprints.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; repeated rows get
equal results; a null doc_id never names a component unless all its members have none; an empty table gives an
empty table; other columns of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from murmura.llm.common import among, beside, map_batches, with_defaults, written
from murmura.llm.components import components

SEED = 42
SHINGLE = 3
THRESHOLD = 3
BITS = 31
#: Near copies: words of a shingle, least similarity; slack of the bounds.
WORDS, LEAST, EPS = 5, 0.8, 1e-6
_ODD = [np.uint64(sum(1 << i for i in range(BITS) if (i + 1) >> k & 1)) for k in range(5)]
#: For each syndrome but zero, the flips of two bits that lead to the code words at distance two.
_FLIPS = np.array(
    [[0] * 15] + [[1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, BITS + 1) if i < i ^ s] for s in range(1, BITS + 1)],
    np.uint64,
)


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash over word shingles; a bit is set if it is in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a signed long)."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "text_hash", "fp")])

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        return {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "fp": found.view(np.int64)}

    rows = with_defaults(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return map_batches(rows, run, schema)


def anchors(fps: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(which fingerprint, cell) for every anchor within the covering radius plus half the threshold, for both halves."""
    which, cells = [], []
    index = np.arange(len(fps))
    for half in (0, 1):
        x = fps >> np.uint64(32 * half) & np.uint64((1 << BITS) - 1)
        syndrome = np.zeros(len(x), np.int64)
        for k, mask in enumerate(_ODD):
            syndrome |= (np.bitwise_count(x & mask).astype(np.int64) & 1) << k
        flip = np.where(syndrome > 0, np.uint64(1) << np.maximum(syndrome - 1, 0).astype(np.uint64), np.uint64(0))
        # Of one differing bit one half has none, and equal halves have one home.
        off = np.flatnonzero(syndrome) if threshold > 1 else np.zeros(0, np.int64)
        far = x[off, None] ^ _FLIPS[syndrome[off]]
        found = np.concatenate([x ^ flip, far.ravel()])
        which.append(np.concatenate([index, np.repeat(off, 15)]))
        cells.append(found.astype(np.int64) | half << 32)
    return np.concatenate(which), np.concatenate(cells)


def _forest(fps: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between distinct fingerprints."""
    edges: list[tuple[int, int]] = []
    left = fps
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= threshold
            if near.any():
                queue.extend(left[near])
                edges.extend((int(x), int(y)) for y in left[near])
                left = left[~near]
    return edges


def _links(key: np.ndarray, fps: np.ndarray, threshold: int, small: int = 8) -> list[tuple[int, int]]:
    """Links within runs of equal keys."""
    start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))) if len(key) else np.zeros(0, int)
    size = np.diff(np.append(start, len(key)))
    group = np.repeat(np.arange(len(start)), size)
    few = size[group] <= small if len(group) else np.zeros(0, bool)
    edges: list[tuple[int, int]] = []
    for shift in range(1, small):
        a, b = fps[:-shift], fps[shift:]
        hit = (group[:-shift] == group[shift:]) & few[shift:]
        hit &= np.bitwise_count(a ^ b) <= threshold
        edges += zip(a[hit].tolist(), b[hit].tolist())
    for g in np.flatnonzero(size > small):
        edges += _forest(np.unique(fps[start[g] : start[g] + size[g]]), threshold)
    return edges


def links(distinct: DataFrame, threshold: int = THRESHOLD, most: int = 50_000) -> DataFrame:
    """distinct: fp. Returns links (a, b) that connect whatever differs in `threshold` (three or fewer) bits."""
    if not 0 <= threshold <= 3:
        raise ValueError("the anchors cover thresholds up to three bits")
    cell_schema = T.StructType([T.StructField("fp", T.LongType()), T.StructField("cell", T.LongType())])

    def spread(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        which, cells = anchors(fps.view(np.uint64), threshold)
        return {"fp": fps[which], "cell": cells}

    cells = map_batches(distinct.select("fp"), spread, cell_schema, small=8192)
    full = cells.groupBy("cell").count().filter(F.col("count") > most)
    full = full.select("cell", F.ceil(F.col("count") / most).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    rows = (
        cells.join(full, "cell", "left")
        .withColumn("own", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        .select("cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp")
    )
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            found = np.array(_links(key, fps, threshold), np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        key, fps = np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("cell", "x", "y")]
            key = np.concatenate([key, np.stack(columns, axis=1)])
            fps = np.concatenate([fps, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(key) > 1 and (key[0] != key[-1]).any():
                # The last run may go on in the next batch.
                cut = len(key) - int(np.argmax((key[::-1] != key[-1]).any(axis=1)))
                yield out(key[:cut], fps[:cut])
                key, fps = key[cut:], fps[cut:]
        yield out(key, fps)

    by = ["cell", "x", "y"]
    return rows.repartition(*by).sortWithinPartitions(*by, "fp").mapInArrow(run, schema)


def groups(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, fp, root (a fingerprint that names the component) and component_id, its smallest doc_id."""
    marked = written(fingerprints(docs))
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct, threshold)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    rooted = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = rooted.select("fp", "root").join(named, "root")
    return marked.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def _similar_rows(docs: DataFrame, words: int, least: float) -> DataFrame:
    """no (a number of the row), doc_id, text_hash, same (names the sequence of words), first and enough.

    `first`: the least of the hashes of the shingles. Of n shingles a similar text has `need` or more, so if both list the
    first n - need + k of theirs, they have k in common; here k is 1 + n // 10, and a similar text has `need` shingles
    or more itself, so `enough` = 1 + need // 10 of these are shared with each similar text.
    """
    long = T.LongType()
    schema = T.StructType(
        [T.StructField("doc_id", long), T.StructField("text_hash", long), T.StructField("same", T.BinaryType()), T.StructField("first", T.ArrayType(long)), T.StructField("enough", long)]
    )

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        same, first, enough = [], [], []
        for text in batch.column("text"):
            found = _words(text.as_py())
            hashes = shingles(found, words)
            n, need = len(hashes), int(np.ceil(len(hashes) * least - EPS))
            same.append(xxhash.xxh128_digest(b" ".join(found)))
            first.append(hashes[: n - need + 1 + n // 10].view(np.int64).copy())
            enough.append(1 + need // 10)
        return {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "same": same, "first": first, "enough": enough}

    rows = with_defaults(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return map_batches(rows, run, schema).withColumn("no", F.monotonically_increasing_id())


def _shingle_sets(docs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """no and shingles of the rows of `texts` (no, same, text_hash)."""
    rows = docs.select(F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    hashes = texts.select("text_hash").distinct()
    wanted = among(rows, hashes, "text_hash").join(hashes, "text_hash", "left_semi").select("text").distinct()
    schema = T.StructType([T.StructField("same", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        same, sets = [], []
        for text in batch.column("text"):
            found = _words(text.as_py())
            same.append(xxhash.xxh128_digest(b" ".join(found)))
            sets.append(shingles(found, words).view(np.int64))
        return {"same": same, "shingles": sets}

    sets = map_batches(wanted, run, schema, small=64).dropDuplicates(["same"])
    return sets.join(texts.select("no", "same"), "same").select("no", "shingles")


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(found: list[bytes], words: int) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles (of all words, if there are fewer)."""
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w, SEED) for w in found], np.uint64)
    n = min(words, len(hashes))
    mixed = np.zeros(max(len(hashes) - n + 1, 0) if n else 1, np.uint64)
    for i in range(n):
        mixed = _mix(mixed ^ hashes[i : len(hashes) - n + 1 + i])
    return np.unique(mixed)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def shared_sets(rows: DataFrame, least: float) -> DataFrame:
    """no, n (all shingles) and shared (those that other rows have, rarest first, in one order for all rows).

    Only rows that can reach `least` with another row: those that no other row has may be few enough.
    """
    listed = rows.select("no", F.size("shingles").alias("n"), F.explode("shingles").alias("x"))
    shared = listed.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("x"))).filter("df > 1")
    sets = shared.groupBy("no", "n").agg(F.array_sort(F.collect_list(F.struct("df", "x")))["x"].alias("shared"))
    return sets.filter(F.size("shared") >= F.ceil(F.col("n") * least - EPS))


def _prefixes(sets: DataFrame, least: float) -> DataFrame:
    """no, n, key, room: the shingles one of which a row shares with each similar one, and how many a pair that meets first there can share.

    Shingles in one order, the rarest first: two rows with `need` common ones or more share one of the first n - need + 1.
    """
    alone = F.col("n") - F.size("shared")
    first = F.col("n") - F.ceil(F.col("n") * least - EPS).cast("int") + 1 - alone
    keys = sets.select("no", "n", alone.alias("alone"), F.posexplode(F.slice("shared", 1, first)).alias("i", "key"))
    keys = keys.select("no", "n", "key", (F.col("n") - F.col("alone") - F.col("i")).alias("room"))
    return keys.join(keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "key")


def _may(least: float, room: str, n: str, other_room: str, other_n: str) -> Column:
    return F.least(room, other_room) * (1 + least) >= (F.col(n) + F.col(other_n)) * least - EPS


def _confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of a similarity of `least` or more."""
    of_a = sets.select(F.col("no").alias("a"), F.col("n").alias("a_n"), F.col("shared").alias("x"))
    of_b = sets.select(F.col("no").alias("b"), F.col("n").alias("b_n"), F.col("shared").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    alike = common >= least * (F.col("a_n") + F.col("b_n") - common)
    # Sets of shingles are no small side, whatever a compressed table's size suggests.
    return pairs.join(of_a.hint("merge"), "a").join(of_b.hint("merge"), "b").filter(alike).select("a", "b")


def _with_roots(keys: DataFrame, found: DataFrame) -> DataFrame:
    """keys with root (names the component) and loose: not in the component that has most rows of the key."""
    roots = components(found).select(F.col("a").alias("no"), F.col("b").alias("root"))
    rooted = written(keys.join(roots, "no", "left").withColumn("root", F.coalesce("root", "no")))
    size = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    most = size.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    return rooted.join(most.select("key", F.col("most.root").alias("main")), "key").withColumn("loose", F.col("root") != F.col("main")).drop("main")


def similar_links(sets: DataFrame, least: float, crowd: int = 64) -> DataFrame:
    """Links (a, b) that connect all rows of `sets` (see `shared_sets`) with a similarity of `least` or more; exact.

    Rows meet on the keys of `_prefixes`. First all rows of a key are compared with its hub, the row that meets most
    others, as the original of many copies does; in keys of more than `crowd` rows those that aren't in the key's main
    component yet are compared with further rows of it, as long as this finds a tenth of them. What is then left is compared
    with every row of the key that is not in its component, so no link between components is lost. Rows of a key with
    equal counts are one when bounds are tested, so rows that share a passage and no more are never paired.
    """
    keys = written(_prefixes(sets, least))
    met = keys.groupBy("no").agg(F.sum("m").alias("met"))
    place = F.struct("met", F.xxhash64("no").alias("draw"), "no", "n", "room")
    hubs = keys.join(met, "no").groupBy("key").agg(F.max(place).alias("hub"))

    def with_hub(rows: DataFrame, hubs: DataFrame) -> DataFrame:
        both = rows.join(hubs, "key").select("no", "n", "room", F.col("hub.no").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.room").alias("hub_room"))
        near = both.filter((F.col("no") != F.col("hub")) & _may(least, "room", "n", "hub_room", "hub_n"))
        return near.select(F.greatest("no", "hub").alias("a"), F.least("no", "hub").alias("b")).distinct()

    found = written(_confirmed(with_hub(keys, hubs), sets, least))
    rooted = written(_with_roots(keys, found))
    level, placed = 1, True
    while placed:
        loose = rooted.filter((F.col("m") > crowd) & F.col("loose"))
        waiting = loose.select("no").distinct().count()
        if not waiting:
            break
        others = rooted.filter((F.col("m") > crowd) & ~F.col("loose"))
        drawn = others.groupBy("key").agg(F.max(F.struct(F.xxhash64("no", F.lit(level)).alias("draw"), "no", "n", "room")).alias("hub"))
        more = written(_confirmed(with_hub(loose, drawn), sets, least))
        found, level, placed = found.unionByName(more), level + 1, 10 * more.count() >= waiting
        rooted = written(_with_roots(keys, found))
    kind = ["key", "n", "room"]
    ours = rooted.filter("loose").select(*kind).distinct()
    theirs = rooted.select("key", F.col("n").alias("b_n"), F.col("room").alias("b_room")).distinct()
    kinds = ours.join(theirs, "key").filter(_may(least, "room", "n", "b_room", "b_n"))
    a = rooted.filter("loose").select(*kind, F.col("no").alias("a"), F.col("root").alias("a_root"))
    b = rooted.select("key", F.col("n").alias("b_n"), F.col("room").alias("b_room"), F.col("no").alias("b"), F.col("root").alias("b_root"))
    apart = a.join(kinds, kind).join(b.hint("merge"), ["key", "b_n", "b_room"]).filter("a_root <> b_root")
    asked = apart.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return found.unionByName(_confirmed(asked, sets, least))


def similar_groups(docs: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """doc_id, text_hash and root: rows with one root are linked by texts of a Jaccard similarity of `least` or more.

    The similarity is that of the sets of shingles of `words` words, lower-cased; every link counts, see `similar_links`.
    """
    marked = written(_similar_rows(docs, words, least))
    classes = written(marked.groupBy("same").agg(F.min("no").alias("no")))
    # Equal texts are one row; the few that the bitmap lets through are linked like any other.
    one = among(marked, classes.select("no"), "no")
    met = one.select("no", "enough", F.explode("first").alias("x")).withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("x")))
    met = met.filter("df > 1").groupBy("no", "enough").agg(F.count(F.lit(1)).alias("n")).filter("n >= enough")
    texts = written(one.join(met.select("no"), "no", "left_semi").select("no", "same", "text_hash"))
    sets = written(shared_sets(_shingle_sets(docs, texts, words), least))
    roots = components(similar_links(sets, least)).select(F.col("a").alias("no"), F.col("b").alias("root"))
    named = classes.join(roots, "no", "left").select("same", F.coalesce("root", "no").alias("root"))
    return marked.select("same", "doc_id", "text_hash").join(named, "same").select("doc_id", "text_hash", "root")


def one_of_each(docs: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """The rows of docs, all columns: of each group of similar texts the row of the smallest doc_id, once.

    Rows without an id come last; equal ids are told apart by the hash of their text. Only rows of groups of two or
    more are dealt; all others stay where they are.
    """
    doc = F.col("doc_id").cast("long")
    place = F.struct(doc.isNull().alias("none"), F.coalesce(doc, F.lit(0)).alias("id"), "text_hash")
    found = similar_groups(docs, words, least).select("root", place.alias("place"))
    grouped = found.groupBy("root").agg(F.min("place").alias("p"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    grouped = written(grouped.select("root", "p"))
    touched = written(found.join(grouped, "root").select(F.xxhash64("place").alias("__key"), (F.col("place") == F.col("p")).alias("stays"), "place"))
    own = F.struct(doc.isNull().alias("none"), F.coalesce(doc, F.lit(0)).alias("id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    keyed = docs.withColumn("__place", own).withColumn("__key", F.xxhash64("__place"))
    keys = touched.select("__key")
    maybe = among(keyed, keys, "__key")
    stay = maybe.join(touched.filter("stays").select(F.col("place").alias("__place")).distinct(), "__place", "left_semi").dropDuplicates(["__place"])
    apart = maybe.join(touched.select(F.col("place").alias("__place")).distinct(), "__place", "left_anti")
    rest = beside(keyed, keys, "__key")
    return rest.unionByName(stay).unionByName(apart).drop("__place", "__key")
