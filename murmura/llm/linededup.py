"""Line dedup by winnowing over line hashes.

The lines of a document that hold a word, in order, are hashed. A window is the shortest run of lines from a
line on that has `min_words` words. Of each window the least line hash (of equal ones the leftmost) is selected;
a position selected by several windows is one row, a fingerprint. A run of `min_words` words or more that occurs
twice holds a whole window, which selects the same line of it in both places: no repeated run is missed, and lines
that no window selects need no row.

Positions are joined by their line hash, and those whose hash no other position has are done with. The rest are
extended both ways: back to the start of each window that selected the position (before that, the next selected
position to the left goes on), forth to the end of the window and over the lines after it as long as both go on
alike. Windows are named by the hash of their lines, and each is joined to the first place (by doc_id, then line) of
its name. With `every_place`, a position that goes on otherwise than the first may go on like another earlier one: its
window with each longer piece of what follows is a key too, and is joined to the first position of that key. (Without
it a tail that only a later place shares stays; the query and the pipeline have it on.) All lines of repeated runs
but the first are deleted.

Only first positions are joined, so a passage in a third of all documents costs a row for each (and one for each
line by which it goes on otherwise), not pairs; what is carried for the extension has less than `min_words` words
and hence lines.

Defined cases: null texts have no lines and stay null; lines without a word (and line ends) are never matched
and stay, unless nothing else is left; rows that repeat a doc_id and text are one document to the dedup and get
equal results; the order among texts of one doc_id is by their hash; null ids come first; an empty table gives
an empty table; other columns of the input are carried by `clean`, but for one named `deleted_lines`, which its own
replaces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.llm.common import among, beside, map_batches, written

MIN_WORDS = 50

WINDOW = T.StructType([T.StructField("window", T.LongType())] + [T.StructField(n, T.IntegerType()) for n in ("line", "lines", "beyond")])
#: `windows` that selected the position: first line, lines, hash of the lines, how many lines after it are compared.
#: `tail` are the hashes of the lines after the position, as far as these windows need them.
POSITIONS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "text_hash", "minimum")]
    + [T.StructField("position", T.IntegerType())]
    + [T.StructField("windows", T.ArrayType(WINDOW)), T.StructField("tail", T.ArrayType(T.LongType()))]
)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def line_hashes(text: str | None) -> tuple[list[int], list[int]]:
    """Signed 64-bit hashes and word counts of the lines that hold a word."""
    hashes, words = [], []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        n = len(line.split())
        if n:
            hashes.append(_signed(xxhash.xxh64_intdigest(line, 1)))
            words.append(n)
    return hashes, words


def selected(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The positions that windows select by their least line hash, each with those windows."""

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in POSITIONS.names}
        ids = zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist())
        for (doc, own), text in zip(ids, batch.column("text").to_pylist()):
            hashes, words = line_hashes(text)
            upto = np.append(0, np.cumsum(words))
            stops = np.searchsorted(upto, upto[:-1] + min_words)  # the line after the window
            reach = np.searchsorted(upto, upto[1:] + min_words) - 1  # the last line whose words from the next line on stay below
            packed = np.array(hashes, np.int64).tobytes()
            last, far = -1, 0
            for i, (stop, upper) in enumerate(zip(stops.tolist(), reach.tolist())):
                if stop > len(hashes):
                    break
                at = last if last >= i else i
                for j in range(at + 1, stop):
                    if hashes[j] < hashes[at]:
                        at = j
                if at != last:
                    if last >= 0:
                        out["tail"].append(hashes[last + 1 : far])
                    for name, value in (("doc_id", doc), ("text_hash", own), ("position", at), ("minimum", hashes[at]), ("windows", [])):
                        out[name].append(value)
                last, far = at, max(stop, upper)
                name = _signed(xxhash.xxh64_intdigest(packed[8 * i : 8 * stop], 2))
                out["windows"][-1].append({"line": i, "lines": stop - i, "window": name, "beyond": far - stop})
            if last >= 0:
                out["tail"].append(hashes[last + 1 : far])
        return out

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string"))
    return map_batches(rows, run, POSITIONS)


def _met_windows(docs: DataFrame, min_words: int) -> DataFrame:
    """The windows of all positions whose line hash is another position's too."""
    positions = written(selected(docs, min_words))
    shared = positions.groupBy("minimum").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("minimum")
    # The bitmap keeps most of the others out of the shuffle.
    met = among(positions, shared, "minimum").join(shared, "minimum", "left_semi")
    stop = F.col("w.line") + F.col("w.lines")
    return met.select("*", F.explode("windows").alias("w")).select(
        "doc_id", "text_hash", "minimum", "w.window", "w.line", "w.lines",
        F.slice("tail", stop - F.col("position"), F.col("w.beyond")).alias("after"),
    )


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, every_place: bool = False) -> DataFrame:
    """doc_id, text_hash, first and last line (of those with words) of each run that an earlier place has too.

    Windows are extended against their first place, and with `every_place` against all earlier ones.
    """
    found = _met_windows(docs, min_words)
    place = F.struct("doc_id", "text_hash", "line")
    first = (
        found.groupBy("minimum", "window")
        .agg(F.min(F.struct(place.alias("place"), F.col("after"))).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("minimum", "window", "first")
    )
    pairs = found.join(first, ["minimum", "window"]).filter(~place.eqNullSafe(F.col("first.place")))
    same = F.zip_with("after", "first.after", lambda a, b: F.coalesce(a == b, F.lit(False)))
    alike = F.array_position(same, F.lit(False)) - 1
    more = F.when(alike < 0, F.size(same)).otherwise(alike).cast("int")
    pairs = pairs.withColumn("more", more)
    last = (F.col("line") + F.col("lines") - 1 + F.col("more")).alias("last")
    if not every_place:
        return pairs.select("doc_id", "text_hash", F.col("line").alias("first"), last)
    # `after` stays only where the first place doesn't have all of it.
    met = written(
        pairs.select(
            "doc_id", "text_hash", "minimum", "window", "line", "lines", "more",
            F.when(F.col("more") < F.size("after"), F.col("after")).alias("after"),
        )
    )
    # Whoever shares a longer piece leaves the first place at the same line, so these rows have all partners.
    longer = met.filter(F.col("after").isNotNull()).select(
        "doc_id", "text_hash", "minimum", "window", "line", "lines", "after",
        F.explode(F.sequence(F.col("more") + 1, F.size("after"))).alias("more"),
    )
    longer = longer.withColumn("piece", F.xxhash64(F.slice("after", F.lit(1), F.col("more")))).drop("after")
    key = ["minimum", "window", "more", "piece"]
    earliest = longer.groupBy(*key).agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key, "place")
    runs = met.unionByName(longer.join(earliest, key).filter(~place.eqNullSafe(F.col("place"))).drop("piece", "place"), allowMissingColumns=True)
    return runs.select("doc_id", "text_hash", F.col("line").alias("first"), last)


def clean(docs: DataFrame, min_words: int = MIN_WORDS, every_place: bool = False) -> DataFrame:
    """docs with later repeated runs taken out of `text`, and a column `deleted_lines`.

    A document that loses all its lines with words has an empty text. Only texts that may have runs are shuffled; docs
    is read three times.
    """
    runs = written(
        repeated_runs(docs, min_words, every_place)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("first", "last")).alias("runs"))  # at most the lines of one document
        .select(F.col("doc_id").alias("__id"), "text_hash", "runs")
    )
    carried = [c for c in docs.columns if c != "deleted_lines"]
    inner = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    keys = runs.select(F.col("text_hash").alias("hash"))
    untouched = beside(inner, keys, "hash").select(
        *(F.col(f"row.`{c}`").cast("string" if c == "text" else inner.schema["row"].dataType[c].dataType).alias(c) for c in carried),
        F.lit(0).alias("deleted_lines"),
    )
    joined = among(inner, keys, "hash").join(
        runs, F.col("row.doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("text_hash")), "left"
    ).select("row", F.col("row.text").cast("string").alias("text"), "runs")
    schema = T.StructType([joined.schema["row"], T.StructField("text", T.StringType()), T.StructField("deleted", T.IntegerType())])

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        texts, counts = [], []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            n = 0
            if runs:
                gone: set[int] = set()
                for r in runs:
                    gone.update(range(r["first"], r["last"] + 1))
                text, n = without_lines(text, gone), len(gone)
            texts.append(text)
            counts.append(n)
        return {"row": batch.column("row"), "text": texts, "deleted": counts}

    done = map_batches(joined, run, schema)
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in carried]
    return untouched.union(done.select(*columns, F.col("deleted").alias("deleted_lines")))


def without_lines(text: str, gone: set[int]) -> str:
    """The text without the given lines (numbered among those with a word)."""
    kept, number, left = [], -1, False
    for line in text.split("\n"):
        holds = bool(line.encode("utf-8", "surrogatepass").split())
        number += holds
        if not (holds and number in gone):
            kept.append(line)
            left |= holds
    return "\n".join(kept) if left else ""
