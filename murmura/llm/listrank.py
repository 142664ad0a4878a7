"""Prefix sums along a linked list that is dealt over many tasks.

A round deals the elements by ranges of their name, so each task holds a bounded piece, follows the links inside
its piece by pointer doubling, and leaves one element per chain: its first, which points to where the chain leaves
the piece and weighs as much as the whole chain. The lists of chains shrink as far as links stay near their names;
where a round saves too little, a round of random mates follows, which shortens any list by a quarter on average
(an element with coin 0 takes in a next one with coin 1). When one piece holds all that is left, the sums are known
there, and every round passes them back to the elements it had taken in.

Work and rows moved are proportional to the list, rounds to its logarithm; every round is a written table.

Defined cases: an empty list gives an empty table; several lists are summed each on its own; an element named as
next that is not there ends its list; names are two longs and must be distinct; null names are not allowed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from murmura.llm.common import written

#: Elements one task contracts, and the number from which on one task is enough.
PIECE, SMALL = 250_000, 20_000


def _schema(n: int) -> T.StructType:
    names = ["a", "b", "na", "nb", "ha", "hb", *[f"t{i}" for i in range(n)], *[f"d{i}" for i in range(n)]]
    return T.StructType([T.StructField(name, T.LongType()) for name in names])


def _chains(a, b, na, nb, ends, weights) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(head, sums before, following, has following) of each element; a and b are sorted. following is -1 for heads' tails."""
    n = len(a)
    # The place of the next element here, if it is here.
    names = np.concatenate([np.stack([a, b], 1), np.stack([na, nb], 1)])
    order = np.lexsort((names[:, 1], names[:, 0]))
    new = np.append(False, (names[order][1:] != names[order][:-1]).any(axis=1)) if n else np.zeros(0, bool)
    code = np.empty(2 * n, np.int64)
    code[order] = np.cumsum(new)
    place = np.full(2 * n, -1)
    place[code[:n]] = np.arange(n)
    following = np.where(ends, -1, place[code[n:]])
    inside = np.flatnonzero(following >= 0)
    head = np.arange(n)
    before = np.zeros_like(weights)
    head[following[inside]] = inside
    before[following[inside]] = weights[inside]
    while True:
        further = head[head]
        if (further == head).all():
            break
        before += before[head]
        head = further
    return head, before, following, following >= 0


def _contract(todo: DataFrame, n: int, pieces: int) -> DataFrame:
    """A row per element: its head with the sums before it; heads have the next of their chain and its sums."""
    schema = _schema(n)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got:
            return
        table = pa.Table.from_batches(got)
        a, b = table.column("a").to_numpy(), table.column("b").to_numpy()
        ends = table.column("na").is_null().to_numpy()
        na, nb = (table.column(c).fill_null(0).to_numpy() for c in ("na", "nb"))
        weights = np.stack([table.column(f"t{i}").to_numpy() for i in range(n)], 1)
        head, before, _, on = _chains(a, b, na, nb, ends, weights)
        tail = np.flatnonzero(~on)
        # The tail's links and the sums through it go to the chain's head.
        out_na, out_nb, total = np.zeros_like(a), np.zeros_like(a), np.zeros_like(weights)
        out_na[head[tail]], out_nb[head[tail]] = na[tail], nb[tail]
        total[head[tail]] = before[tail] + weights[tail]
        none = np.ones(len(a), bool)
        none[head[tail]] = ends[tail]
        columns = [pa.array(a), pa.array(b), pa.array(out_na, mask=none), pa.array(out_nb, mask=none), pa.array(a[head]), pa.array(b[head])]
        columns += [pa.array(total[:, i]) for i in range(n)] + [pa.array(before[:, i]) for i in range(n)]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    dealt = todo.repartitionByRange(pieces, "a", "b") if pieces > 1 else todo.coalesce(1)
    return written(dealt.sortWithinPartitions("a", "b").mapInArrow(run, schema))


def _mates(todo: DataFrame, n: int, seed: int) -> DataFrame:
    """As _contract, by one join: elements with coin 0 take in their next if that has coin 1."""

    def coin(a: Column, b: Column) -> Column:
        return F.pmod(F.xxhash64(a, b, F.lit(seed)), F.lit(2)) == 1

    u = todo.filter(~coin(F.col("a"), F.col("b"))).select([F.col(c).alias(f"u_{c}") for c in todo.columns])
    v = todo.filter(coin(F.col("a"), F.col("b"))).select([F.col(c).alias(f"v_{c}") for c in todo.columns])
    met = u.join(v, (F.col("u_na") == F.col("v_a")) & (F.col("u_nb") == F.col("v_b")), "full")
    both = F.col("u_a").isNotNull() & F.col("v_a").isNotNull()

    def row(x: str, y: str | None) -> Column:
        """Element x with what y, taken in, leaves it."""
        link = [F.when(both, F.col(f"{y}_{c}")).otherwise(F.col(f"{x}_{c}")) if y else F.lit(None) for c in ("na", "nb")]
        sums = [F.col(f"{x}_t{i}") + F.coalesce(f"{y}_t{i}", F.lit(0)) if y else F.lit(0) for i in range(n)]
        heads = [F.col(f"{x}_a"), F.col(f"{x}_b")] if y else [F.col("u_a"), F.col("u_b")]
        before = [F.lit(0) if y else F.col(f"u_t{i}") for i in range(n)]
        values = [F.col(f"{x}_a"), F.col(f"{x}_b"), *link, *heads, *sums, *before]
        return F.struct(*[v.cast("long").alias(f.name) for v, f in zip(values, _schema(n))])

    alone = F.struct(*[
        c.cast("long").alias(f.name)
        for c, f in zip(
            [F.col("v_a"), F.col("v_b"), F.col("v_na"), F.col("v_nb"), F.col("v_a"), F.col("v_b")]
            + [F.col(f"v_t{i}") for i in range(n)]
            + [F.lit(0)] * n,
            _schema(n),
        )
    ])
    rows = F.when(both, F.array(row("u", "v"), row("v", None))).when(F.col("u_a").isNotNull(), F.array(row("u", "v"))).otherwise(F.array(alone))
    return written(met.select(F.explode(rows).alias("r")).select("r.*"))


def sums_before(items: DataFrame, weights: Sequence[str], piece: int = PIECE, small: int = SMALL) -> DataFrame:
    """items: a, b (name), na, nb (the next one's name; null at the end) and long weights.

    Returns a, b and, under the names of the weights, their sums over all elements before this one.
    """
    n = len(weights)
    todo = written(items.select("a", "b", "na", "nb", *[F.col(w).alias(f"t{i}") for i, w in enumerate(weights)]))
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds: list[DataFrame] = []
    left, before = todo.count(), None
    while left > 0:
        whole = left <= small
        if before is not None and left > 0.75 * before and not whole:
            done = _mates(todo, n, len(rounds))
        else:
            done = _contract(todo, n, 1 if whole else max(tasks, math.ceil(left / piece)))
        rounds.append(done)
        if whole:
            break
        todo = done.filter("a = ha AND b = hb").select("a", "b", "na", "nb", *[f"t{i}" for i in range(n)])
        left, before = todo.count(), left
    if not rounds:
        return todo.select("a", "b", *[F.col(f"t{i}").alias(w) for i, w in enumerate(weights)])
    # In the last round every list is one chain.
    known = rounds[-1].select("a", "b", *[F.col(f"d{i}").alias(f"s{i}") for i in range(n)])
    for done in reversed(rounds[:-1]):
        heads = known.select(F.col("a").alias("ha"), F.col("b").alias("hb"), *[f"s{i}" for i in range(n)])
        known = done.join(heads, ["ha", "hb"]).select("a", "b", *[(F.col(f"s{i}") + F.col(f"d{i}")).alias(f"s{i}") for i in range(n)])
    return known.select("a", "b", *[F.col(f"s{i}").alias(w) for i, w in enumerate(weights)])
