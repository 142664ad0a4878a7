"""A trie of conversations by their turns, with subtree sums by the Euler-tour technique.

Nodes. Turns are numbered inside their conversation and named by SHA-256 of role and text, cut to 128 bits. Place
and name of a turn are hashed, and the prefix that ends at a turn is named by its depth and the four sums of the
32-bit quarters of these hashes so far. The sums are prefix sums over spans of 4096 turns, so a conversation with a
third of all turns is many tasks' work. (Should two prefixes share a name, their members differ in their last turn
or their parent, which is checked for each node and raises an error.) A node is then known by its smallest member
and its depth; no two nodes share these.

Tour. Each node has an enter and an exit arc. Enter leads to the first child's enter (children by smallest member),
or to the own exit; exit leads to the next sibling's enter or the parent's exit. Next siblings are found inside
spans of 4096 ids, spans of a parent are linked by their first ids, so a parent of any number of children is no
single task's work. The tour is ranked distributedly (`listrank`) with weights one, leaf and savings; a subtree's
sums are the differences of the prefix sums at its two arcs.

The digest of the members that end at a node is a single SHA-256 over their ids, so the ids of one node pass one
task; they are joined to strings by spans of 4096 ids before, and only one string is held at a time.

Defined cases: rows without a conv_id are no conversation's; null turns come first, equal turns are ordered by role
and text (their digest); null roles and texts are empty; repeated rows are turns of their own; a conversation without turns is
a member of the root; an empty table has no nodes, not even the root; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from murmura.llm import listrank
from murmura.llm.common import written

SPAN = 4096
PARTS = ("p0", "p1", "p2", "p3")
SUMS = ("s0", "s1", "s2", "s3")


def _named_turns(conversations: DataFrame) -> DataFrame:
    """conv, turn, the turn's name, words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    name = F.unhex(F.substring(name, 1, 32)).alias("name")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", name, F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return rows.filter("conv IS NOT NULL")


def numbered_turns(conversations: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """(turns with their number `pos` from 1, counts: conv and n).

    Numbers are counted inside spans of turn values and moved up by the spans before.
    """
    rows = _named_turns(conversations).withColumn("span", F.coalesce(F.floor(F.col("turn") / span).cast("long"), F.lit(-(1 << 62)).cast("long")))
    spans = rows.groupBy("conv", "span").agg(F.count(F.lit(1)).alias("in_span"))
    spans = spans.withColumn("before", F.sum("in_span").over(Window.partitionBy("conv").orderBy("span")) - F.col("in_span"))
    order = Window.partitionBy("conv", "span").orderBy(F.col("turn").asc_nulls_first(), "name")
    turns = rows.join(spans, ["conv", "span"]).withColumn("pos", F.col("before") + F.row_number().over(order))
    counts = spans.groupBy("conv").agg(F.sum("in_span").alias("n"))
    return turns.select("conv", "pos", "name", "words"), counts


def branched(conversations: DataFrame, block: int = 20, most: int = 4, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their block of ids does: (sequences, members).

    Conversation c gets the first h = crc32(decimal c) % most turns of conversation c - c % block, then its own
    turns after its first h. sequences: conv, depth from 1, the turn's name, words, ends (it is the last);
    members: conv, n_turns.
    """
    turns, counts = numbered_turns(conversations, span)
    turns = written(turns)
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    convs = counts.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % block).alias("base"))
    of_base = counts.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(of_base, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
    convs = written(convs.withColumn("n_turns", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    own = turns.join(convs, "conv").filter("pos > h").withColumn("depth", F.col("k") + F.col("pos") - F.col("h"))
    first = turns.filter((F.col("conv") % block == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "base")
    taken = first.join(convs.filter("k > 0"), "base").filter("pos <= k").withColumn("depth", F.col("pos"))
    columns = ["conv", "depth", "name", "words", (F.col("depth") == F.col("n_turns")).alias("ends")]
    return own.select(columns).unionByName(taken.select(columns)), convs.select("conv", "n_turns")


def plain(conversations: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """(sequences, members) of the conversations as they are."""
    turns, counts = numbered_turns(conversations, span)
    members = counts.select("conv", F.col("n").alias("n_turns"))
    rows = turns.join(members, "conv").select("conv", F.col("pos").alias("depth"), "name", "words", (F.col("pos") == F.col("n_turns")).alias("ends"))
    return rows, members


def _prefixes(sequences: DataFrame, span: int) -> DataFrame:
    """sequences with the sums of their prefix."""
    place = F.md5(F.concat(F.col("depth").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("name")))
    rows = sequences.select("conv", "depth", "words", "ends", place.alias("place"), F.floor(F.col("depth") / span).alias("span"))
    rows = rows.withColumns({p: F.conv(F.substring("place", 8 * i + 1, 8), 16, 10).cast("long") for i, p in enumerate(PARTS)}).drop("place")
    inside = Window.partitionBy("conv", "span").orderBy("depth")
    local = rows.select("*", *[F.sum(p).over(inside).alias(f"in_{s}") for p, s in zip(PARTS, SUMS)])
    totals = rows.groupBy("conv", "span").agg(*[F.sum(p).alias(f"all_{s}") for p, s in zip(PARTS, SUMS)])
    earlier = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("conv", "span", *[F.coalesce(F.sum(f"all_{s}").over(earlier), F.lit(0)).alias(f"base_{s}") for s in SUMS])
    return local.join(bases, ["conv", "span"]).select(
        "conv", "depth", *PARTS, "words", "ends", *[(F.col(f"in_{s}") + F.col(f"base_{s}")).alias(s) for s in SUMS]
    )


def _one(name: str) -> Column:
    """The value all members of a node have; an error if they differ."""
    same = F.min(name) == F.max(name)
    return F.when(same, F.min(name)).otherwise(F.raise_error(F.lit("two prefixes share a name")).cast("long")).alias(name)


def _nodes(prefixes: DataFrame, members: DataFrame) -> DataFrame:
    """depth, sums, the parent's sums (u0..u3), conv_id, n_convs, words of the last turn."""
    up = [(F.col(s) - F.col(p)).alias(f"u{i}") for i, (s, p) in enumerate(zip(SUMS, PARTS))]
    inner = (
        prefixes.select("conv", "depth", *SUMS, *up, "words")
        .groupBy("depth", *SUMS)
        .agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), *[_one(f"u{i}") for i in range(4)])
    )
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), *[zero.alias(s) for s in SUMS], "conv_id", "n_convs", zero.alias("words"), *[zero.alias(f"u{i}") for i in range(4)])
    return inner.unionByName(root)


def _digests(ends: DataFrame, span: int) -> DataFrame:
    """conv_id, depth, ends_sha256 from rows conv_id, depth, conv."""
    strings = ends.groupBy("conv_id", "depth", F.floor(F.col("conv") / span).alias("span")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")  # at most span distinct ids
    )
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("depth", T.LongType()), T.StructField("ends_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            rows = zip(*[batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")])
            for conv_id, depth, ids in rows:
                if (conv_id, depth) == now:
                    digest.update(b",")
                else:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = (conv_id, depth), hashlib.sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=schema.names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, digest.hexdigest())], names=schema.names)

    by = ["conv_id", "depth"]
    return strings.repartition(*by).sortWithinPartitions(*by, "span").mapInArrow(run, schema)


def _arcs(nodes: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    """(arcs of the tour, children: conv_id, depth, n_children). An arc is named (conv_id, 2 depth + 1 if it is an exit)."""
    kids = nodes.filter("depth > 0").withColumn("span", F.floor(F.col("conv_id") / span))
    by = ["parent_conv_id", "depth", "span"]
    spans = kids.groupBy(*by).agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"))
    after = F.lead("first").over(Window.partitionBy("parent_conv_id", "depth").orderBy("span")).alias("next_span")
    inside = F.lead("conv_id").over(Window.partitionBy(*by).orderBy("conv_id"))
    linked = kids.withColumn("inside", inside).join(spans.select(*by, after), by).withColumn("sibling", F.coalesce("inside", "next_span"))
    parents = spans.groupBy("parent_conv_id", "depth").agg(F.sum("n").alias("n_children"), F.min("first").alias("child"))
    parents = parents.select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "n_children", "child")
    root = nodes.filter("depth = 0").withColumn("sibling", F.lit(None).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "words", "sibling"]
    known = linked.select(columns).unionByName(root.select(columns)).join(parents, ["conv_id", "depth"], "left")
    known = written(known.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    leaf = F.col("n_children") == 0
    name = F.col("depth") * 2
    enter = [
        F.col("conv_id").alias("a"),
        name.alias("b"),
        F.coalesce("child", "conv_id").alias("na"),
        F.when(leaf, name + 1).otherwise(name + 2).alias("nb"),
        F.lit(1).cast("long").alias("pos"),
        leaf.cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    ]
    leave = [
        F.col("conv_id"),
        name + 1,
        F.coalesce("sibling", "parent_conv_id"),
        F.when(F.col("sibling").isNotNull(), name).when(F.col("depth") > 0, name - 1),
        F.lit(1).cast("long"),
        F.lit(0).cast("long"),
        F.lit(0).cast("long"),
    ]
    names = ["a", "b", "na", "nb", "pos", "leaves", "saved"]
    both = F.array(*[F.struct(*[c.alias(n) for c, n in zip(arc, names)]) for arc in (enter, leave)])
    return known.select(F.explode(both).alias("arc")).select("arc.*"), known


def nodes(sequences: DataFrame, members: DataFrame, span: int = SPAN, **ranking: int) -> DataFrame:
    """A row per node of the trie of (sequences, members), as `plain` or `branched` give them.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the ranks of the
    node's two arcs in the tour, enter_pos and exit_pos. `ranking` goes to listrank.sums_before.
    """
    prefixes = written(_prefixes(sequences, span))
    found = written(_nodes(prefixes, members))
    root = found.filter("depth = 0").select("conv_id")  # one row at most
    names = ["depth", *SUMS]
    parent = found.select((F.col("depth") + 1).alias("depth"), *[F.col(s).alias(f"u{i}") for i, s in enumerate(SUMS)], F.col("conv_id").alias("parent_conv_id"))
    top = F.broadcast(root.select(F.lit(1).cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "words"]
    placed = (
        found.filter("depth > 1").join(parent, ["depth", "u0", "u1", "u2", "u3"]).select(columns)
        .unionByName(found.filter("depth = 1").join(top, "depth").select(columns))
        .unionByName(found.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns))
    )
    arcs, known = _arcs(written(placed), span)
    sums = listrank.sums_before(arcs, ["pos", "leaves", "saved"], **ranking)
    subtree = sums.groupBy(F.col("a").alias("conv_id"), F.floor(F.col("b") / 2).alias("depth")).agg(
        *[(F.max(c) - F.min(c)).alias(n) for c, n in (("leaves", "n_leaves"), ("saved", "saved_tokens"))],
        F.min("pos").alias("enter_pos"),
        F.max("pos").alias("exit_pos"),
    )
    ends = prefixes.filter("ends").join(found.select("conv_id", *names), names).select("conv_id", "depth", "conv")
    turnless = members.filter("n_turns = 0").select("conv", F.lit(0).cast("long").alias("depth"))
    turnless = turnless.join(F.broadcast(root.withColumn("depth", F.lit(0).cast("long"))), "depth").select("conv_id", "depth", "conv")
    digests = _digests(ends.unionByName(turnless), span)
    by = ["conv_id", "depth"]
    return known.join(subtree, by).join(digests, by, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        "enter_pos",
        "exit_pos",
    )
