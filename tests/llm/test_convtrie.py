import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from murmura.llm import convtrie, listrank

CONVERSATIONS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        # Names that the operator uses for columns of its own.
        T.StructField("depth", T.StringType()),
        T.StructField("span", T.StringType()),
    ]
)


def own_turns(rows):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(sequences):
    """Every node by its prefix, sums by looking at every node for every node above it."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        save = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += save
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def got(found):
    rows = found.collect()
    assert sorted([r.enter_pos for r in rows] + [r.exit_pos for r in rows]) == list(range(2 * len(rows)))
    return sorted(
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows
    )


def some_rows(seed, n=60, words=("a", "b c", "d\te\n f", "", None)):
    """Few different turns, so that prefixes meet; null turns, roles and texts; repeated rows; ids below zero."""
    rng = random.Random(seed)
    rows = [(None, 0, "user", "a", None, None), (7, None, "user", "x y", "1", "2")]
    for c in range(-3, n):
        if c % 20 or rng.random() < 0.6:
            rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(words), "1", "2") for t in range(rng.randint(1, 6))]
    return rows


def test_against_brute_force(spark):
    rows = some_rows(1)
    table = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    turns = own_turns([r for r in rows if r[0] is None or r[0] >= 0])
    positive = table.filter("conv_id >= 0 or conv_id is null")
    assert got(convtrie.nodes(*convtrie.branched(positive))) == brute(rebuilt(turns))
    assert got(convtrie.nodes(*convtrie.plain(table))) == brute(own_turns(rows))


def test_small_spans_and_pieces(spark):
    """Spans of three turns or ids, and a tour in many pieces."""
    rows = some_rows(2, 30) + [(1000, t, "user", f"deep {t % 2}", None, None) for t in range(60)]
    rows += [(1001, t, "user", f"deep {t % 2}", None, None) for t in range(45)]
    table = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    found = convtrie.nodes(*convtrie.plain(table, span=3), span=3, piece=40, small=10)
    assert got(found) == brute(own_turns(rows))


def test_a_third_of_all_turns_in_one_conversation_and_one_parent(spark):
    rows = [(0, t, "user", "same", None, None) for t in range(300)]
    rows += [(c, 0, "user", "greeting", None, None) for c in range(1, 301)] + [(c, 1, "user", f"own {c}", None, None) for c in range(1, 301)]
    table = spark.createDataFrame(rows, CONVERSATIONS).repartition(4)
    assert got(convtrie.nodes(*convtrie.plain(table, span=16), span=16)) == brute(own_turns(rows))


def test_empty_and_turnless(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert convtrie.nodes(*convtrie.branched(empty)).collect() == []
    only_null = spark.createDataFrame([(None, 1, "a", "b", None, None)], CONVERSATIONS)
    assert convtrie.nodes(*convtrie.branched(only_null)).collect() == []
    # Without a block's first conversation the first turns go and nothing comes for them.
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1)
    one = spark.createDataFrame([(c, 0, "user", "gone", None, None)], CONVERSATIONS)
    assert got(convtrie.nodes(*convtrie.branched(one))) == brute({c: []})


def test_names_that_meet_are_an_error(spark):
    """Equal sums with another parent."""
    rows = [(1, 2, 5, 0, 0, 0, 7, 0, 0, 0, 1), (2, 2, 3, 0, 0, 0, 7, 0, 0, 0, 1)]
    prefixes = spark.createDataFrame(rows, ["conv", "depth", *convtrie.PARTS, *convtrie.SUMS, "words"])
    members = spark.createDataFrame([(1, 2), (2, 2)], ["conv", "n_turns"])
    with pytest.raises(Exception, match="share a name"):
        convtrie._nodes(prefixes, members).collect()


def lists(lengths, seed, scattered):
    """Lists over names that lie in order or anywhere; (rows, sums before each)."""
    rng = random.Random(seed)
    names = [(i // 10, i % 10) for i in range(sum(lengths))]
    if scattered:
        rng.shuffle(names)
    rows, want, at = [], {}, 0
    for n in lengths:
        x = y = 0
        for i in range(n):
            name, w = names[at + i], rng.randint(0, 9)
            following = names[at + i + 1] if i + 1 < n else (None, None)
            rows.append((*name, *following, w, 1))
            want[name] = (x, y)
            x, y = x + w, y + 1
        at += n
    return rows, want


@pytest.mark.parametrize("scattered", [False, True])
@pytest.mark.parametrize("lengths", [[300], [150, 1, 2, 90], []])
def test_list_sums(spark, lengths, scattered):
    """Names in order are contracted piecewise, scattered ones need rounds of mates."""
    rows, want = lists(lengths, 3, scattered)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "na", "nb", "w", "one")])
    found = listrank.sums_before(spark.createDataFrame(rows, schema), ["w", "one"], piece=20, small=60)
    assert {(r.a, r.b): (r.w, r.one) for r in found.collect()} == want


def test_rounds_of_mates_happen(spark, monkeypatch):
    calls = []
    real = listrank._mates
    monkeypatch.setattr(listrank, "_mates", lambda *a: calls.append(1) or real(*a))
    rows, _ = lists([400], 5, True)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "na", "nb", "w", "one")])
    listrank.sums_before(spark.createDataFrame(rows, schema), ["w"], piece=20, small=60).collect()
    assert calls
