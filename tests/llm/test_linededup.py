import random
from collections import Counter

import duckdb

from murmura.llm import linededup
from murmura.llm.queries import SQL


def brute(rows, least):
    """rows: (doc_id, text), no two alike. Texts without later repeated runs, by comparing all places."""
    lines = {}
    for doc, text in rows:
        lines[doc] = [x for x in (text or "").split("\n") if x.split()]
    windows = {}
    spans = {}
    for doc in sorted(lines):
        for i in range(len(lines[doc])):
            for j in range(i + 1, len(lines[doc]) + 1):
                if sum(len(x.split()) for x in lines[doc][i:j]) >= least:
                    spans[doc, i] = j
                    windows.setdefault(tuple(lines[doc][i:j]), (doc, i))
                    break
    gone = {doc: set() for doc in lines}
    for (doc, i), j in spans.items():
        other, k = windows[tuple(lines[doc][i:j])]
        if (other, k) == (doc, i):
            continue
        while i + (n := j - i) < len(lines[doc]) and k + n < len(lines[other]) and lines[doc][j] == lines[other][k + n]:
            j += 1
            if sum(len(x.split()) for x in lines[doc][i + 1 : j]) >= least:
                j -= 1
                break
        gone[doc] |= set(range(i, j))
    return {doc: (linededup.without_lines(text, gone[doc]) if gone[doc] else text, len(gone[doc])) for doc, text in rows}


def test_against_all_places(make_docs):
    rnd = random.Random(6)
    pool = [" ".join(rnd.choices("abcdefgh", k=rnd.randint(1, 6))) for _ in range(12)]
    for least in (1, 5, 12):
        texts = ["\n".join(rnd.choice(["", " ", *pool[:4], *pool]) for _ in range(rnd.randint(0, 25))) for _ in range(40)]
        got = {r.doc_id: (r.text, r.deleted_lines) for r in linededup.clean(make_docs(texts), least).collect()}
        assert got == brute(list(enumerate(texts)), least)


def test_whole_table(corpus):
    docs, texts = corpus
    got = {r.doc_id: (r.text, r.deleted_lines) for r in linededup.clean(docs).collect()}
    assert got == brute(texts, linededup.MIN_WORDS)


def test_a_passage_between_other_lines_goes_but_once(make_docs):
    passage = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(3))
    texts = [f"start {d}\n{passage}\nend {d}" for d in range(50)]
    rows = {r.doc_id: r for r in linededup.clean(make_docs(texts)).collect()}
    assert rows[0].text == texts[0]
    assert all(rows[d].text == f"start {d}\nend {d}" and rows[d].deleted_lines == 3 for d in range(1, 50))


def test_odd_texts(odd_docs, make_docs):
    rows = linededup.clean(odd_docs).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in odd_docs.collect())
    assert all(r.deleted_lines == 0 for r in rows)
    assert linededup.clean(make_docs([])).collect() == []


def test_repeated_rows_are_one_document(make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = linededup.clean(make_docs([text, text, text], [1, 1, 2])).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [(1, text), (1, text), (2, "")]


def brute_all(rows, least):
    """Like brute, but every earlier place of a window is tried, not the first alone."""
    lines = {doc: [x for x in (text or "").split("\n") if x.split()] for doc, text in rows}
    gone = {doc: set() for doc in lines}
    earlier = {}
    for doc in sorted(lines):
        own = lines[doc]
        for i in range(len(own)):
            stops = [j for j in range(i + 1, len(own) + 1) if sum(len(x.split()) for x in own[i:j]) >= least]
            for j in stops:
                if tuple(own[i:j]) in earlier:
                    gone[doc] |= set(range(i, j))
            for j in stops:
                earlier.setdefault(tuple(own[i:j]), (doc, i))
    return {doc: (linededup.without_lines(text, gone[doc]) if gone[doc] else text, len(gone[doc])) for doc, text in rows}


def test_a_run_that_an_earlier_place_but_the_first_goes_on_with(make_docs):
    hot = " ".join(f"w{i}" for i in range(60))
    texts = [f"{hot}\nends one", f"{hot}\ntail a\nb c", f"{hot}\ntail a\nother", f"{hot}\ntail a\nb c\nfree", hot, f"{hot}\nnew"]
    got = {r.doc_id: (r.text, r.deleted_lines) for r in linededup.clean(make_docs(texts), every_place=True).collect()}
    assert [got[d] for d in range(6)] == [
        (texts[0], 0), ("tail a\nb c", 1), ("other", 2), ("free", 3), ("", 1), ("new", 1)
    ]


def test_against_every_earlier_place(make_docs):
    rnd = random.Random(16)
    hot = [" ".join(f"h{i}x{j}" for j in range(14)) for i in range(3)]
    pool = [*hot, *(" ".join(rnd.choices("abcdefgh", k=rnd.randint(1, 4))) for _ in range(5))]
    texts = ["\n".join(rnd.choices(pool, k=rnd.randint(0, 20))) for _ in range(60)]
    rows = list(enumerate(texts))
    assert brute_all(rows, 12) != brute(rows, 12)
    got = {r.doc_id: (r.text, r.deleted_lines) for r in linededup.clean(make_docs(texts), 12, every_place=True).collect()}
    assert got == brute_all(rows, 12)


def test_sql_tries_every_earlier_place():
    rnd = random.Random(17)
    hot = [" ".join(f"h{i}x{j}" for j in range(53 if i else 27)) for i in range(3)]
    pool = [*hot, *(" ".join(rnd.choices("abcdefgh", k=rnd.randint(5, 20))) for _ in range(4))]
    rows = [(d, "\n".join(rnd.choices(pool, k=rnd.randint(0, 12)))) for d in range(150)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = brute_all(rows, linededup.MIN_WORDS)
    assert want != brute(rows, linededup.MIN_WORDS)
    assert {d: (text, n) for d, text, n in con.execute(SQL["op1_line_dedup"]).fetchall()} == want


def test_positions_are_the_minima_of_windows(make_docs):
    lines = [f"{i * 7 % 11} word{i}" for i in range(40)]
    hashes, words = linededup.line_hashes("\n".join(lines))
    picked = linededup.selected(make_docs(["\n".join(lines)]), 10).collect()
    assert {r.position for r in picked} == {min(range(i, i + 5), key=hashes.__getitem__) for i in range(36)}
    assert sorted(w.line for r in picked for w in r.windows) == list(range(36)) and len(picked) < 36


def test_clashing_and_extra_columns(make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([text, text, None]).selectExpr("doc_id", "text", "7 as deleted_lines", "'r' as row", "doc_id as __id", "'h' as hash", "'t' as text_hash")
    rows = linededup.clean(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.row, r["__id"], r.hash, r.text_hash, r.deleted_lines) for r in rows] == [
        (0, text, "r", 0, "h", "t", 0), (1, "", "r", 1, "h", "t", 1), (2, None, "r", 2, "h", "t", 0)
    ]
