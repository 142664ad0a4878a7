"""One query per operator over its whole table, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm import collocation, convtrie, decontaminate, exactdedup, html, linededup, lm, packing, quality, sharding, simhash, urls, warc
from murmura.llm.common import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query()
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Without the ids: their CRC-32 stands for them."""
    cut = packing.pieces(_table(spark, folder, "documents"), tokenizer_path())
    return packing.place(written(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))))


@_query()
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good", "toxic"
    )


_SHARD_SQL = """
WITH bits AS (  -- one step of the reflected CRC-32 polynomial for each of eight bits
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps
), base AS (
    SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, octet_length(encode(coalesce(text, ''))) + 1 AS size,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
    FROM documents
), scored AS (
    SELECT doc_id, k, size, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
            lambda a, b: xor(a >> 8, steps[xor(a & 255, b) + 1]))) AS text_crc32,
        list_transform(range(9), lambda s: -ln((CAST('0x' || substr(md5(k || '/' || s), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)) AS scores
    FROM base, bits
), placed AS (
    SELECT *, list_position(scores[1:8], list_min(scores[1:8])) - 1 AS shard,
        list_position(scores, list_min(scores)) - 1 AS grown_shard
    FROM scored
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(k), doc_id, size, text_crc32) - 1 AS slot,
    CAST(grown_shard AS INTEGER) AS grown_shard
FROM placed
"""


@_query(_SHARD_SQL)
def op6_rendezvous_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return sharding.assign(rows, "doc_id", [1.0] * 8, [1.0] * 9).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


#: The words of the labelled table. Those to block by the usual headings of public block lists (gambling,
#: medicine, adult, spam, advertising, scams, piracy), those to allow from everyday life in four languages.
BLOCKED_WORDS = """
casino poker roulette jackpot slots bingo lottery betting bets wager sportsbook blackjack
viagra cialis pills pharmacy steroids painkillers slimming botox
porn adult xxx escort webcam nude sex hentai
spam backlinks linkfarm clickbait seo doorway contentfarm bulkmail
ads adserver banner popup tracker clicks affiliate retargeting
phishing giveaway payday getrich freemoney pyramid lottowin cryptodouble
warez torrent keygen nulled cracked stream4free
""".split()
BLOCKED_WITH = "best cheap free online top live vip mega buy hot win easy".split()
ALLOWED_WORDS = """
garden museum library theatre weather cooking history travel university science orchestra railway dictionary astronomy
architecture football knitting botany mathematics hiking archive geology translation health school village council
river mountain island harbour bakery kitchen furniture bicycle camera painting sculpture poetry novel newspaper
radio chess sailing climbing swimming athletics hospital dentist insurance bank tax law parliament election embassy
church monastery castle bridge tunnel energy water forest farm orchard vineyard cheese bread coffee tea chocolate
physics chemistry biology medicine economics philosophy psychology linguistics software database compiler network
nothing something another weather northern southern eastern western thirty thousand father mother brother together
garten schule kirche zeitung wetter reise gesundheit rathaus verein buch musik wissenschaft handwerk
jardin ecole mairie journal voyage cuisine sante musique recherche theatre
escuela iglesia periodico viaje cocina salud biblioteca universidad ciencia
""".split()
ALLOWED_WITH = "the city national old new community open first blue green county central".split()
_TOPS = "com org net info example.org example.com".split()
_LANGUAGES = "en de fr es".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small made-up labelled table, about as many to block as to allow: words alone, and beside one before or after."""
    rows = []
    for block, words, more, rounds in ((True, BLOCKED_WORDS, BLOCKED_WITH, 2), (False, ALLOWED_WORDS, ALLOWED_WITH, 1)):
        for i, word in enumerate(words * rounds):
            other, second = more[(5 * i + i // len(words)) % len(more)], words[(7 * i + 3 + i // len(words)) % len(words)]
            for j, name in enumerate((word, f"{other}-{word}", f"{word}-{other}", f"{word}{second}", f"{word}-{second}")):
                k = 5 * i + j
                prefix = ("", "www.", "m.", "blog.")[k % 4]
                path = (f"/{_LANGUAGES[k % 4]}/{k}", f"/{k}.html", f"/{_LANGUAGES[k % 4]}/{k}?page={j}", "/")[(k // 4) % 4]
                rows.append((f"{('https', 'http')[k % 3 == 0]}://{prefix}{name}.{_TOPS[k % len(_TOPS)]}{path}", block))
    return spark.createDataFrame(rows, "url string, block boolean")


@_query()
def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(_table(spark, folder, "pages"), URL_RULES, urls.train(labelled_urls(spark)))


_LEAK_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_LEAK_SQL = f"""
WITH item AS (
    SELECT item_id, {_LEAK_WORDS} AS w FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows), doc AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce({_LEAK_WORDS}, []) AS w FROM documents
), spots AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)
), hits AS (SELECT r, i, n, item_id FROM spots JOIN windows USING (n, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (
    SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""


@_query(_LEAK_SQL)
def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    scanned = decontaminate.scan(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0), lambda a, h: a + h["words"]).cast("long")
    return scanned.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_LINES_SQL = """
WITH piece AS (
    SELECT doc_id, txt, pos, line_text, len(regexp_extract_all(line_text, '[^\\x20\\x09-\\x0D]+')) AS n
    FROM (
        SELECT doc_id, txt, unnest(parts) AS line_text, unnest(range(len(parts))) AS pos
        FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS txt, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
    )
), line AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, txt ORDER BY pos) AS k FROM piece WHERE n > 0
), start AS (
    SELECT doc_id, txt, l, w, unnest(range(1, len(l) + 1)) AS i
    FROM (SELECT doc_id, txt, list(line_text ORDER BY k) AS l, list(n ORDER BY k) AS w FROM line GROUP BY ALL)
), win AS (
    SELECT doc_id, txt, l, w, i, list_position(list_transform(range(i, len(l) + 1), lambda j: list_sum(w[i:j]) >= 50), true) AS n FROM start
), longer AS (  -- the window and what follows it, while the lines after the first have below 50 words
    SELECT doc_id, txt, l, w, i, n, unnest(range(n, least(len(l) - i + 1, 50) + 1)) AS m FROM win WHERE n > 0
), run AS (
    SELECT doc_id, txt, i, m AS n, array_to_string(l[i:i + m - 1], chr(10)) AS body
    FROM longer WHERE m = n OR list_sum(w[i + 1:i + m - 1]) < 50
    QUALIFY (doc_id, txt, i) <> min((doc_id, txt, i)) OVER (PARTITION BY body)
), gone AS (
    SELECT DISTINCT doc_id, txt, unnest(range(i, i + n)) AS k FROM run
), cleaned AS (
    SELECT p.doc_id, p.txt, count(g.k) AS c, bool_or(p.n > 0 AND g.k IS NULL) AS some,
        string_agg(p.line_text, chr(10) ORDER BY p.pos) FILTER (WHERE g.k IS NULL) AS text
    FROM piece p LEFT JOIN line l USING (doc_id, txt, pos) LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.txt = l.txt AND g.k = l.k
    WHERE (p.doc_id, p.txt) IN (SELECT (doc_id, txt) FROM gone) GROUP BY ALL
)
SELECT d.doc_id, CASE WHEN c.c IS NULL THEN d.text WHEN c.some THEN c.text ELSE '' END AS text, coalesce(c.c, 0) AS deleted_lines
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id AND coalesce(d.text, '') = c.txt
"""


@_query(_LINES_SQL)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.clean(_table(spark, folder, "documents"), every_place=True).select("doc_id", "text", "deleted_lines")


@_query()
def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.groups(_table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


_WARC_SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS keeper FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM k
"""


@_query(_WARC_SQL)
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.read(warc.write(_table(spark, folder, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query()
def op7_pitman_yor_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(_table(spark, folder, "documents"))


@_query()
def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(_table(spark, folder, "pages")).select("page_id", "text")


_EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query(_EXACT_SQL)
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return exactdedup.groups(_table(spark, folder, "documents"), keep="largest", carry={"text_sha256": digest})


_TRIE_SQL = """
WITH bits AS (  -- one step of the reflected CRC-32 polynomial for each of eight bits
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps
), own AS (
    SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS t
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
    SELECT c, t, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
            regexp_extract_all(hex(encode(CAST(c AS VARCHAR))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
            lambda a, b: xor(a >> 8, steps[xor(a & 255, b) + 1]))) % 4 AS h
    FROM own, bits
), rebuilt AS (
    SELECT a.c, list_concat(CASE WHEN a.h > 0 THEN coalesce(b.t[1:a.h], []) ELSE [] END, a.t[a.h + 1:]) AS t
    FROM heads a LEFT JOIN own b ON b.c = a.c - a.c % 20
), prefix AS (
    SELECT c, t[1:d] AS t, d, len(t) = d AS ends FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), node AS (
    SELECT t, d, min(c) AS c, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '') AS ids
    FROM prefix GROUP BY t, d
), kids AS (
    SELECT t[1:d - 1] AS t, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL
), full_node AS (
    SELECT a.*, p.c AS parent, coalesce(k.n, 0) AS kids,
        CASE WHEN a.d > 0 THEN (a.n - 1) * len(regexp_extract_all(a.t[a.d].text, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS save
    FROM node a LEFT JOIN node p ON p.d = a.d - 1 AND p.t = a.t[1:a.d - 1] LEFT JOIN kids k ON k.t = a.t AND k.d = a.d
), below AS (
    SELECT t[1:e] AS t, e AS d, sum(CAST(kids = 0 AS BIGINT)) AS leaves, sum(save) AS saved
    FROM (SELECT t, kids, save, unnest(range(0, d + 1)) AS e FROM full_node) GROUP BY ALL
)
SELECT a.c AS conv_id, a.d AS depth, a.parent AS parent_conv_id, a.n AS n_convs, a.kids AS n_children,
    CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(a.ids) AS ends_sha256
FROM full_node a JOIN below b ON a.t = b.t AND a.d = b.d
"""


@_query(_TRIE_SQL)
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    found = convtrie.nodes(*convtrie.branched(_table(spark, folder, "conversations")))
    return found.drop("enter_pos", "exit_pos")


_PHRASE_SQL = r"""
WITH piece AS (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
    FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents
    )
), total AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang
), gram AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, w[i:i + m - 1] AS g, count(*) AS a
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM piece, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
    GROUP BY ALL HAVING count(*) >= 30
), cut AS (
    SELECT lang, m, phrase, g, a, unnest(range(1, m)) AS k FROM gram WHERE m > 1
), scored AS (
    SELECT c.lang, c.m, c.phrase, c.g, c.a, k, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
    FROM cut c JOIN gram l ON l.lang = c.lang AND l.phrase = array_to_string(c.g[:k], ' ')
    JOIN gram r ON r.lang = c.lang AND r.phrase = array_to_string(c.g[k + 1:], ' ')
), least AS (
    SELECT lang, m, phrase, a, min((score, k, l, r)) AS s FROM scored GROUP BY ALL
), inside AS (  -- every stretch of two words or more of a longer candidate
    SELECT lang, array_to_string(g[i:i + d - 1], ' ') AS phrase, max(a) AS a
    FROM (SELECT lang, g, a, d, unnest(range(1, m - d + 2)) AS i FROM gram, (SELECT unnest([2, 3]) AS d) WHERE m > d)
    GROUP BY ALL
), ranked AS (
    SELECT c.lang, c.phrase, c.a, c.s, row_number() OVER (PARTITION BY c.lang ORDER BY c.s[1] DESC, c.a DESC, encode(c.phrase)) AS rank
    FROM least c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
    WHERE i.a IS NULL OR 100 * i.a::HUGEINT < 80 * c.a::HUGEINT
)
SELECT lang, rank, phrase, a, s[3] AS l, s[4] AS r, n, CAST(s[1] AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@_query(_PHRASE_SQL)
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocation.phrases(_table(spark, folder, "documents"))
