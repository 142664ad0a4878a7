"""Scalar functions over whole texts, and similarity of pairs of texts and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmura.functions import similarity as S
from murmura.functions import text as X
from murmura.operators import embeddings as E
from workload.inputs import PAINS_SQL, SENT_SQL, norm_sql, words_sql
from workload.registry import query, r6


@query(f"select doc_id, {norm_sql('text')} txt from documents")
def normalize_text(t):
    return t.documents.select("doc_id", X.normalize_text(F.col("text")).alias("txt"))


@query(f"""with n as (select doc_id, list_filter(string_split({norm_sql('text')}, ' '), lambda w: w <> '') w from documents)
select doc_id, len(w) n_tokens, len(list_distinct(w)) n_words, array_to_string(list_sort(list_distinct(w)), ' ') palavras from n""")
def tokens(t):
    rows = t.documents.select("doc_id", X.normalize_text(F.col("text")).alias("x"))
    return rows.select(
        "doc_id",
        F.size(X.tokens(F.col("x"))).cast("long").alias("n_tokens"),
        F.size(X.word_set(F.col("x"))).cast("long").alias("n_words"),
        F.array_join(F.array_sort(X.word_set(F.col("x"))), " ").alias("palavras"),
    )


@query(r"""select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
'(?i)R\$ ?[0-9][0-9.,]*', ' ', 'g'), '[0-9]{1,4}[/-][0-9]{1,2}[/-][0-9]{1,4}', ' ', 'g'), '[0-9]+([.,][0-9]+)* ?%', ' ', 'g'),
'[0-9]+([.,][0-9]+)*', ' ', 'g'), '[\s\x0B\x1C-\x1F\x{85}\p{Z}]+', ' ', 'g')) txt from documents""")
def generalize_text(t):
    return t.documents.select("doc_id", X.generalize_text(F.col("text")).alias("txt"))


@query("""select doc_id, lower(left(lang, 4) || '_' || left(source, 4) || '_' || left(md5(lower(text)), 8)) id from documents""")
def canonical_id(t):
    return t.documents.select("doc_id", X.canonical_id(F.col("text"), F.col("lang"), F.col("source")).alias("id"))


PAIRS_SQL = SENT_SQL + """, nb as (select doc_id, pos, txt a, lead(txt) over (partition by doc_id order by pos) b from sent),
pr as (select *, string_split(a, ' ') wa, string_split(b, ' ') wb, length(a) la, length(b) lb from nb where b is not null),
sc as (select *, list_distinct(wa) da, list_distinct(wb) db, list_intersect(list_distinct(wa), list_distinct(wb)) cm from pr),
sm as (select doc_id, pos, a, b, len(cm) / (len(da) + len(db) - len(cm)) jac,
  case when la > lb then contains(a, b) else contains(b, a) end::int::double cont,
  case when len(cm) = 0 then 0e0 else list_avg(list_transform(cm, lambda x: 1 - abs((len(wa) - list_position(list_reverse(wa), x)) / len(wa)
    - (len(wb) - list_position(list_reverse(wb), x)) / len(wb)))) end ord,
  1 - levenshtein(a, b) / greatest(la, lb) ed from sc)"""


def neighbours(t):
    """Every sentence of a document with the one after it; pairs come from the row, not from a join."""
    rows = t.documents.select(
        "doc_id", F.transform(X.sentences(F.col("text")), lambda s: X.ascii_only(X.normalize_text(s))).alias("s")
    )
    n = F.greatest(F.size("s") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("s", 1, n).alias("a"), F.slice("s", 2, n).alias("b"))
    return rows.select("doc_id", F.posexplode(pairs).alias("pos", "p")).select("doc_id", "pos", "p.a", "p.b")


def _scored(t, score):
    return neighbours(t).select("doc_id", F.col("pos").cast("long").alias("pos"), r6(score(F.col("a"), F.col("b"))).alias("s"))


@query(f"with {PAIRS_SQL} select doc_id, pos, round(jac + 1e-9, 6) s from sm")
def sim_jaccard(t):
    return _scored(t, S.jaccard)


@query(f"with {PAIRS_SQL} select doc_id, pos, cont s from sm")
def sim_containment(t):
    return _scored(t, S.containment)


@query(f"with {PAIRS_SQL} select doc_id, pos, round(ord + 1e-9, 6) s from sm")
def sim_word_order(t):
    return _scored(t, S.word_order)


@query(f"with {PAIRS_SQL} select doc_id, pos, round(ed + 1e-9, 6) s from sm")
def sim_edit(t):
    return _scored(t, S.edit_score)


@query()
def sim_sequence(t):
    return _scored(t, S.sequence_ratio())


TEXTUAL = "greatest(0e0, least(1e0, 0.4e0 * ed + 0.3e0 * jac + 0.2e0 * cont + 0.1e0 * ord))"


@query(f"with {PAIRS_SQL} select doc_id, pos, round({TEXTUAL} + 1e-9, 6) s from sm")
def sim_textual(t):
    return _scored(t, S.textual)


@query(f"""with {PAIRS_SQL} select doc_id, pos, round(case when ed between 0.6e0 and 0.8e0 then 0.7e0 * ed + 0.3e0 * {TEXTUAL} else ed end + 1e-9, 6) s,
case when ed between 0.6e0 and 0.8e0 then 'embedding_plus_llm' else 'embeddings_only' end "method" from sm""")
def sim_banded(t):
    rows = neighbours(t).withColumn("ed", S.edit_score(F.col("a"), F.col("b")))
    # The second score only where the first is ambiguous.
    second = F.when(F.col("ed").between(0.6, 0.8), S.textual(F.col("a"), F.col("b")))
    return rows.select(
        "doc_id", F.col("pos").cast("long").alias("pos"), r6(S.banded(F.col("ed"), second)).alias("s"),
        S.band_method(F.col("ed")).alias("method"),
    )


@query("""select l_orderkey, l_linenumber, round(least(1e0, l_discount * 9e0 * (0.8e0 + 0.2e0 * coalesce(l_tax * 10e0, 1)) *
case when l_quantity > 5 then 1.05e0 else 1e0 end * case l_returnflag when 'A' then 1e0 when 'N' then 0.95e0 else 0.9e0 end *
case when l_linestatus = 'O' then 1.02e0 else 1.05e0 end) + 1e-9, 6) s from lineitem""")
def sim_boosted(t):
    tier = F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "N", 0.95).otherwise(0.9)
    method = F.when(F.col("l_linestatus") == "O", "embeddings_only").otherwise("embedding_plus_llm")
    factor = S.canonical_factor(F.col("l_tax") * 10.0, F.col("l_quantity"))
    score = S.boosted(F.col("l_discount") * 9.0, factor, tier, S.method_factor(method))
    return t.lineitem.select("l_orderkey", "l_linenumber", r6(score).alias("s"))


@query("""with e as (select vec_id, label, embedding::double[] v from embeddings),
u as (select label, unnest(v) x, generate_subscripts(v, 1) i from e),
m as (select label, list(a order by i) m from (select label, i, avg(x) a from u group by all) group by label)
select vec_id, e.label, round(greatest(0e0, least(1e0, (list_cosine_similarity(v, m) + 1) / 2)) + 1e-9, 6) s from e join m on e.label = m.label""")
def sim_cosine(t):
    """Each vector with the mean vector of its label."""
    means = E.mean_vectors(t.embeddings, "label", "embedding").withColumn("norm_m", S.norm(F.col("mean_vector")))
    return t.embeddings.join(means, "label").select(
        "vec_id", "label",
        r6(S.cosine_mapped(F.col("embedding"), F.col("mean_vector"), norm_b=F.col("norm_m"))).alias("s"),
    )


@query(f"""with {PAINS_SQL} select pain_id, length(dor_especifica) between 1 and 200 and len(string_split(dor_especifica, ' ')) <= 40 ok from pains""")
def simplify_gate(t):
    return t.pains.select("pain_id", X.within_simple_limits(F.col("dor_especifica")).alias("ok"))
