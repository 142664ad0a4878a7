"""Extraction, classification, validation, routing, taxonomy, model hook."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura import constants as K
from murmura.functions import text as X
from murmura.operators import classify as CL
from murmura.operators import extract as EX
from murmura.operators import lexicon as L
from murmura.operators import metrics as ME
from murmura.operators import model as MO
from murmura.operators import route as R
from murmura.operators import validate as V
from workload.inputs import PAINS_SQL, SENT_SQL, pieces_sql, words_sql
from workload.registry import joined, query, r6

DOC_WORDS_SQL = f"dw as (select doc_id, lang, source, unnest({words_sql('text')}) term from documents)"
TOP_SQL = DOC_WORDS_SQL + """, top as (select term, row_number() over (order by n desc, term) - 1 rank from
  (select term, count(*) n from dw where length(term) >= 4 group by term order by n desc, term limit 30)),
lex as (select 'cat' || (rank % 6) label, 'fam' || (rank % 4) fam, 'prod' || (rank % 9) prod, term, rank from top)"""
PW_SQL = f"pw as (select pain_id, categoria, unnest({words_sql('dor_especifica')}) term from pains)"


def lexicon(t):
    """The 30 most frequent words of the documents, dealt to six categories, four families, nine products."""
    rank = F.col("rank")
    return L.top_terms(t.documents, "text").select(
        "term", "rank",
        F.concat(F.lit("cat"), (rank % 6).cast("string")).alias("label"),
        F.concat(F.lit("fam"), (rank % 4).cast("string")).alias("fam"),
        F.concat(F.lit("prod"), (rank % 9).cast("string")).alias("prod"),
    )


def feedback(t):
    return t.documents.select(F.col("doc_id").cast("string").alias("feedback_id"), F.col("text").alias("feedback_text"))


def extracted(t):
    """Pains of every document: the sentences with one of the lexicon's words."""
    return EX.extract_pains(feedback(t), lexicon(t).select("term"))


EXTRACT_SQL = TOP_SQL + f", s0 as (select doc_id::varchar feedback_id, text feedback_text, parts s from ({pieces_sql('documents', '*')}))," + r"""
s1 as (select feedback_id, feedback_text, unnest(s) dor, generate_subscripts(s, 1) - 1 pos from s0),
s2 as (select *, len(list_intersect(list_distinct(""" + words_sql("dor") + """), (select list(term) from top)))::int hits from s1),
s3 as (select *, row_number() over (partition by feedback_id order by hits desc, pos) rn from s2 where hits > 0),
ex as (select feedback_id, feedback_text, pos, dor dor_especifica, hits, 1 - pow(0.5e0, hits) confidence from s3)"""


@query(f"with {EXTRACT_SQL} select feedback_id, pos::int pos, dor_especifica, hits, confidence, 'MEDIA' severidade from ex")
def extract_pains(t):
    return extracted(t)


@query(f"""with {PAINS_SQL}, r as (select *, row_number() over (partition by feedback_id order by confidence_score desc, pos) rn from pains)
select pain_id, feedback_id, dor_especifica from r where rn <= 7""")
def cap_pains(t):
    rows = t.pains.withColumnRenamed("confidence_score", "confidence")
    return EX.cap_pains(rows).select("pain_id", "feedback_id", "dor_especifica")


@query(f"""with {PAINS_SQL} select pain_id, coalesce(case when length(dor_especifica) % 3 = 0 then null else categoria end, 'INCONCLUSIVO') categoria,
'MEDIA' severidade, '' reasoning, confidence_score confidence from pains""")
def pain_defaults(t):
    holes = t.pains.select(
        "pain_id", "dor_especifica", F.col("confidence_score").alias("confidence"),
        F.when(F.length("dor_especifica") % 3 != 0, F.col("categoria")).alias("categoria"),
    )
    return EX.pain_defaults(holes).select("pain_id", "categoria", "severidade", "reasoning", "confidence")


@query(f"""with {PAINS_SQL} select pain_id, confidence_score >= 0.6 may_create, confidence_score < 0.7 needs_enhancement from pains""")
def confidence_gate(t):
    return EX.confidence_gate(t.pains, "confidence_score").select("pain_id", "may_create", "needs_enhancement")


def _argmax_sql(label: str, ties_unknown: bool = False) -> str:
    tie = "and not coalesce(n2 = n1, false)" if ties_unknown else ""
    return f"""h as (select pain_id, {label} label, count(*) n from pw join lex on pw.term = lex.term group by all),
r as (select *, row_number() over (partition by pain_id order by n desc, label) rn, sum(n) over (partition by pain_id) total from h),
b as (select pain_id, max(case when rn = 1 then label end) l1, max(case when rn = 1 then n end) n1, max(case when rn = 2 then n end) n2,
  max(total) total, string_agg(case when rn in (2, 3) then label end, '|' order by rn) alt from r group by 1),
res as (select p.pain_id, case when l1 is not null {tie} then l1 else 'INCONCLUSIVO' end label,
  round(case when l1 is not null {tie} then n1 / total else 0 end + 1e-9, 6) conf, coalesce(alt, '') alt from pains p left join b on b.pain_id = p.pain_id)"""


def _classified(t, label, **options):
    lex = lexicon(t).select(F.col(label).alias("label"), "term")
    out = CL.classify(t.pains.select("pain_id", "dor_especifica"), "pain_id", "dor_especifica", lex, "x", **options)
    return out.select(
        "pain_id", F.col("x").alias("label"), r6("x_confidence").alias("conf"), joined("x_alternatives").alias("alt")
    )


@query(f"with {PAINS_SQL}, {TOP_SQL}, {PW_SQL}, {_argmax_sql('label')} select * from res")
def classify_category(t):
    return _classified(t, "label")


@query(f"with {PAINS_SQL}, {TOP_SQL}, {PW_SQL}, {_argmax_sql('fam')} select * from res")
def classify_family(t):
    return _classified(t, "fam")


@query(f"""with {PAINS_SQL}, {TOP_SQL}, pw as (select pain_id, familia, unnest({words_sql('dor_especifica')}) term from pains),
rows as (select distinct 'f' || (rank % 3) familia, prod from lex),
h as (select pain_id, pw.familia, lex.prod label, count(*) n from pw join lex on pw.term = lex.term
  join rows on rows.familia = pw.familia and rows.prod = lex.prod group by all),
r as (select *, row_number() over (partition by pain_id order by n desc, label) rn, sum(n) over (partition by pain_id) total from h),
b as (select pain_id, max(case when rn = 1 then label end) l1, max(case when rn = 1 then n end) n1, max(case when rn = 2 then n end) n2,
  max(total) total from r group by 1)
select p.pain_id, familia, case when l1 is not null and not coalesce(n1 = n2, false) then l1 else 'INCONCLUSIVO' end produto,
round(case when l1 is not null and not coalesce(n1 = n2, false) then n1 / total else 0 end + 1e-9, 6) conf
from pains p left join b on b.pain_id = p.pain_id""")
def classify_product(t):
    lex = lexicon(t)
    rows = lex.select(
        F.concat(F.lit("f"), (F.col("rank") % 3).cast("string")).alias("familia"), F.col("prod").alias("produto")
    ).distinct()
    pains = t.pains.select("pain_id", "familia", "dor_especifica")
    out = CL.classify_product(
        pains, "pain_id", "dor_especifica", lex.select(F.col("prod").alias("label"), "term"), rows, max_words=1
    )
    return out.select("pain_id", "familia", "produto", r6("produto_confidence").alias("conf"))


@query(f"""with {PAINS_SQL} select count(*) total_dores, count(*) filter (familia <> 'INCONCLUSIVO') familias_identificadas,
count(*) filter (produto <> 'INCONCLUSIVO') produtos_identificados,
count(*) filter (familia = 'INCONCLUSIVO' and produto = 'INCONCLUSIVO') inconclusivos from pains""")
def classification_stats(t):
    return CL.classification_stats(t.pains)


@query(f"""with {PAINS_SQL}, k as (select feedback_id, dor_especifica d, contains(d, 'that') or contains(d, 'para') or contains(d, 'und') or contains(d, 'que') kw from pains)
select feedback_id, count(*) total, count(*) filter (length(d) between 10 and 350 and kw) valid_pains_count,
round(least(count(*) filter (length(d) between 10 and 350 and kw) / count(*), 1) + 1e-9, 6) overall_quality, true is_valid, 0.7e0 confidence_score from k group by 1""")
def validate_basic(t):
    return V.validate_basic(t.pains, ("that", "para", "und", "que")).withColumn("overall_quality", r6("overall_quality"))


@query(f"""with {EXTRACT_SQL}, w as (select feedback_id, pos, list_distinct({words_sql('dor_especifica')}) pw, list_distinct({words_sql('feedback_text')}) fw from ex),
g as (select feedback_id, pos, case when len(pw) = 0 then 0 else len(list_intersect(pw, fw)) / len(pw) end coh,
  case when list_has_any(pw, (select list(term) from top)) then 1e0 else 0e0 end rel from w)
select feedback_id, pos::int pos, round(coh + 1e-9, 6) semantic_coherence, rel domain_relevance, coh >= 0.5 and rel > 0 is_valid,
round((coh + rel) / 2 + 1e-9, 6) confidence_score from g""")
def validate_grounding(t):
    words = feedback(t).select("feedback_id", V.source_words(F.col("feedback_text")).alias("feedback_words"))
    both = extracted(t).join(words, "feedback_id")
    out = V.validate_grounding(both, lexicon(t).select("term"), feedback="feedback_words")
    return out.select(
        "feedback_id", "pos", r6("semantic_coherence").alias("semantic_coherence"), "domain_relevance", "is_valid",
        r6("confidence_score").alias("confidence_score"),
    )


@query(f"""with {PAINS_SQL} select categoria, count(*) filter (coalesce(is_valid, true)) kept, count(*) filter (not coalesce(is_valid, true)) rejected
from pains group by 1""")
def validity_filter(t):
    return V.validity_counts(t.pains, "categoria")


@query(f"""with {PAINS_SQL} select categoria, count(*) filter (coalesce(is_valid, false)) valid_pains_count, round(avg(confidence_score) + 1e-9, 6) avg_confidence
from pains group by 1""")
def validation_summary(t):
    return V.validation_summary(t.pains, "categoria").withColumn("avg_confidence", r6("avg_confidence"))


@query(f"""with {EXTRACT_SQL}, v as (select doc_id::varchar feedback_id, quality = 1 is_valid, 0.9e0 - 0.5e0 * toxic conf from labels),
p as (select *, row_number() over (partition by feedback_id order by hits desc, pos) - 1 i from ex)
select p.feedback_id, i::int pos, dor_especifica, case when i = 0 then coalesce(is_valid, true) else true end is_valid,
case when i = 0 then coalesce(conf, 1e0) else 1e0 end confidence_score from p left join v on v.feedback_id = p.feedback_id""")
def zip_validations(t):
    """The label of a document is the validation of its first pain; the other pains have none."""
    item = F.struct((-F.col("hits")).alias("k"), F.col("pos").alias("p"), "dor_especifica")
    pains = extracted(t).groupBy("feedback_id").agg(F.array_sort(F.collect_list(item)).alias("dores"))
    one = F.struct((F.col("quality") == 1).alias("is_valid"), (0.9 - 0.5 * F.col("toxic")).alias("confidence_score"))
    validations = t.labels.select(F.col("doc_id").cast("string").alias("feedback_id"), F.array(one).alias("validations"))
    return V.zip_validations(pains, validations).select(
        "feedback_id", "pos", F.col("dor.dor_especifica").alias("dor_especifica"), "is_valid", "confidence_score"
    )


QUALITY_SQL = f"""{EXTRACT_SQL}, ctxed as (select feedback_id, confidence, case when length(dor_especifica) % 3 = 0 then 'INCONCLUSIVO' else 'f' end familia from ex),
per as (select feedback_id, count(*) n, count(*) filter (familia = 'INCONCLUSIVO') u, avg(confidence) c from ctxed group by 1),
q as (select doc_id::varchar feedback_id, coalesce(n, 0) n, coalesce(u, 0) "unknown", coalesce(c, 0) avg_confidence,
  case when n_chars % 5 = 0 then 0.4e0 else 1e0 end extraction_confidence from documents left join per on feedback_id = doc_id::varchar)"""


def quality(t):
    rows = t.documents.select(
        F.col("doc_id").cast("string").alias("feedback_id"),
        F.when(F.col("n_chars") % 5 == 0, 0.4).alias("extraction_confidence"),
    )
    pains = extracted(t).withColumn("familia", F.when(F.length("dor_especifica") % 3 == 0, K.UNKNOWN).otherwise("f"))
    return R.feedback_quality(rows, pains)


@query(f"""with {QUALITY_SQL} select feedback_id, n, "unknown", round(avg_confidence + 1e-9, 6) avg_confidence,
case when n = "unknown" then 'early_exit' when avg_confidence < 0.5 or extraction_confidence < 0.5 then 'enhance_quality' else 'continue_normalization' end route from q""")
def route_feedback(t):
    return R.route_feedback(quality(t)).select(
        "feedback_id", "n", "unknown", r6("avg_confidence").alias("avg_confidence"), "route"
    )


@query(f"""with {QUALITY_SQL} select feedback_id, array_to_string(list_filter([case when n = 0 then 'no_pains' end,
case when n = "unknown" and n > 0 then 'all_unknown' end, case when avg_confidence < 0.3 then 'low_confidence' end], lambda x: x is not null), '|') motivos from q""")
def early_exit_reasons(t):
    return R.early_exit_reasons(quality(t)).select("feedback_id", joined("exit_reasons").alias("motivos"))


@query(f"""with {EXTRACT_SQL}, per as (select feedback_id, avg(confidence) c from ex group by 1)
select doc_id::varchar feedback_id, round(coalesce(c, 0) + 1e-9, 6) avg_confidence from documents left join per on feedback_id = doc_id::varchar""")
def feedback_confidence(t):
    return ME.feedback_confidence(feedback(t), extracted(t)).withColumn("avg_confidence", r6("avg_confidence"))


SEED_SQL = "seed as (select * from (values " + ", ".join(
    f"('{c}', '{d}', {e!r}, {s}e0)" for c, d, e, s in K.SEED_TAXONOMY
) + ") x(categoria, definicao, exemplos, confidence))"
TAXONOMY_SQL = TOP_SQL + ", " + SEED_SQL + """, emer as (select case when label = 'cat0' then 'TECNOLOGIA' else upper(label) end categoria,
  'Termos ' || label definicao, list(term order by term) exemplos, 0.5e0 + 0.1e0 * min(rank) confidence from lex group by label),
tax as (select coalesce(e.categoria, s.categoria) categoria, coalesce(e.definicao, s.definicao) definicao,
  coalesce(e.exemplos, s.exemplos) exemplos, coalesce(e.confidence, s.confidence) confidence
  from seed s full join emer e on s.categoria = e.categoria)"""


def taxonomy(t):
    """Seed categories overridden by categories made of the documents' frequent words."""
    label = F.col("label")
    emergent = lexicon(t).groupBy("label").agg(
        F.array_sort(F.collect_list("term")).alias("exemplos"), (0.5 + 0.1 * F.min("rank")).alias("confidence")
    ).select(
        F.when(label == "cat0", "TECNOLOGIA").otherwise(F.upper(label)).alias("categoria"),
        F.concat(F.lit("Termos "), label).alias("definicao"), "exemplos", "confidence",
    )
    return L.merge_taxonomies(L.seed_taxonomy(t.spark), emergent)


@query(f"with {TAXONOMY_SQL} select categoria, definicao, array_to_string(exemplos, '|') exemplos, round(confidence + 1e-9, 6) confidence from tax")
def taxonomy_merge(t):
    return taxonomy(t).select("categoria", "definicao", joined("exemplos").alias("exemplos"), r6("confidence").alias("confidence"))


@query(f"""with {TAXONOMY_SQL} select categoria, case when confidence >= 0.8 then '+' else '-' end || ' ' || categoria || ': ' || definicao ||
' (Ex: ' || array_to_string(exemplos[1:3], ', ') || ')' linha from tax""")
def taxonomy_summary(t):
    return L.taxonomy_summary(taxonomy(t))


@query(f"""with {PAINS_SQL}, {TOP_SQL}, {PW_SQL}, {_argmax_sql('label')},
open as (select p.* from pains p join res r on r.pain_id = p.pain_id where r.label = 'INCONCLUSIVO'),
w as (select unnest(list_distinct({words_sql('dor_especifica')})) term from open),
c as (select term, count(*) n from w where length(term) >= 2 group by 1), k as (select count(*) total from open)
select upper(term) categoria, n, round(n / total + 1e-9, 6) confidence from c, k where total >= 50 and n / total > 0.1 and term not in (select term from top)""")
def emergent_terms(t):
    """New categories from all pains that the lexicon leaves open."""
    open_ = CL.classify(t.pains, "pain_id", "dor_especifica", lexicon(t).select("label", "term"), "x").filter(F.col("x") == K.UNKNOWN)
    return L.emergent_terms(open_, "dor_especifica", lexicon(t), share=0.1, min_chars=2).select(
        "categoria", "n", r6("confidence").alias("confidence")
    )


@query(f"""with {PAINS_SQL}, a as (select * from pains order by pain_id desc limit 100) select pain_id, dor_especifica from a order by pain_id limit 50""")
def recent_sample(t):
    return L.recent_sample(t.pains.select("pain_id", "dor_especifica"), ["pain_id"])


def _toy_model(texts: list[str]) -> list[dict]:
    """Stands for a caller's model: one score per text, failing on texts without a blank."""
    out = []
    for x in texts:
        words = x.split(" ")
        if len(words) < 2:
            raise ValueError("one word")
        out.append({"score": round(1.0 / len(words) + 1e-9, 6), "prompt_tokens": len(words), "completion_tokens": 1})
    return out


TOY_SCHEMA = T.StructType([T.StructField("score", T.DoubleType())])


def _scored(t):
    return MO.score(t.pains, "dor_especifica", _toy_model, TOY_SCHEMA)


MODEL_SQL = """d as (select distinct dor_especifica from pains), m as (select dor_especifica, len(string_split(dor_especifica, ' ')) n from d)"""


@query(f"""with {PAINS_SQL}, {MODEL_SQL} select dor_especifica, case when n > 1 then round(1 / n + 1e-9, 6) end score,
case when n > 1 then n end prompt_tokens, case when n < 2 then 'ValueError: one word' end error from m""")
def model_scoring(t):
    return _scored(t).select("dor_especifica", "score", "prompt_tokens", "error")


@query(f"""with {PAINS_SQL}, {MODEL_SQL} select count(*) calls, sum(n) filter (n > 1)::bigint prompt_tokens, count(*) filter (n > 1) completion_tokens,
(sum(n) filter (n > 1) + count(*) filter (n > 1))::bigint total_tokens, count(*) filter (n < 2) errors from m""")
def model_usage(t):
    return ME.model_usage(_scored(t))
