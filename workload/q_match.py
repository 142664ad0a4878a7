"""Matching, canonical maintenance, normalisation, learning, metrics, report, stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmura import constants as K
from murmura.functions import text as X
from murmura.operators import batches as B
from murmura.operators import canonical as C
from murmura.operators import embeddings as E
from murmura.operators import learn as LE
from murmura.operators import match as M
from murmura.operators import metrics as ME
from murmura.operators import vectormatch as VM
from murmura.operators import within as W
from murmura.operators.schema_ops import align
from murmura.plans import normalize as N
from murmura.plans import report as REP
from murmura.plans import results as RES
from murmura.schemas import CANONICAL
from murmura.session import cut_lineage, settled
from murmura.sources.store import active
from murmura.streaming import normalize as ST
from workload.inputs import PAINS_SQL, RESULTS_SQL, STORE_SQL, Tables, pair_scores_sql
from workload.q_sources import run_folder
from workload.registry import joined, query, r6

BASE_SQL = f"{PAINS_SQL}, {STORE_SQL}"
EDIT = {"sequence": "edit"}


def _offers_sql(tiers: tuple[int, ...], on: str = "", least: dict | None = None) -> str:
    """Best accepted canonical per pain, by brute force over all pairs of the block.

    With `least`, the lowest thresholds possible, the thresholds themselves are read from a row `lim`.
    """
    floor = M.score_floor(least or K.INITIAL_THRESHOLDS, tiers)
    cols = ["categoria", *[x for x in on.split(",") if x]]
    side = " and ".join(f"q.{c} = x.{c}" for c in cols)
    arms = []
    for no, name, factor in K.TIERS:
        if no in tiers:
            limit = f"(select {name} from lim)" if least else f"{K.INITIAL_THRESHOLDS[name]}e0"
            same = {1: "x.familia = s.familia and x.produto = s.produto and x.familia <> 'INCONCLUSIVO'",
                    2: "x.familia = s.familia and x.familia <> 'INCONCLUSIVO'", 3: "true"}[no]
            arms.append(
                f"select x.pain_id, {no} tier, '{name}' lvl, least(q.s * s.f * {factor}e0, 1e0) adj, s.creation_date, s.id, s.canonical_text "
                f"from pains x join pairs q on {side} and q.p = x.dor_especifica join fs s on s.categoria = q.categoria and s.canonical_text = q.c "
                f"where {same} and least(q.s * s.f * {factor}e0, 1e0) >= {limit}"
            )
    return f"""{pair_scores_sql(floor, on)},
fs as (select *, (0.8e0 + 0.2e0 * confidence_score) * case when usage_count > 5 then 1.05e0 else 1e0 end f from store where coalesce(is_active, true)),
offers as ({' union all '.join(arms)}),
best as (select * from (select *, row_number() over (partition by pain_id order by tier, adj desc, creation_date, id) rn from offers) where rn = 1)"""


def _match_sql(tiers, on=""):
    return f"""with {BASE_SQL}, {_offers_sql(tiers, on)} select x.pain_id, b.id canonical_id, round(b.adj + 1e-9, 6) similarity_score, b.lvl context_level
from pains x left join best b on b.pain_id = x.pain_id"""


def _matched(t, fn, **options):
    return fn(t.pains, active(t.store), **{**EDIT, **options}).select(
        "pain_id", "canonical_id", r6("similarity_score").alias("similarity_score"), "context_level"
    )


@query(_match_sql((1,), "familia,produto"))
def match_trio(t):
    return _matched(t, M.match_trio)


@query(_match_sql((2,), "familia"))
def match_pair(t):
    return _matched(t, M.match_pair)


@query(_match_sql((3,)))
def match_semantic(t):
    return _matched(t, M.match_semantic)


@query(_match_sql((1, 2, 3)))
def match_cascade(t):
    return _matched(t, M.match_cascade)


@query()
def match_cascade_ratio(t):
    """As match_cascade with the exact character sequence ratio."""
    return _matched(t, M.match_cascade, sequence="ratio")


@query(f"""with {BASE_SQL}, f as (select categoria, canonical_text, id, row_number() over (partition by categoria, canonical_text order by creation_date, id) rn
from store where coalesce(is_active, true)) select pain_id, f.id canonical_id, 1e0 similarity_score, 'identical' "method"
from pains p join f on f.categoria = p.categoria and f.canonical_text = p.dor_especifica and rn = 1""")
def match_identical(t):
    return M.match_identical(t.pains, active(t.store)).select("pain_id", "canonical_id", "similarity_score", "method")


def vector_roles(t):
    """Vectors of even ids as pains, of odd ids as canonicals; texts are shared by some, contexts follow the label."""
    label, vec = F.col("label"), F.col("vec_id")
    rows = t.embeddings.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
        F.concat(F.lit("c"), (label % 2).cast("string")).alias("categoria"),
        F.when(vec % 5 == 4, F.lit(K.UNKNOWN)).otherwise(F.concat(F.lit("f"), label.cast("string"))).alias("familia"),
        F.concat(F.lit("p"), (vec % 3).cast("string")).alias("produto"),
        F.concat(F.lit("texto "), F.when(vec % 7 == 0, F.floor(vec / 14)).otherwise(vec).cast("string")).alias("txt"),
    )
    pains = rows.filter("vec_id % 2 = 0").withColumnRenamed("txt", "dor_especifica")
    canonicals = rows.filter("vec_id % 2 = 1").select(
        F.col("vec_id").cast("string").alias("id"), F.col("txt").alias("canonical_text"), "embedding", "categoria", "familia", "produto",
        F.lit("2024-01-01").cast("date").alias("creation_date"), (0.5 + (vec % 6) / 10.0).alias("confidence_score"), (vec % 9).alias("usage_count"),
    )
    return pains, canonicals


def _vector_sql() -> str:
    arms = []
    for no, name, factor in K.TIERS:
        same = {1: "p.familia = c.familia and p.produto = c.produto and p.familia <> 'INCONCLUSIVO'",
                2: "p.familia = c.familia and p.familia <> 'INCONCLUSIVO'", 3: "true"}[no]
        arms.append(f"select p.vec_id, c.vec_id cid, {no} tier, '{name}' lvl, {K.INITIAL_THRESHOLDS[name]}e0 least_ok, s, p.txt = c.txt same, c.vec_id % 6 q, c.vec_id % 9 u, {factor}e0 tf "
                    f"from pairs where {same}")
    return f"""with e as (select vec_id, embedding::double[] v, 'c' || (label % 2) categoria, case when vec_id % 5 = 4 then 'INCONCLUSIVO' else 'f' || label end familia,
  'p' || (vec_id % 3) produto, 'texto ' || case when vec_id % 7 = 0 then vec_id // 14 else vec_id end txt from embeddings),
pairs as (select p, c, greatest(0e0, least(1e0, (list_cosine_similarity(p.v, c.v) + 1) / 2)) s from e p join e c on p.categoria = c.categoria where p.vec_id % 2 = 0 and c.vec_id % 2 = 1),
offers as ({' union all '.join(arms)}),
adj as (select *, least(1e0, case when same then 1e0 else s end * (0.8e0 + 0.2e0 * (0.5e0 + q / 10e0)) * case when u > 5 then 1.05e0 else 1e0 end * tf
  * case when same then 1e0 when s between 0.6e0 and 0.8e0 then {K.METHOD_FACTORS['embedding_plus_llm']}e0 else {K.METHOD_FACTORS['embeddings_only']}e0 end) a from offers),
best as (select * from (select *, row_number() over (partition by vec_id order by tier, a desc, cid::varchar) rn from adj where a >= least_ok) where rn = 1)
select e.vec_id, b.cid::varchar canonical_id, round(b.a + 1e-9, 6) similarity_score, b.lvl context_level from e left join best b on b.vec_id = e.vec_id where e.vec_id % 2 = 0"""


@query(_vector_sql())
def match_vectors(t):
    """Every vector of a pain with the canonicals of its context, by balls; the SQL compares all pairs."""
    pains, canonicals = vector_roles(t)
    return VM.match_vectors(pains, canonicals).select("vec_id", "canonical_id", r6("similarity_score").alias("similarity_score"), "context_level")


CREATED_SQL = """firsts as (select *, row_number() over (partition by categoria, dor_especifica order by pain_id) rn from pains where confidence_score >= 0.6),
made as (select lower(left(categoria, 4) || '_' || left(familia, 4) || '_' || md5(lower(dor_especifica || chr(31) || categoria || chr(31) || familia))) id,
  pain_id, dor_especifica, categoria, familia, produto, confidence_score from firsts where rn = 1)"""


@query(f"""with {BASE_SQL}, {CREATED_SQL} select id, dor_especifica canonical_text, categoria, familia, produto, confidence_score, 1::bigint usage_count from made""")
def create_canonicals(t):
    made = C.create_canonicals(t.pains, "pain_id", "run1", F.lit("2024-06-01").cast("date"))
    return made.select("id", "canonical_text", "categoria", "familia", "produto", "confidence_score", "usage_count")


def _within_sql(texts: str, made: str) -> str:
    """Accepted pairs of `texts` (categoria, dor_especifica, familia, produto, made_at) with `made`, and the texts that merge, row by row."""
    floor = M.score_floor(K.INITIAL_THRESHOLDS)
    scores = pair_scores_sql(floor, "", texts, made, "dor_especifica", "_in")
    arms = []
    for no, name, factor in K.TIERS:
        same = {1: "x.familia = y.familia and x.produto = y.produto and x.familia <> 'INCONCLUSIVO'",
                2: "x.familia = y.familia and x.familia <> 'INCONCLUSIVO'", 3: "true"}[no]
        adj = f"least(q.s * (0.8e0 + 0.2e0 * y.confidence_score) * {factor}e0, 1e0)"
        arms.append(
            f"select x.categoria, x.dor_especifica node, x.made_at node_at, y.dor_especifica parent, y.made_at par_at, {no} tier, '{name}' lvl, {adj} adj "
            f"from pairs_in q join {texts} x on x.categoria = q.categoria and x.dor_especifica = q.p join {made} y on y.categoria = q.categoria and y.dor_especifica = q.c "
            f"where q.p <> q.c and {same} and {adj} >= {K.INITIAL_THRESHOLDS[name]}e0"
        )
    return f"""{scores}, near as ({' union all '.join(arms)}),
late as (select categoria, node_at, list(distinct par_at) pars, row_number() over (partition by categoria order by node_at) i from near where par_at < node_at group by categoria, node_at),
walk as (select distinct categoria, 0::bigint i, []::varchar[] gone from late union all
  select l.categoria, l.i, case when len(list_filter(l.pars, lambda x: not list_contains(w.gone, x))) > 0 then list_append(w.gone, l.node_at) else w.gone end
  from walk w join late l on l.categoria = w.categoria and l.i = w.i + 1),
gone as (select unnest(gone) made_at from (select categoria, arg_max(gone, i) gone from walk group by 1))"""


@query(f"""with recursive {BASE_SQL}, {CREATED_SQL.replace('pain_id, dor', 'pain_id made_at, dor')}, {_within_sql('made', 'made')}
select categoria, node dor_especifica, parent root, lvl context_level, round(adj + 1e-9, 6) similarity_score from
  (select *, row_number() over (partition by categoria, node order by tier, adj desc, par_at) rn from near
   where par_at < node_at and node_at in (from gone) and par_at not in (from gone)) where rn = 1""")
def batch_merge(t):
    """Where the new texts of a batch go that are similar to an earlier canonical of it, on an empty store."""
    made = settled(C.create_canonicals(t.pains, "pain_id", "run1", F.lit("2024-06-01").cast("date")))
    offered = settled(W.offers(made, made, K.INITIAL_THRESHOLDS))
    return W.targets(offered, W.merged_texts(offered)).select(
        "categoria", F.col(M.NORM).alias("dor_especifica"), "root", "context_level", r6("similarity_score").alias("similarity_score")
    )


USES_SQL = """uses as (select p.pain_id, p.dor_especifica || ' #' || (length(p.dor_especifica) % 7) txt, f.id canonical_id from pains p
  join (select categoria, familia, min(id) id from store group by all) f on f.categoria = p.categoria and f.familia = p.familia)"""


def uses(t):
    """Every pain as a use of the first canonical of its category and family."""
    first = t.store.groupBy("categoria", "familia").agg(F.min("id").alias("canonical_id"))
    text = F.concat("dor_especifica", F.lit(" #"), (F.length("dor_especifica") % 7).cast("string"))
    return t.pains.join(first, ["categoria", "familia"]).select("pain_id", "canonical_id", text.alias("txt"))


@query(f"""with {BASE_SQL}, {USES_SQL}, o as (select canonical_id, txt, min(pain_id) f from uses group by all),
r as (select *, row_number() over (partition by canonical_id order by f desc, txt desc) rn from o)
select canonical_id, string_agg(txt, '|' order by f, txt) variants from r where rn <= 10 group by 1""")
def last_variants(t):
    return C.last_variants(uses(t), "canonical_id", "txt", "pain_id").select("canonical_id", joined("variants").alias("variants"))


@query(f"""with {BASE_SQL}, {USES_SQL}, n as (select canonical_id, count(*) u from uses group by 1),
o as (select canonical_id, txt, min(pain_id) f from uses join store on id = canonical_id where txt <> canonical_text and not list_contains(variants, txt) group by all),
r as (select *, row_number() over (partition by canonical_id order by f desc, txt desc) rn from o),
v as (select canonical_id, list(txt order by f, txt) l from r where rn <= 10 group by 1)
select id, usage_count + u usage_count, coalesce("version", 1) + 1 "version", 2::bigint total_executions_used,
(usage_count + u) // 3 > usage_count // 3 consolidate,
array_to_string(list_concat(variants, coalesce(l, []))[-10:], '|') variants from store join n on id = n.canonical_id left join v on v.canonical_id = id""")
def apply_merges(t):
    merges = uses(t).withColumnRenamed("txt", "dor_especifica")
    out = C.apply_merges(t.store, merges, "run1", "pain_id")
    return out.select("id", "usage_count", "version", F.col("total_executions_used").cast("long").alias("total_executions_used"), "consolidate", joined("variants").alias("variants"))


@query("""with u as (select user_id, event_id, row_number() over (partition by user_id order by event_id) use_no from events)
select user_id, event_id, use_no from u where use_no % 3 = 0""")
def consolidation_trigger(t):
    day = F.to_date("ts")
    out = C.consolidation_trigger(t.events.select("user_id", "event_id", "ts"), "user_id", "event_id", day)
    return out.select("user_id", "event_id", "use_no")


@query("""with h as (select user_id, event_id, event_type, lag(event_type) over (partition by user_id order by event_id) o from events)
select user_id, event_id, o old_text, event_type new_text from h where o <> event_type""")
def improvement_history(t):
    log = t.events.select("user_id", "event_id", "event_type", "ts")
    out = C.improvement_history(log, "user_id", "event_id", "event_type", F.to_date("ts"))
    return out.select("user_id", "event_id", "old_text", "new_text")


#: Ordered pairs of texts that a task compares, and the most tasks.
TASK_PAIRS, MOST_TASKS = 400_000, 20_000


def grouped_store(t):
    """One canonical per document: its first sentence, the others as variants."""
    from murmura.functions.text import ascii_only, normalize_text, sentences

    # The list of one is worked out once; the filter would cut and normalise all texts again below it.
    cut = F.transform(sentences(F.col("text")), lambda s: ascii_only(normalize_text(s)))
    rows = t.documents.select("doc_id", F.explode(F.array(cut)).alias("s"))
    return rows.filter(F.size("s") > 0).select(
        F.col("doc_id").cast("string").alias("id"), F.get("s", F.lit(0)).alias("canonical_text"),
        F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))).alias("variants"),
        F.lit(None).cast("long").alias("consolidation_count"), F.lit(None).cast("string").alias("last_consolidation"),
        F.lit(None).cast("string").alias("improvement_reason"),
    )


@query(f"""with {BASE_SQL}, g as (select doc_id, list(txt order by pos) s from sent group by 1),
e as (select doc_id, s ts from g),
x as (select doc_id, unnest(ts) t, generate_subscripts(ts, 1) i from e),
pw as (select a.doc_id, a.i, a.t a, b.t b, string_split(a.t, ' ') wa, string_split(b.t, ' ') wb from x a join x b on a.doc_id = b.doc_id),
sc as (select *, list_intersect(list_distinct(wa), list_distinct(wb)) cm, len(list_distinct(wa)) + len(list_distinct(wb)) nn from pw),
sm as (select doc_id, i, a, 0.4e0 * (1 - levenshtein(a, b) / greatest(length(a), length(b))) + 0.3e0 * len(cm) / (nn - len(cm))
  + 0.2e0 * case when length(a) > length(b) then contains(a, b) else contains(b, a) end::int
  + 0.1e0 * case when len(cm) = 0 then 0 else list_avg(list_transform(cm, lambda w: 1 - abs((len(wa) - list_position(list_reverse(wa), w)) / len(wa)
    - (len(wb) - list_position(list_reverse(wb), w)) / len(wb)))) end s from sc),
m as (select doc_id, i, any_value(a) a, avg(s) mean_s, round(avg(s), 9) k from sm group by all),
b as (select *, row_number() over (partition by doc_id order by k desc, i) rn from m)
select doc_id::varchar id, round(mean_s + 1e-9, 6) medoid_mean, a medoid from b where rn = 1""")
def consolidate_medoid(t):
    from murmura.functions import similarity as S

    store = settled(grouped_store(t).withColumn("texts", F.concat(F.array("canonical_text"), "variants")))
    # All texts of a document are compared, so tasks follow the number of pairs.
    pairs = store.agg(F.sum(F.size("texts").cast("long") * F.size("texts"))).first()[0] or 0
    store = store.repartition(min(1 + pairs // TASK_PAIRS, MOST_TASKS), "id")
    out = C.consolidate_medoid(store, "run1", F.lit("2024-06-01"), read=None, gate=0.0, mean="mean")
    both = out.select("id", "canonical_text", "mean", "texts").join(store.select("id", F.col("texts").alias("others")), "id")
    # A repeated id meets the texts of its other rows too.
    other = F.aggregate("others", F.lit(0.0), lambda acc, u: acc + S.textual(F.col("canonical_text"), u)) / F.size("others")
    mean = F.when(F.col("texts") == F.col("others"), F.col("mean")).otherwise(other)
    return both.select("id", r6(mean).alias("medoid_mean"), F.col("canonical_text").alias("medoid"))


def _placing_sql(missed: str, no: str = "") -> str:
    """Unmatched pains by text: the first sure one creates, later ones merge."""
    return f"""firsts{no} as (select *, row_number() over (partition by categoria, dor_especifica order by pain_id) rn from {missed} where confidence_score >= 0.6),
made{no} as (select lower(left(categoria, 4) || '_' || left(familia, 4) || '_' || md5(lower(dor_especifica || chr(31) || categoria || chr(31) || familia))) id,
  pain_id made_at, dor_especifica, categoria, familia mf, produto mp, confidence_score, 0.8e0 + 0.2e0 * confidence_score f from firsts{no} where rn = 1),
placed{no} as (select x.pain_id, m.id, m.f, case when x.pain_id = made_at then 'new' when x.pain_id > made_at then
    case when x.familia = mf and mf <> 'INCONCLUSIVO' and x.produto = mp then 'trio' when x.familia = mf and mf <> 'INCONCLUSIVO' then 'pair' else 'semantic' end end lvl
  from {missed} x left join made{no} m on m.categoria = x.categoria and m.dor_especifica = x.dor_especifica)"""


def _normalize_sql() -> str:
    """The batch in SQL: match with the store, then one canonical per unmatched category and text."""
    return f"""{PAINS_SQL.replace('pains as (', 'pains0 as (')}, {STORE_SQL}, pains as (select * from pains0 where coalesce(is_valid, true)),
{_offers_sql((1, 2, 3))},
missed as (select x.* from pains x left join best b on b.pain_id = x.pain_id where b.pain_id is null),
{_placing_sql('missed')},
norm as (select pain_id, id canonical_id, adj similarity_score, lvl context_level, 'merged_with_' || lvl normalization_action from best
  union all select pain_id, case when lvl is not null then id end, case lvl when 'trio' then f when 'pair' then f * 0.95e0 when 'semantic' then f * 0.9e0 end,
  lvl, case when lvl is null then 'rejected' when lvl = 'new' then 'created_new' else 'merged_with_' || lvl end from placed)"""


def batch(t: Tables, **options) -> N.Batch:
    return N.normalize_batch(
        t.pains, align(t.store, CANONICAL), "run1", F.lit("2024-06-01").cast("date"), **{**EDIT, "merge_within": False, **options}
    )


@query(f"with {_normalize_sql()} select pain_id, canonical_id, round(similarity_score + 1e-9, 6) similarity_score, context_level, normalization_action from norm")
def normalize_batch(t):
    return batch(t).normalized.select(
        "pain_id", "canonical_id", r6("similarity_score").alias("similarity_score"), "context_level", "normalization_action"
    )


def _merged_sql() -> str:
    """As `_normalize_sql`, but texts similar to an earlier canonical of the batch merge into it."""
    return f"""{_normalize_sql()},
unsure as (select categoria, dor_especifica, null::varchar made_at, familia, produto from
  (select *, row_number() over (partition by categoria, dor_especifica order by pain_id) rn from missed) m
  where rn = 1 and not exists (select 1 from made where made.categoria = m.categoria and made.dor_especifica = m.dor_especifica)),
texts as (select categoria, dor_especifica, made_at, mf familia, mp produto, confidence_score from made
  union all select categoria, dor_especifica, made_at, familia, produto, null from unsure),
roots as (select categoria, dor_especifica, made_at, mf familia, mp produto, confidence_score, id from made), {_within_sql('texts', 'roots')},
stay as (select * from near where par_at not in (from gone) and (node_at is null or node_at in (from gone))),
found as (select x.pain_id, r.id, s.lvl, s.adj, row_number() over (partition by x.pain_id order by tier, adj desc, par_at) rn
  from missed x join stay s on s.categoria = x.categoria and s.node = x.dor_especifica and s.par_at < x.pain_id
  join roots r on r.categoria = s.categoria and r.dor_especifica = s.parent),
loose as (select distinct x.pain_id from missed x join stay s on s.categoria = x.categoria and s.node = x.dor_especifica),
merged_norm as (select n.pain_id, f.id canonical_id, f.adj similarity_score, f.lvl context_level, coalesce('merged_with_' || f.lvl, 'rejected') normalization_action
  from norm n join loose using (pain_id) left join found f on f.pain_id = n.pain_id and f.rn = 1
  union all select n.* from norm n where pain_id not in (from loose))"""


@query(f"with recursive {_merged_sql()} select pain_id, canonical_id, round(similarity_score + 1e-9, 6) similarity_score, context_level, normalization_action from merged_norm")
def normalize_merged(t):
    """The batch with the store, and with merging among its own new texts."""
    return batch(t, merge_within=True).normalized.select(
        "pain_id", "canonical_id", r6("similarity_score").alias("similarity_score"), "context_level", "normalization_action"
    )


@query(f"with {_normalize_sql()} select normalization_action, case normalization_action when 'created_new' then 'global_pains_created' when 'merged_with_trio' then 'global_duplicates_prevented' when 'rejected' then 'rejected' else 'cross_execution_matches' end counter, count(*) n from norm group by all")
def action_counts(t):
    return ME.action_counts(batch(t).normalized)


STATS_SQL = """stats as (select count(*) total_processed, count(*) filter (context_level = 'new') new_created, count(*) filter (context_level = 'trio') trio_matches,
count(*) filter (context_level = 'pair') pair_matches, count(*) filter (context_level = 'semantic') semantic_matches, avg(coalesce(0.9e0 - 0.5e0 * toxic, 1e0)) avg_quality,
count(*) filter (context_level in ('trio', 'pair')) / count(*) merge_rate, count(*) filter (context_level = 'trio') / count(*) precision_rate
from norm left join labels on labels.doc_id = norm.pain_id[1:9]::bigint where canonical_id is not null)"""


@query(f"with {_normalize_sql()}, {STATS_SQL} select * replace (round(merge_rate + 1e-9, 6) as merge_rate, round(precision_rate + 1e-9, 6) as precision_rate, round(avg_quality + 1e-9, 6) as avg_quality) from stats")
def session_stats(t):
    quality = t.labels.select(F.col("doc_id").cast("string").alias("feedback_id"), (0.9 - 0.5 * F.col("toxic")).alias("overall_quality"))
    rows = batch(t).normalized.join(quality, "feedback_id", "left")
    return LE.session_stats(rows).withColumns({c: r6(c) for c in ("merge_rate", "precision_rate", "avg_quality")})


@query("""with s as (select l_orderkey % 50 k, count(*) n, count(*) filter (l_linenumber % 4 = 0) tr, count(*) filter (l_linenumber % 4 = 1) pa,
avg(1 - l_discount) q from lineitem group by 1), r as (select *, (tr + pa) / n mr from s)
select k, round(case when mr > 0.8 then least(0.85, 0.76) else 0.75 end + 1e-9, 6)::double trio,
round(case when mr < 0.3 then 0.68 when mr > 0.8 then 0.71 else 0.70 end + 1e-9, 6)::double pair,
round(case when mr < 0.3 then 0.63 else 0.65 end + 1e-9, 6)::double semantic,
case when q > 0.9 then 4 when q < 0.7 then 2 else 3 end::int consolidation from r""")
def adapt_thresholds(t):
    """Thresholds after one session per order group, each from the first ones."""
    level = F.element_at(F.array(*[F.lit(x) for x in ("trio", "pair", "semantic", "new")]), F.col("l_linenumber") % 4 + 1)
    rows = t.lineitem.select(
        (F.col("l_orderkey") % 50).alias("k"), F.lit("x").alias("canonical_id"), level.alias("context_level"),
        (1 - F.col("l_discount")).alias("overall_quality"),
    )
    out = LE.adapt_thresholds(LE.initial_thresholds(t.spark), LE.session_stats(rows, "k"), keep=("k",))
    return out.select("k", *[r6(c).alias(c) for c in ("trio", "pair", "semantic")], "consolidation")


@query("""select o_orderkey, ((row_number() over (order by o_orderkey) - 1) // 25)::bigint batch_index from orders""")
def batch_assign(t):
    out = B.batch_assign(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey", F.floor(F.col("o_orderkey") / 4096))
    return out.select("o_orderkey", "batch_index")


@query(f"""with {RESULTS_SQL}, b as (select status, ((row_number() over (order by feedback_id::bigint) - 1) // 50)::bigint batch_index from results)
select batch_index, count(*) n, count(*) filter (status = 'success') sucessos, count(*) filter (status <> 'success') erros from b group by 1""")
def batch_stats(t):
    key = F.col("feedback_id").cast("long")
    rows = B.batch_assign(t.results.withColumn("k", key), "k", F.floor(key / 4096), 50)
    return B.batch_stats(rows)


@query(f"""with {RESULTS_SQL}, g as (select familia, produto, categoria, dor_especifica dor_normalizada, context_level, count(*) qtde_feedbacks,
sum(round(coalesce(similarity_score, 0) * 100)) / count(*) sm, sum(round(coalesce(confidence, 1) * 100)) / count(*) cm,
count(distinct canonical_id) canonical_ids_count, count(distinct l_orderkey) feedbacks_distintos
from items where o_orderstatus <> 'P' and familia <> 'INCONCLUSIVO' group by 1, 2, 3, 4, 5)
select familia, produto, categoria, dor_normalizada, context_level, qtde_feedbacks, round(sm / 100, 3)::double similarity_media,
round(cm / 100, 3)::double confidence_media, canonical_ids_count, feedbacks_distintos from g
order by qtde_feedbacks desc, familia, produto, categoria, dor_normalizada, context_level limit 20""")
def pain_report(t):
    return REP.pain_report(t.results)


@query(f"""with {RESULTS_SQL}, ok as (select * from items where o_orderstatus <> 'P' and familia <> 'INCONCLUSIVO'),
g as (select familia, produto, categoria, dor_especifica, context_level from ok group by all
  order by count(*) desc, familia, produto, categoria, dor_especifica, context_level limit 20)
select ok.familia, ok.produto, ok.categoria, ok.dor_especifica dor_normalizada, ok.context_level, l_orderkey::varchar feedback_id,
left('order ' || o_orderpriority, 100) feedback_preview, normalization_action, round(coalesce(similarity_score, 0), 3) similarity
from ok join g using (familia, produto, categoria, dor_especifica, context_level)""")
def report_examples(t):
    return REP.report_examples(t.results)


@query(f"""with {RESULTS_SQL} select coalesce(sum(total_dores_extraidas), 0)::bigint total_extraidas, coalesce(sum(total_dores_normalizadas), 0)::bigint total_normalizadas,
round(coalesce(avg(total_dores_extraidas), 0) + 1e-9, 6) media_extraidas, round(coalesce(avg(total_dores_normalizadas), 0) + 1e-9, 6) media_normalizadas
from results where status = 'success'""")
def run_totals(t):
    return ME.run_totals(t.results).withColumns({c: r6(c) for c in ("media_extraidas", "media_normalizadas")})


@query(f"""with {RESULTS_SQL} select o_orderpriority, count(*) total, count(*) filter (status = 'success') sucessos,
round(count(*) filter (status = 'success') * 100.0 / count(*) + 1e-9, 6)::double taxa_sucesso from results group by 1""")
def run_quality(t):
    return ME.run_quality(t.results, "o_orderpriority").withColumn("taxa_sucesso", r6("taxa_sucesso"))


@query(f"""with {BASE_SQL} select categoria || '/' || familia context, count(*) n from store where usage_count > 0 group by 1""")
def context_distribution(t):
    return ME.context_distribution(t.store)


@query(f"""with {BASE_SQL} select categoria, familia, count(*) n, round(avg(confidence_score) + 1e-9, 6) avg_confidence, round(avg(usage_count) + 1e-9, 6) avg_usage from store group by all""")
def store_distribution(t):
    return ME.store_distribution(t.store).withColumns({c: r6(c) for c in ("avg_confidence", "avg_usage")})


@query(f"""with {BASE_SQL} select count(*) total_canonical_pains, count(distinct case when usage_count > 0 then categoria || '/' || familia end) total_contexts,
round(avg(case when usage_count >= 10 then confidence_score end) + 1e-9, 6) avg_pain_quality, round(avg(confidence_score) + 1e-9, 6) avg_confidence from store""")
def store_contexts(t):
    c = F.col("confidence_score")
    quality = F.struct(c.alias("semantic_coherence"), c.alias("domain_relevance"), c.alias("overall_quality"))
    rows = t.store.withColumn("quality_metrics", F.when(F.col("usage_count") >= 10, quality))
    return ME.store_contexts(rows).withColumns({c: r6(c) for c in ("avg_pain_quality", "avg_confidence")})


@query()
def store_size(t):
    return ME.store_size(align(t.store, CANONICAL))


@query("""with l as (select user_id, case event_type when 'click' then 'cache_hit' when 'view' then 'embedding_call' when 'error' then 'fallback' else 'save' end op, value >= 5 ok from events),
r as (select user_id, count(*) filter (op = 'cache_hit') h, count(*) filter (op = 'embedding_call') m, count(*) filter (op = 'save') s,
count(*) filter (op = 'save' and not ok) e, count(*) filter (op = 'fallback') f from l group by 1)
select user_id, h + m total_similarity_calculations, round(case when h + m = 0 then 0 else h / (h + m) end + 1e-9, 6) cache_hit_rate,
round((s - e) / greatest(s, 1) + 1e-9, 6) success_rate, round(f / greatest(s, 1) + 1e-9, 6) fallback_rate from r""")
def ops_rates(t):
    kind = F.col("event_type")
    op = F.when(kind == "click", "cache_hit").when(kind == "view", "embedding_call").when(kind == "error", "fallback").otherwise("save")
    log = t.events.select("user_id", op.alias("op"), (F.col("value") >= 5).alias("ok"))
    return ME.ops_rates(log, "user_id").withColumns(
        {c: r6(c) for c in ("cache_hit_rate", "success_rate", "fallback_rate")}
    )


@query("""with r as (select event_type metric, ts::date::varchar run, avg(round(value * 100)) v from events group by all)
select metric, run, round(v + 1e-9, 6) "value", round(avg(v) over (partition by metric order by run) + 1e-9, 6) trend from r""")
def quality_trend(t):
    runs = t.events.groupBy(F.col("event_type").alias("metric"), F.to_date("ts").cast("string").alias("run")).agg(
        F.avg(F.round(F.col("value") * 100)).alias("value")
    )
    return ME.quality_trend(runs).select("metric", "run", r6("value").alias("value"), r6("trend").alias("trend"))


@query(f"""with {BASE_SQL} select distinct dor_especifica text_norm from pains where dor_especifica not in (select canonical_text from store)""")
def embedding_misses(t):
    table = t.store.select(F.col("canonical_text").alias("text_norm"))
    return E.misses(t.pains.select(F.col("dor_especifica").alias("text_norm")), table)


@query("""with a as (select event_id::varchar text_norm, ts embedded_at from events where ts >= timestamp '2024-01-30 12:00:00' - interval 240 hours),
r as (select *, row_number() over (order by embedded_at desc, text_norm desc) rn, count(*) over () n from a)
select text_norm from r where n < 2000 or rn <= 1800""")
def embedding_retention(t):
    table = t.events.select(F.col("event_id").cast("string").alias("text_norm"), F.col("ts").alias("embedded_at"))
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return E.retention(table, now, ttl_hours=240, max_entries=2000).select("text_norm")


@query(f"""with {RESULTS_SQL}, src as (select r.*, o_totalprice > 300000 and r.status = 'success' dummy from results r join orders on o_orderkey::varchar = feedback_id),
l as (select l_orderkey::varchar feedback_id, count(*) n, count(*) filter (context_level <> 'new') m, count(*) filter (context_level = 'new') c from items group by 1)
select s.feedback_id, s.status, case when s.status = 'success' then coalesce(n, 0) else 0 end::int total_dores_extraidas,
case when s.status = 'error' then 'falha na extração' end error_message,
case when s.status = 'success' then '{{"original_count":' || coalesce(n, 0) || ',"normalized_count":' || coalesce(n, 0) || ',"created":' || coalesce(c, 0)
  || ',"merged":' || coalesce(m, 0) || ',"execution_id":"run1"}}' end normalizacao_stats_json,
case when s.status = 'success' then coalesce(n, 0) end::int n_json from src s left join l on l.feedback_id = s.feedback_id""")
def result_rows(t):
    """One row per order; finished orders carry their line items as pains, the others an error."""
    rows = t.results.select("feedback_id", F.col("feedback").alias("feedback_text"), F.when(F.col("status") == "error", "falha na extração").alias("error_message"))
    level = F.element_at(F.array(*[F.lit(x) for x in ("trio", "pair", "semantic", "new")]), F.col("l_linenumber") % 4 + 1)
    items = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("feedback_id"), F.col("l_linenumber").alias("pos"),
        F.col("p_name").alias("dor_especifica"), F.col("l_returnflag").alias("categoria"), F.col("l_linestatus").alias("familia"),
        F.col("p_type").alias("produto"), F.col("l_partkey").cast("string").alias("canonical_id"), level.alias("context_level"),
        F.lit("x").alias("normalization_action"), F.col("l_discount").alias("similarity_score"), F.col("l_tax").alias("confidence"),
    )
    from murmura.schemas import PAIN_LIST

    out = RES.result_rows(rows, RES.pain_lists(items), "run1", F.lit("2024-06-01"))
    return out.select(
        "feedback_id", "status", "total_dores_extraidas", "error_message", "normalizacao_stats_json",
        F.size(F.from_json("dores_json", PAIN_LIST)).alias("n_json"),
    )


LEAST = {"trio": K.INITIAL_THRESHOLDS["trio"], "pair": 0.68 - 1e-9, "semantic": 0.63 - 1e-9}


def _stream_sql() -> str:
    """Pains of even feedback against nothing, then those of odd feedback against what the first led to."""
    return f"""{PAINS_SQL.replace('pains as (', 'pains0 as (')}, ok as (select * from pains0 where coalesce(is_valid, true)),
even as (select * from ok where feedback_id::bigint % 2 = 0), pains as (select * from ok where feedback_id::bigint % 2 = 1),
{_placing_sql('even', '1')},
rate as (select count(*) filter (lvl in ('trio', 'pair')) / count(*) m from placed1 where lvl is not null),
lim as (select case when m > 0.8 then 0.76e0 else 0.75e0 end trio, case when m < 0.3 then 0.7e0 - 0.02e0 when m > 0.8 then 0.7e0 + 0.01e0 else 0.7e0 end pair,
  case when m < 0.3 then 0.65e0 - 0.02e0 else 0.65e0 end semantic from rate),
uses as (select id, count(*) n from placed1 where lvl <> 'new' group by 1),
store as (select m.id, dor_especifica canonical_text, categoria, mf familia, mp produto, date '2024-06-01' creation_date, 1 + coalesce(n, 0) usage_count,
  confidence_score, true is_active from made1 m left join uses u on u.id = m.id),
{_offers_sql((1, 2, 3), least=LEAST)},
missed as (select x.* from pains x left join best b on b.pain_id = x.pain_id where b.pain_id is null),
{_placing_sql('missed')},
placed_all as (select *, 1 "version" from placed1 union all select *, 2 from placed),
norm as (select pain_id, id canonical_id, lvl context_level, 'merged_with_' || lvl normalization_action, 2 "version" from best
  union all select pain_id, case when lvl is not null then id end, lvl,
  case when lvl is null then 'rejected' when lvl = 'new' then 'created_new' else 'merged_with_' || lvl end, "version" from placed_all)"""


@query(f'with {_stream_sql()} select pain_id, canonical_id, context_level, normalization_action, "version"::int "version" from norm')
def stream_normalize(t):
    """The pains as a stream of two micro-batches, by feedback id; each matches, creates and commits."""
    folder = run_folder(t, "stream")
    for rest in (0, 1):
        part = t.pains.filter(F.col("feedback_id").cast("long") % 2 == rest)
        part.write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(t.pains.schema).parquet(f"{folder}/in")
        ST.start(stream, f"{folder}/state", F.lit("2024-06-01").cast("date"), merge_within=False, **EDIT).awaitTermination()
    out = ST.StreamState(t.spark, f"{folder}/state").normalized()
    return out.select("pain_id", "canonical_id", "context_level", "normalization_action", "version")
