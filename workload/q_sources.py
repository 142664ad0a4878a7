"""Scans, sinks, store maintenance, catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura import schemas
from murmura.functions import casts
from murmura.operators import classify as CL
from murmura.operators import schema_ops as SO
from murmura.operators import upsert as U
from murmura.session import ensure_checkpoint_dir
from murmura.sources import catalog as CAT
from murmura.sources import feedback as FB
from murmura.sources import results as RES
from murmura.sources import store as ST
from workload.inputs import (
    CATALOG_SQL, CHANNEL, MAIN_GROUP, OFFERED_SQL, PAINS_SQL, RESULTS_SQL, STAGING_SQL, STORE_SQL, Tables,
)
from workload.registry import joined, query, r6


def run_folder(t: Tables, name: str) -> str:
    """A fresh folder for one run, under the shared folder of the session."""
    ensure_checkpoint_dir(t.spark)
    return f"{t.spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query(f"with {OFFERED_SQL} select nom_familia familia, string_agg(distinct nom_produto, '|' order by nom_produto) produtos from offered group by 1")
def catalog_families(t):
    return CAT.families(t.catalog, MAIN_GROUP, CHANNEL).select("familia", joined("produtos").alias("produtos"))


@query(f"""with {OFFERED_SQL} select distinct case when trim(nom_produto) = 'WhatsApp' then 'WhatsApp' else nom_produto end nom_produto,
des_produto, nom_familia from offered where nom_produto <> '- Item não cadastrado -'""")
def catalog_products(t):
    return CAT.products(t.catalog, MAIN_GROUP, CHANNEL)


@query(f"""with {OFFERED_SQL}, p as (select nom_familia, case when trim(nom_produto) = 'WhatsApp' then 'WhatsApp' else nom_produto end prod,
max(des_produto) d from offered where nom_produto <> '- Item não cadastrado -' group by 1, 2)
select nom_familia familia, string_agg(prod || '=' || d, '|' order by prod) descricoes from p group by 1""")
def catalog_map(t):
    entries = F.transform(F.map_entries("descricoes"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return CAT.family_maps(t.catalog, MAIN_GROUP, CHANNEL).select("familia", joined(entries).alias("descricoes"))


@query(f"""with {OFFERED_SQL}, p as (select distinct nom_familia f, nom_produto p from offered),
r as (select *, row_number() over (partition by f order by p) rn, count(*) over (partition by f) n from p)
select f familia, string_agg(p, ', ' order by p) || case when any_value(n) > 8 then ' (+ ' || (any_value(n) - 8) || ' outros)' else '' end resumo
from r where rn <= 8 group by 1""")
def catalog_summary(t):
    return CAT.summary(CAT.family_products(t.catalog, MAIN_GROUP, CHANNEL))


@query(f"""with {STAGING_SQL} select id_feedback feedback_id, feedback feedback_text, try_cast(nota as int) nota, data_feedback,
origem_feedback, porte_padrao segmento, porte_padrao from staging""")
def feedback_scan(t):
    return FB.scan(t.staging).select(
        "feedback_id", "feedback_text", "nota", "data_feedback", "origem_feedback", "segmento", "porte_padrao"
    )


@query("""select o_orderkey,
case when o_orderpriority = '1-URGENT' then try_cast(trim(' ' || (o_orderkey % 100)::varchar || ' ') as int) end nota,
case when o_orderpriority = '1-URGENT' then strftime(o_orderdate, '%Y-%m-%d 10:20:30')
     when o_orderpriority = '2-HIGH' then strftime(o_orderdate, '%Y-%m-%d 00:00:00') end data_feedback,
case when o_orderstatus = 'F' then null else o_orderstatus end origem,
case when o_custkey <> 0 then o_custkey::varchar end cod,
case when o_orderpriority = '2-HIGH' then strftime(o_orderdate, '%Y-%m-%d') else '2024-02-29' end dia from orders""")
def soft_casts(t):
    pri = F.col("o_orderpriority")
    raw = t.orders.select(
        "o_orderkey", "o_custkey",
        F.when(pri == "1-URGENT", F.concat(F.lit(" "), (F.col("o_orderkey") % 100).cast("string"), F.lit(" ")))
        .when(pri == "2-HIGH", "7.9").otherwise("n/a").alias("nota"),
        F.when(pri == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd '10:20:30'"))
        .when(pri == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("quando"),
        F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus")).alias("origem"),
        F.when(pri == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("sem data").alias("dia"),
    )
    return raw.select(
        "o_orderkey",
        casts.soft_int(F.col("nota")).alias("nota"),
        F.date_format(casts.soft_timestamp(F.col("quando")), "yyyy-MM-dd HH:mm:ss").alias("data_feedback"),
        casts.text_or_null(F.col("origem")).alias("origem"),
        casts.number_or_null(F.col("o_custkey")).alias("cod"),
        casts.soft_date(F.col("dia"), F.lit("2024-02-29").cast("date")).cast("string").alias("dia"),
    )


@query(r"""select event_id, case when event_type = 'click' then 'click|' || props when event_type = 'view' then '' else '' end lista,
case when event_type = 'click' then 2 else 0 end::int n from events""")
def safe_json(t):
    kind = F.col("event_type")
    raw = t.events.select(
        "event_id",
        F.when(kind == "click", F.to_json(F.array(kind, "props"))).when(kind == "view", "").when(kind == "error", "[broken").alias("j"),
    )
    return raw.select(
        "event_id", joined(casts.json_strings(F.col("j"))).alias("lista"), F.size(casts.json_strings(F.col("j"))).alias("n")
    )


@query(f"with {PAINS_SQL}, {STORE_SQL} select id, canonical_text, usage_count from store where coalesce(is_active, true)")
def store_active(t):
    return ST.active(t.store).select("id", "canonical_text", "usage_count")


@query(f"""with {PAINS_SQL}, {STORE_SQL} select id, created_by_execution, last_execution_updated from store
where coalesce(is_active, true) and (created_by_execution = 'exec_src3' or last_execution_updated = 'exec_src3')""")
def store_by_execution(t):
    return ST.by_execution(t.store, "exec_src3").select("id", "created_by_execution", "last_execution_updated")


@query(f"with {PAINS_SQL}, {STORE_SQL} select categoria, familia, count(*) n, sum(usage_count)::bigint uses from store group by all")
def store_partitioned_write(t):
    path = run_folder(t, "partitioned")
    ST.write_partitioned(t.store, path)
    return t.spark.read.parquet(path).groupBy("categoria", "familia").agg(
        F.count("*").alias("n"), F.sum("usage_count").alias("uses")
    )


@query(f"with {PAINS_SQL}, {STORE_SQL} select categoria, familia, count(*) n, max(id) last_id from store group by all")
def compact_store(t):
    ragged, tidy = run_folder(t, "ragged"), run_folder(t, "tidy")
    t.store.write.partitionBy("categoria", "familia").parquet(ragged)
    ST.compact(t.spark, ragged, tidy)
    return t.spark.read.parquet(tidy).groupBy("categoria", "familia").agg(
        F.count("*").alias("n"), F.max("id").alias("last_id")
    )


@query(f"""with {PAINS_SQL}, {STORE_SQL} select id, canonical_text, array_to_string(variants, '|') variants, usage_count,
null::varchar improvement_reason, null::boolean has_quality, "version" from store""")
def schema_align(t):
    return SO.align(t.store, schemas.CANONICAL).select(
        "id", "canonical_text", joined("variants").alias("variants"), "usage_count", "improvement_reason",
        F.when(F.col("quality_metrics").isNotNull(), True).alias("has_quality"), "version",
    )


@query(f"""with {PAINS_SQL}, {STORE_SQL} select id, coalesce("version", 1) "version", coalesce(is_active, true) is_active,
0::bigint consolidation_count from store""")
def backfill_defaults(t):
    return SO.backfill(SO.align(t.store)).select("id", "version", "is_active", "consolidation_count")


@query(f"""with {PAINS_SQL}, {STORE_SQL} select pain_id id, dor_especifica canonical_text, null::bigint usage_count, feedback_id from pains
union all select id, canonical_text, usage_count, null from store""")
def append_merge_schema(t):
    new = t.pains.select(F.col("pain_id").alias("id"), F.col("dor_especifica").alias("canonical_text"), "feedback_id")
    return SO.append_merge_schema(t.store.select("id", "canonical_text", "usage_count"), new)


ACCOUNTS_SQL = """tgt as (select c_custkey id, c_name canonical_text, c_mktsegment categoria, 1::bigint usage_count,
  'base' created_by_execution, 3::bigint "version" from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')),
src as (select o_custkey id, 'Customer ' || o_custkey canonical_text, 'atualizado' categoria, count(*) usage_count, 'nova' created_by_execution,
  1::bigint "version" from orders where o_orderstatus = 'O' group by o_custkey)"""


def accounts(t) -> tuple[DataFrame, DataFrame]:
    """Target: customers with a finished order; source: customers with an open one. They overlap."""
    done = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    target = t.customer.join(done, "c_custkey", "left_semi").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("canonical_text"), F.col("c_mktsegment").alias("categoria"),
        F.lit(1).cast("long").alias("usage_count"), F.lit("base").alias("created_by_execution"),
        F.lit(3).cast("long").alias("version"),
    )
    source = t.orders.filter(F.col("o_orderstatus") == "O").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count("*").alias("usage_count")
    ).select(
        "id", F.concat(F.lit("Customer "), F.col("id").cast("string")).alias("canonical_text"),
        F.lit("atualizado").alias("categoria"), "usage_count", F.lit("nova").alias("created_by_execution"),
        F.lit(1).cast("long").alias("version"),
    )
    return target, source


@query(f"""with {ACCOUNTS_SQL} select coalesce(t.id, s.id) id, coalesce(s.canonical_text, t.canonical_text) canonical_text,
coalesce(s.categoria, t.categoria) categoria, coalesce(s.usage_count, t.usage_count) usage_count,
coalesce(t.created_by_execution, s.created_by_execution) created_by_execution,
case when t.id is not null and s.id is not null then t."version" + 1 else coalesce(t."version", s."version") end "version"
from tgt t full join src s on t.id = s.id""")
def upsert_keep_creation(t):
    return U.upsert_keep_creation(*accounts(t))


@query(f"with {ACCOUNTS_SQL} select * from tgt where id not in (select id from src) union all select * from src")
def upsert_replace(t):
    return U.upsert_replace(*accounts(t))


@query(f"with {ACCOUNTS_SQL} select * from tgt where id not in (select id from src)")
def delete_by_keys(t):
    return U.delete_by_keys(*accounts(t))


@query(f"""with {ACCOUNTS_SQL} select coalesce(t.id, s.id) id,
case when t.id is null then 'insert' when s.id is null then 'delete' else 'update' end change from tgt t full join src s on t.id = s.id""")
def snapshot_diff(t):
    return U.snapshot_diff(*accounts(t))


@query(f"with {RESULTS_SQL} select status, count(*) n, sum(total_dores_extraidas)::bigint dores from results group by 1")
def results_sink(t):
    path = run_folder(t, "results")
    RES.write(t.results.withColumns({"execution_id": F.lit("run"), "timestamp_processamento": F.lit("2024-01-01").cast("timestamp")}), path)
    return t.spark.read.parquet(path).groupBy("status").agg(
        F.count("*").alias("n"), F.sum("total_dores_extraidas").alias("dores")
    )


NAMES_SQL = """asked as (select p_partkey, case p_size % 4 when 0 then p_type when 1 then lower(p_type) when 2 then 'nenhuma' else '' end suggested,
  case when p_size > 25 then upper(p_name) else p_name end product from part),
fams as (select distinct nom_familia f from offered),
fam as (select p_partkey, product, case when suggested in (select f from fams) then suggested
  else coalesce((select min(f) from fams where lower(f) = lower(suggested)), 'INCONCLUSIVO') end familia from asked)"""


def asked(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.when(size % 4 == 0, F.col("p_type")).when(size % 4 == 1, F.lower("p_type")).when(size % 4 == 2, "nenhuma").otherwise("").alias("suggested"),
        F.when(size > 25, F.upper("p_name")).otherwise(F.col("p_name")).alias("product"),
    )


@query(f"with {OFFERED_SQL}, {NAMES_SQL} select p_partkey, familia, case when familia = 'INCONCLUSIVO' then 0e0 else 1e0 end familia_confidence from fam")
def lookup_family(t):
    fams = CAT.family_products(t.catalog, MAIN_GROUP, CHANNEL).select("familia").distinct()
    return CL.lookup_family(asked(t), fams).select("p_partkey", "familia", "familia_confidence")


@query(f"""with {OFFERED_SQL}, {NAMES_SQL}, prods as (select distinct nom_familia f, nom_produto p from offered)
select p_partkey, familia, coalesce((select min(p) from prods where f = familia and familia <> 'INCONCLUSIVO' and p = product),
(select min(p) from prods where f = familia and familia <> 'INCONCLUSIVO' and lower(p) = lower(product)), 'INCONCLUSIVO') produto from fam""")
def lookup_product(t):
    rows = CAT.family_products(t.catalog, MAIN_GROUP, CHANNEL)
    known = CL.lookup_family(asked(t), rows.select("familia").distinct())
    return CL.lookup_product(known, rows, "product").select("p_partkey", "familia", "produto")
