"""Engine inputs derived from the given tables, as DataFrames and as the same derivation in SQL.

Every derivation reads whole tables and whole texts: a pain is any sentence of a document (long ones
in pieces); the canonical store is made of the documents labelled as
good, the incoming pains of all others.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura import constants as K
from murmura.functions.text import ascii_only, normalize_text, piece_pattern, sentences

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
# Test files of one row group are one task, however costly the work on their rows; a session that asks
# for it (tests, bench) gets these tables dealt by a key. A cluster reads large files as they are.
SPREAD_CONF = "spark.murmura.spread"
SPREAD = {"documents": "doc_id", "lineitem": "l_orderkey"}
MAIN_GROUP = "Principal"
CHANNEL = "PROMO"


class Tables:
    """The parquet tables of one folder, and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            spread = name in SPREAD and self.spark.conf.get(SPREAD_CONF, "false") == "true"
            return table.repartition(SPREAD[name]) if spread else table
        raise AttributeError(name)

    @cached_property
    def catalog(self) -> DataFrame:
        size, brand, kind = F.col("p_size"), F.col("p_brand"), F.col("p_type")
        return self.part.select(
            F.when(size != 7, kind).alias("nom_familia"),
            F.when(size == 9, "- Item não cadastrado -")
            .when(F.col("p_name") == "red widget", " WhatsApp ").otherwise(F.col("p_name")).alias("nom_produto"),
            brand.alias("des_produto"),
            F.when(size < 40, "Ativo").otherwise("Inativo").alias("nom_status_produto"),
            F.when(brand == "Brand#1", "CAS").when(brand != "Brand#2", "PF").alias("des_publico_alvo"),
            F.when(brand == "Brand#5", "Administrativo").when(brand == "Brand#4", "Outro").otherwise(MAIN_GROUP)
            .alias("nom_agrupamento"),
        )

    @cached_property
    def staging(self) -> DataFrame:
        """Feedback as it arrives: the user turns, with client attributes."""
        turns = self.conversations.filter(F.col("role") == "user")
        clients = self.customer.select(F.col("c_custkey").alias("conv_id"), "c_mktsegment", "c_nationkey")
        conv = F.col("conv_id")
        return turns.join(clients, "conv_id", "left").select(
            F.concat(conv.cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id_feedback"),
            F.col("text").alias("feedback"),
            F.when(conv % 7 == 0, "n/a").otherwise((conv % 11).cast("string")).alias("nota"),
            F.when(F.col("turn") == 0, "2024-01-15").otherwise("2024-01-16 08:30:00").alias("data_feedback"),
            F.when(conv % 3 == 0, "app").when(conv % 3 == 1, "web").otherwise("").alias("origem_feedback"),
            F.col("c_mktsegment").alias("porte_padrao"),
            F.col("c_nationkey").alias("cod_central"),
            conv.cast("string").alias("num_cpf_cnpj"),
        )

    def _sentences(self, documents: DataFrame) -> DataFrame:
        rows = documents.select(
            "doc_id", "lang", "source", "n_chars", F.posexplode(sentences(F.col("text"))).alias("pos", "raw")
        )
        return rows.withColumn("txt", ascii_only(normalize_text(F.col("raw"))))

    @cached_property
    def sentences(self) -> DataFrame:
        return self._sentences(self.documents)

    def _with_context(self, rows: DataFrame) -> DataFrame:
        size = F.length("txt")
        return rows.select(
            "doc_id", "lang", "source", "n_chars", "pos", "raw", "txt",
            F.col("lang").alias("categoria"),
            F.when(F.col("source") == "src0", K.UNKNOWN).otherwise(F.concat(F.lit("f"), (size % 3).cast("string"))).alias("familia"),
            F.when(size % 4 == 0, K.UNKNOWN).otherwise(F.concat(F.lit("p"), (F.col("n_chars") % 2).cast("string"))).alias("produto"),
        )

    @cached_property
    def approved(self) -> DataFrame:
        return self.labels.filter(F.col("quality") == 1).select("doc_id")

    @cached_property
    def pains(self) -> DataFrame:
        """Incoming pains. Toxic documents have low confidence; bad and toxic ones are not valid."""
        # Documents are chosen before they are cut: a join on sentences would cut those of all documents.
        rows = self._with_context(self._sentences(self.documents.join(self.approved, "doc_id", "left_anti")))
        return rows.join(self.labels, "doc_id", "left").select(
            F.concat(F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit("-"), F.lpad(F.col("pos").cast("string"), 6, "0")).alias("pain_id"),
            F.col("doc_id").cast("string").alias("feedback_id"),
            "pos",
            F.col("txt").alias("dor_especifica"),
            "categoria", "familia", "produto",
            F.when(F.col("quality").isNotNull(), (F.col("quality") == 1) | (F.col("toxic") == 0)).alias("is_valid"),
            F.coalesce(0.9 - 0.5 * F.col("toxic"), F.when(F.length("txt") < 20, 0.5).otherwise(1.0)).alias("confidence_score"),
        )

    @cached_property
    def store(self) -> DataFrame:
        """Canonical store rows."""
        rows = self._with_context(self._sentences(self.documents.join(self.approved, "doc_id", "left_semi"))).join(
            self.labels.select("doc_id", "toxic"), "doc_id"
        )
        return rows.select(
            F.concat(F.lit("c"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit("-"), F.lpad(F.col("pos").cast("string"), 6, "0")).alias("id"),
            F.col("txt").alias("canonical_text"),
            "categoria", "familia", "produto",
            F.array(F.col("raw")).alias("variants"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 28).cast("int")).alias("creation_date"),
            (F.col("n_chars") % 30).cast("long").alias("usage_count"),
            F.concat(F.lit("exec_"), "source").alias("created_by_execution"),
            F.concat(F.lit("exec_"), "lang").alias("last_execution_updated"),
            F.lit(1).cast("long").alias("total_executions_used"),
            (0.9 - 0.5 * F.col("toxic")).alias("confidence_score"),
            F.when(F.col("pos") > 0, F.col("pos")).cast("long").alias("version"),
            F.when(F.col("toxic") == 1, False).when(F.col("pos") > 0, True).alias("is_active"),
        )

    @cached_property
    def results(self) -> DataFrame:
        """Result rows: one per order, its line items as pains."""
        item = F.struct(
            F.col("p_name").alias("dor_especifica"),
            F.col("l_returnflag").alias("categoria"),
            F.when(F.col("l_linenumber") == 7, K.UNKNOWN).otherwise(F.col("l_linestatus")).alias("familia"),
            F.col("p_type").alias("produto"),
            F.col("l_partkey").cast("string").alias("canonical_id"),
            F.when(F.col("l_linenumber") % 4 == 3, "created_new").otherwise("merged").alias("normalization_action"),
            F.when(F.col("l_linenumber") % 4 != 3, F.round(1 - F.col("l_discount"), 2)).alias("similarity_score"),
            F.element_at(F.array(*[F.lit(x) for x in ("trio", "pair", "semantic", "new")]), F.col("l_linenumber") % 4 + 1).alias("context_level"),
            F.when(F.col("l_linenumber") != 5, F.round(1 - F.col("l_tax"), 2)).alias("confidence"),
        )
        lists = (
            self.lineitem.join(self.part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("l_orderkey").agg(F.collect_list(item).alias("dores"))
        )
        ok = F.col("o_orderstatus") != "P"
        return self.orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
            F.col("o_orderkey").cast("string").alias("feedback_id"),
            F.concat(F.lit("order "), F.col("o_orderpriority")).alias("feedback"),
            F.when(ok, F.coalesce(F.size("dores"), F.lit(0))).otherwise(0).alias("total_dores_extraidas"),
            F.when(ok, F.coalesce(F.size(F.filter("dores", lambda d: d["familia"] != K.UNKNOWN)), F.lit(0))).otherwise(0).alias("total_dores_normalizadas"),
            F.when(ok, F.to_json("dores")).alias("dores_json"),
            F.when(ok, "success").otherwise("error").alias("status"),
            "o_orderpriority",
        )


# ----- The same derivations in SQL -----

FOLD = f"'{K.ACCENTED}','{K.FOLDED}'"
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"


def norm_sql(x: str) -> str:
    return (
        "regexp_replace(regexp_replace(trim(regexp_replace(translate(lower(" + x + "), " + FOLD + r"), '" + SPACE
        + "', ' ', 'g')), '[.]{2,}', '.', 'g'), '[!]{2,}', '!', 'g')"
    )


def ascii_sql(x: str) -> str:
    return f"regexp_replace({x}, '[^ -~]', '?', 'g')"


def words_sql(x: str) -> str:
    """Normalised words without punctuation."""
    return (
        r"list_filter(string_split(trim(regexp_replace(" + norm_sql(x) + r", '[^\p{L}\p{N}/]+', ' ', 'g')), ' '), "
        "lambda w: w <> '')"
    )


CATALOG_SQL = f"""catalog as (select
  case when p_size <> 7 then p_type end nom_familia,
  case when p_size = 9 then '- Item não cadastrado -' when p_name = 'red widget' then ' WhatsApp ' else p_name end nom_produto,
  p_brand des_produto, case when p_size < 40 then 'Ativo' else 'Inativo' end nom_status_produto,
  case when p_brand = 'Brand#1' then 'CAS' when p_brand <> 'Brand#2' then 'PF' end des_publico_alvo,
  case when p_brand = 'Brand#5' then 'Administrativo' when p_brand = 'Brand#4' then 'Outro' else '{MAIN_GROUP}' end nom_agrupamento
  from part)"""

OFFERED_SQL = CATALOG_SQL + f""", offered as (select * from catalog where nom_status_produto = 'Ativo'
  and nom_familia is not null and des_publico_alvo <> 'CAS'
  and nom_agrupamento <> 'Administrativo' and nom_familia <> 'Administrativo'
  and (nom_agrupamento = '{MAIN_GROUP}' or nom_familia = '{CHANNEL}'))"""

STAGING_SQL = """staging as (select conv_id || '-' || turn id_feedback, text feedback,
  case when conv_id % 7 = 0 then 'n/a' else (conv_id % 11)::varchar end nota,
  case when turn = 0 then '2024-01-15' else '2024-01-16 08:30:00' end data_feedback,
  case conv_id % 3 when 0 then 'app' when 1 then 'web' else '' end origem_feedback,
  c_mktsegment porte_padrao, c_nationkey cod_central, conv_id::varchar num_cpf_cnpj
  from conversations left join customer on c_custkey = conv_id where role = 'user')"""

def pieces_sql(source: str, columns: str) -> str:
    """Query: `columns` and the list `parts` of the pieces of `text`, as functions.text.sentences cuts them."""
    return rf"""select {columns}, case when len(cut) = 0 then [] else list_reduce(list_transform(cut, lambda x: [x]), lambda a, b:
  case when (length(a[-1]) < {K.MIN_PAIN_CHARS} or length(b[1]) < {K.MIN_PAIN_CHARS}) and length(a[-1]) + 1 + length(b[1]) <= {K.MAX_PAIN_CHARS}
  then list_concat(a[:-2], [a[-1] || ' ' || b[1]]) else list_concat(a, b) end) end parts
  from (select *, flatten(list_transform(list_filter(list_transform(regexp_split_to_array(text, '[.!?\n]+'), lambda x: trim(x)), lambda x: x <> ''),
  lambda x: case when length(x) <= {K.MAX_PAIN_CHARS} then [x] else list_transform(regexp_extract_all(x, '{piece_pattern()}'), lambda y: trim(y)) end)) cut
  from {source})"""


SENT_SQL = (
    f"sent0 as ({pieces_sql('documents', '*')})," + r"""
sent1 as (select doc_id, lang, source, n_chars, unnest(parts) raw, generate_subscripts(parts, 1) - 1 pos from sent0),
sent as (select *, """ + ascii_sql(norm_sql("raw")) + """ txt from sent1),
ctx as (select *, lang categoria,
  case when source = 'src0' then 'INCONCLUSIVO' else 'f' || (length(txt) % 3) end familia,
  case when length(txt) % 4 = 0 then 'INCONCLUSIVO' else 'p' || (n_chars % 2) end produto from sent)"""
)

PAINS_SQL = SENT_SQL + """,
pains as (select lpad(c.doc_id::varchar, 9, '0') || '-' || lpad(c.pos::varchar, 6, '0') pain_id, c.doc_id::varchar feedback_id,
  c.pos, txt dor_especifica, categoria, familia, produto,
  case when quality is not null then quality = 1 or toxic = 0 end is_valid,
  coalesce(0.9e0 - 0.5e0 * toxic, case when length(txt) < 20 then 0.5e0 else 1e0 end) confidence_score
  from ctx c left join labels l on l.doc_id = c.doc_id
  where c.doc_id not in (select doc_id from labels where quality = 1))"""

STORE_SQL = """store as (select 'c' || lpad(c.doc_id::varchar, 9, '0') || '-' || lpad(c.pos::varchar, 6, '0') id, txt canonical_text,
  categoria, familia, produto, [raw] variants, date '2024-01-01' + (n_chars % 28)::int creation_date,
  (n_chars % 30)::bigint usage_count, 'exec_' || source created_by_execution, 'exec_' || lang last_execution_updated,
  1::bigint total_executions_used, 0.9e0 - 0.5e0 * toxic confidence_score,
  case when pos > 0 then pos::bigint end "version",
  case when toxic = 1 then false when pos > 0 then true end is_active
  from ctx c join labels l on l.doc_id = c.doc_id where quality = 1)"""

RESULTS_SQL = """items as (select l_orderkey, o_orderpriority, o_orderstatus, p_name dor_especifica, l_returnflag categoria,
  case when l_linenumber = 7 then 'INCONCLUSIVO' else l_linestatus end familia, p_type produto, l_partkey::varchar canonical_id,
  case when l_linenumber % 4 = 3 then 'created_new' else 'merged' end normalization_action,
  case when l_linenumber % 4 <> 3 then round(1 - l_discount, 2) end similarity_score,
  ['trio','pair','semantic','new'][l_linenumber % 4 + 1] context_level,
  case when l_linenumber <> 5 then round(1 - l_tax, 2) end confidence
  from lineitem join part on l_partkey = p_partkey join orders on o_orderkey = l_orderkey),
results as (select o_orderkey::varchar feedback_id, o_orderpriority,
  case when o_orderstatus = 'P' then 0 else coalesce(n, 0) end total_dores_extraidas,
  case when o_orderstatus = 'P' then 0 else coalesce(k, 0) end total_dores_normalizadas,
  case when o_orderstatus = 'P' then 'error' else 'success' end status
  from orders left join (select l_orderkey, count(*) n, count(*) filter (familia <> 'INCONCLUSIVO') k from items group by 1)
  on o_orderkey = l_orderkey)"""


def pair_scores_sql(
    floor: float, on: str = "", left: str = "pains", right: str = "store where coalesce(is_active, true)", text: str = "canonical_text", mark: str = ""
) -> str:
    """All scored pairs (categoria, p, c, s) of distinct texts that reach the floor, by brute force. All pairs
    pass through; none is kept in memory.

    `on`: further columns both sides must share. `left` (dor_especifica) and `right` (`text`): the tables; `mark` goes to the names.
    """
    cols = ", ".join(["categoria", *[x for x in on.split(",") if x]])
    same = " and ".join(f"a.{c.strip()} = b.{c.strip()}" for c in cols.split(","))
    keep = ", ".join(f"a.{c.strip()}" for c in cols.split(","))
    return f"""pt{mark} as (select distinct {cols}, dor_especifica t from {left}),
ct{mark} as (select distinct {cols}, {text} t from {right}),
pw{mark} as (select *, string_split(t, ' ') w, list_distinct(string_split(t, ' ')) d, length(t) l from pt{mark}),
cw{mark} as (select *, string_split(t, ' ') w, list_distinct(string_split(t, ' ')) d, length(t) l from ct{mark}),
j0{mark} as not materialized (select {keep}, a.t p, b.t c, a.w wa, b.w wb, a.d da, b.d db, a.l la, b.l lb,
  case when a.l > b.l then contains(a.t, b.t) else contains(b.t, a.t) end cont
  from pw{mark} a join cw{mark} b on {same}
  where least(a.l, b.l) >= 0.7 * greatest(a.l, b.l)
     or case when a.l > b.l then contains(a.t, b.t) else contains(b.t, a.t) end),
j1{mark} as not materialized (select *, len(list_intersect(da, db)) k, len(da) + len(db) nn from j0{mark}),
j2{mark} as not materialized (select *, k / (nn - k) jac, list_intersect(da, db) cm from j1{mark}
  where 0.3 * k / (nn - k) + 0.2 * cont::int + 0.1 + 0.4 * least(la, lb) / greatest(la, lb) >= {floor} - 1e-6),
pairs{mark} as (select * from (select {cols}, p, c, case when p = c then 1e0 else
  0.4e0 * (1 - levenshtein(p, c) / greatest(la, lb)) + 0.3e0 * jac + 0.2e0 * cont::int
  + 0.1e0 * case when k = 0 then 0 else list_avg(list_transform(cm, lambda x:
    1 - abs((len(wa) - list_position(list_reverse(wa), x)) / len(wa) - (len(wb) - list_position(list_reverse(wb), x)) / len(wb)))) end
  end s from j2{mark}) where s >= {floor} - 1e-9)"""
