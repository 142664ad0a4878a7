"""Product catalogue: families, products, default catalogue, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmura import constants as K

PLACEHOLDER = "- Item não cadastrado -"
ADMIN = "Administrativo"


def _offered(df: DataFrame) -> DataFrame:
    """Active, public, not administrative. Comparisons with NULL drop the row."""
    return df.filter(
        (F.col("nom_status_produto") == "Ativo")
        & F.col("nom_familia").isNotNull()
        & (F.col("des_publico_alvo") != "CAS")
        & (F.col("nom_agrupamento") != ADMIN)
        & (F.col("nom_familia") != ADMIN)
    )


def products(df: DataFrame, main_group: str, channel_family: str = "Canais") -> DataFrame:
    """Distinct products of the main group and of the channel family; one product name is trimmed."""
    offered = _offered(df).filter(F.col("nom_produto") != PLACEHOLDER)
    cols = ["nom_produto", "des_produto", "nom_familia"]
    rows = (
        offered.filter(F.col("nom_agrupamento") == main_group).select(*cols)
        .union(offered.filter(F.col("nom_familia") == channel_family).select(*cols))
        .distinct()
    )
    name = F.col("nom_produto")
    return rows.withColumn("nom_produto", F.when(F.trim(name) == "WhatsApp", "WhatsApp").otherwise(name))


def family_products(df: DataFrame, main_group: str, channel_family: str = "Canais") -> DataFrame:
    """Distinct (familia, produto) rows of both branches."""
    offered = _offered(df)
    cols = [F.col("nom_familia").alias("familia"), F.col("nom_produto").alias("produto")]
    return (
        offered.filter(F.col("nom_agrupamento") == main_group).select(*cols)
        .union(offered.filter(F.col("nom_familia") == channel_family).select(*cols))
        .distinct()
    )


def families(df: DataFrame, main_group: str, channel_family: str = "Canais") -> DataFrame:
    """One row per family with its sorted list of distinct product names.

    Rows are made distinct before they are listed, so a list is as long as the family's catalogue.
    """
    return (
        family_products(df, main_group, channel_family)
        .groupBy("familia")
        .agg(F.array_sort(F.collect_list("produto")).alias("produtos"))
    )


def family_maps(df: DataFrame, main_group: str, channel_family: str = "Canais") -> DataFrame:
    """Family and a map product -> description; of several descriptions the last in order."""
    one = (
        products(df, main_group, channel_family)
        .groupBy("nom_familia", "nom_produto")
        .agg(F.max("des_produto").alias("des_produto"))
    )
    return one.groupBy(F.col("nom_familia").alias("familia")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("nom_produto", "des_produto")))).alias("descricoes")
    )


def summary(rows: DataFrame, top: int = 8) -> DataFrame:
    """Per family its first product names and how many others there are. `rows`: (familia, produto)."""
    # The window keeps `top` rows per family before the shuffle, so no list outgrows that.
    w = Window.partitionBy("familia").orderBy("produto")
    first = rows.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= top)
    lists = first.groupBy("familia").agg(F.array_sort(F.collect_list("produto")).alias("first"))
    sizes = rows.groupBy("familia").agg(F.count("produto").alias("n"))
    text = F.array_join("first", ", ")
    rest = F.concat(F.lit(" (+ "), (F.col("n") - top).cast("string"), F.lit(" outros)"))
    return sizes.join(lists, "familia").select(
        "familia", F.when(F.col("n") > top, F.concat(text, rest)).otherwise(text).alias("resumo")
    )


def family_context(rows: DataFrame, contexts: DataFrame, default: str) -> DataFrame:
    """Families with their context text, or the default. `contexts`: (familia, contexto), one per family."""
    return rows.select("familia").distinct().join(contexts, "familia", "left").withColumn(
        "contexto", F.coalesce("contexto", F.lit(default))
    )


def default_catalog(spark: SparkSession) -> DataFrame:
    """Catalogue to use when the catalogue table cannot be read."""
    return spark.createDataFrame(list(K.DEFAULT_CATALOG.items()), "familia string, produtos array<string>")
