"""Feedback scan: rename, cast, optional columns, row cap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.functions.casts import soft_int
from murmura.operators.schema_ops import require_columns
from murmura.schemas import CLIENT_COLUMNS


def scan(df: DataFrame, limit: int | None = None, hash_tax_id_with: str | None = None) -> DataFrame:
    """Staging rows under their engine names; columns the source lacks are NULL.

    `limit` keeps the first rows by id, so the cap is repeatable. `hash_tax_id_with` replaces the tax
    id by a salted hash.
    """
    named = df
    for old, new in (("id_feedback", "feedback_id"), ("feedback", "feedback_text")):
        if old in named.columns and new not in named.columns:
            named = named.withColumnRenamed(old, new)
    require_columns(named)

    def optional(name: str):
        return F.col(name) if name in named.columns else F.lit(None).cast("string")

    tax_id = optional("num_cpf_cnpj")
    if hash_tax_id_with is not None:
        tax_id = F.sha2(F.concat(F.lit(hash_tax_id_with), tax_id.cast("string")), 256)
    out = named.select(
        F.col("feedback_id").cast("string").alias("feedback_id"),
        F.col("feedback_text").cast("string").alias("feedback_text"),
        soft_int(optional("nota")).alias("nota"),
        optional("data_feedback").alias("data_feedback"),
        optional("origem_feedback").alias("origem_feedback"),
        optional("porte_padrao").alias("segmento"),
        *[(tax_id if c == "num_cpf_cnpj" else optional(c)).alias(c) for c in CLIENT_COLUMNS],
    )
    return out if limit is None else out.orderBy("feedback_id").limit(limit)
