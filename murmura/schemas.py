"""Declared schemas, one per table."""

from __future__ import annotations

from pyspark.sql import types as T

PAIN = T.StructType([
    T.StructField("dor_especifica", T.StringType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("familia", T.StringType()),
    T.StructField("produto", T.StringType()),
    T.StructField("canonical_id", T.StringType()),
    T.StructField("normalization_action", T.StringType()),
    T.StructField("similarity_score", T.DoubleType()),
    T.StructField("context_level", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])
PAIN_LIST = T.ArrayType(PAIN)

QUALITY = T.StructType([
    T.StructField("semantic_coherence", T.DoubleType()),
    T.StructField("domain_relevance", T.DoubleType()),
    T.StructField("overall_quality", T.DoubleType()),
])

IMPROVEMENT = T.StructType([
    T.StructField("old_text", T.StringType()),
    T.StructField("new_text", T.StringType()),
    T.StructField("reasoning", T.StringType()),
    T.StructField("execution", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

CANONICAL = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("canonical_text", T.StringType(), False),
    T.StructField("categoria", T.StringType(), False),
    T.StructField("familia", T.StringType(), False),
    T.StructField("produto", T.StringType(), False),
    T.StructField("variants", T.ArrayType(T.StringType())),
    T.StructField("creation_date", T.DateType()),
    T.StructField("usage_count", T.LongType()),
    T.StructField("created_by_execution", T.StringType()),
    T.StructField("last_execution_updated", T.StringType()),
    T.StructField("total_executions_used", T.LongType()),
    T.StructField("confidence_score", T.DoubleType()),
    T.StructField("validation_alerts", T.ArrayType(T.StringType())),
    T.StructField("consolidation_count", T.LongType()),
    T.StructField("last_consolidation", T.StringType()),
    T.StructField("semantic_validation", T.MapType(T.StringType(), T.StringType())),
    T.StructField("improvement_reason", T.StringType()),
    T.StructField("last_updated", T.TimestampType()),
    T.StructField("version", T.LongType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("quality_metrics", QUALITY),
    T.StructField("improvement_history", T.ArrayType(IMPROVEMENT)),
])

# Column defaults of the store, as SQL literals.
CANONICAL_DEFAULTS = {
    "usage_count": "0L",
    "total_executions_used": "1L",
    "confidence_score": "1.0D",
    "consolidation_count": "0L",
    "version": "1L",
    "is_active": "true",
}

CLIENT_COLUMNS = (
    "num_ano_mes", "num_cpf_cnpj", "cod_central", "cod_coop", "porte_padrao", "categoria_cliente",
    "tempo_associacao", "nivel_risco", "cliente_cartao_subutilizado", "cliente_investidor_potencial",
    "cliente_produtos_basicos_subutilizados",
)

RESULT = T.StructType(
    [
        T.StructField("feedback_id", T.StringType(), False),
        T.StructField("feedback", T.StringType()),
        T.StructField("nota", T.IntegerType()),
        T.StructField("data_feedback", T.TimestampType()),
        T.StructField("origem_feedback", T.StringType()),
    ]
    + [T.StructField(c, T.StringType()) for c in CLIENT_COLUMNS]
    + [
        T.StructField("total_dores_extraidas", T.IntegerType()),
        T.StructField("total_dores_normalizadas", T.IntegerType()),
        T.StructField("dores_json", T.StringType()),
        T.StructField("quality_metrics_json", T.StringType()),
        T.StructField("normalizacao_stats_json", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("processing_method", T.StringType()),
        T.StructField("execution_id", T.StringType(), False),
        T.StructField("timestamp_processamento", T.TimestampType(), False),
        T.StructField("error_message", T.StringType()),
    ]
)

TAXONOMY = T.StructType([
    T.StructField("categoria", T.StringType(), False),
    T.StructField("definicao", T.StringType()),
    T.StructField("exemplos", T.ArrayType(T.StringType())),
    T.StructField("confidence", T.DoubleType()),
])

THRESHOLDS = T.StructType([
    T.StructField("trio", T.DoubleType()),
    T.StructField("pair", T.DoubleType()),
    T.StructField("semantic", T.DoubleType()),
    T.StructField("consolidation", T.IntegerType()),
])

LEXICON = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("term", T.StringType()),
])
