"""Result sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from murmura.operators.schema_ops import align
from murmura.schemas import RESULT


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write result rows as parquet under the declared schema."""
    align(df, RESULT).write.mode(mode).parquet(path)
