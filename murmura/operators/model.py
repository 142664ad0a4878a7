"""Extension point: score a text column with a caller's function, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

USAGE = [
    T.StructField("prompt_tokens", T.LongType()),
    T.StructField("completion_tokens", T.LongType()),
    T.StructField("error", T.StringType()),
]


def score(
    texts: DataFrame, text: str, fn: Callable[[list[str]], list[dict]], schema: T.StructType, batch: int = 64
) -> DataFrame:
    """One row per distinct text: the text, the fields of `schema`, token usage and error.

    `fn` gets up to `batch` texts and returns one dict per text. A batch that fails is tried text by
    text, so one bad text costs only its own row; its error is kept in the row.
    """
    fields = schema.fieldNames()
    out = T.StructType([T.StructField(text, T.StringType()), *schema.fields, *USAGE])

    def one_by_one(part: list[str]) -> list[dict]:
        rows = []
        for t in part:
            try:
                rows.append(dict(fn([t])[0]))
            except Exception as e:  # the row carries the error, the job goes on
                rows.append({"error": f"{type(e).__name__}: {e}"})
        return rows

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame[text].tolist()
            for start in range(0, len(values), batch):
                part = values[start : start + batch]
                try:
                    rows = fn(part)
                    if len(rows) != len(part):
                        raise ValueError("one result per text expected")
                except Exception:
                    rows = one_by_one(part)
                data = {text: part}
                for name in [*fields, *[u.name for u in USAGE]]:
                    data[name] = [r.get(name) for r in rows]
                pdf = pd.DataFrame(data)
                for name in ("prompt_tokens", "completion_tokens"):
                    pdf[name] = pdf[name].astype("Int64")
                yield pdf

    distinct = texts.select(text).filter(F.col(text).isNotNull()).distinct()
    return distinct.mapInPandas(run, out)
