import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        T.StructField("text_hash", T.StringType()),
        T.StructField("hits", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("runs", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t), "a", "b", "c", "d") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    """(doc_id, text) of the smallest documents table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.collect()]


ODD = [None, "", " \n\t ", "one", "one two", "é ß 中文 \U0001f600", "x " * 30_000, "same text here", "same text here", "\x00\x0b\x1c|"]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, repeated rows, a null id."""
    return make_docs([*ODD, "tail", "tail"], [*range(len(ODD)), None, None])
