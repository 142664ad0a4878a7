"""Registry of the queries: a name, a function of the tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.inputs import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        name = fn.__name__
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def r6(c: str | Column) -> Column:
    """Six places; the small shift settles exact ties the same way in both engines."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 6)


def joined(c: str | Column, sep: str = "|") -> Column:
    return F.array_join(c, sep)
