"""URL filters: allow and block rules, and logistic regression on hashed character n-grams.

DataFrame functions only. Features are the character trigrams of host and path (each marked with its part),
hashed into `dims` weights; a row's features are scaled to unit length. Training is accelerated gradient
descent: each step is one aggregation over the labelled rows, and the driver holds the `dims` weights, which
is their size bound. Labelled rows beyond `max_rows` are left out of training (those of the largest hash),
a bounded sample of labelled rows.

Defined cases: null urls and urls without "://" have an empty host and path, no rule, and the verdict of
the bias alone; ties between rules of equal length go to the first; without labelled rows, or with labels
of one kind only, the weights tell that kind (nothing is blocked if there is none); repeated pages are
judged alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import ASCII_LOWER, ASCII_UPPER, written


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


class Model(NamedTuple):
    weights: list[float]
    bias: float
    dims: int


_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _SPLIT, 1), ASCII_UPPER, ASCII_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule (a struct of rule and verdict) that fits the host or a parent of it, and starts the path."""
    out = F.lit(None)
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def features(host: Column, path: Column, dims: int, n: int = 3) -> Column:
    """Distinct hashed n-grams of both parts, their ends marked."""

    def grams(mark: str, part: Column) -> Column:
        text = F.concat(F.lit("^"), part, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - (n - 1)))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))

    both = F.concat(grams("h", host), grams("p", path))
    return F.array_distinct(F.transform(both, lambda g: F.pmod(F.xxhash64(g), F.lit(dims)).cast("int")))


def _margin(idx: Column, weights: list[float], bias: float) -> Column:
    # One text literal, folded to an array once; an array of literals would be thousands of expressions.
    table = F.split(F.lit(" ".join(map(repr, weights))), " ").cast("array<double>")
    total = F.aggregate(idx, F.lit(0.0), lambda a, i: a + F.element_at(table, i + 1))
    return F.lit(bias) + total / F.sqrt(F.greatest(F.size(idx), F.lit(1)))


def train(
    labelled: DataFrame, dims: int = 1 << 12, max_rows: int = 4000, steps: int = 40, rate: float = 4.0, ridge: float = 1e-3
) -> Model:
    """labelled: url string, block boolean (rows with a null in either are left out)."""
    url = F.col("url")
    rows = (
        labelled.select(url, F.col("block").cast("double").alias("y"))
        .dropna()
        .orderBy(F.xxhash64("url", F.lit(7)), "url", "y")
        .limit(max_rows)
        .select("y", features(host_of(url), path_of(url), dims).alias("idx"))
    )
    rows = written(rows)
    total = rows.agg(F.count(F.lit(1)), F.avg("y")).first()
    n, share = total[0], total[1] or 0.0
    w, bias = [0.0] * dims, 0.0
    if not n or share in (0.0, 1.0):
        return Model(w, 1.0 if share == 1.0 else -1.0, dims)
    ahead, ahead_bias = w, bias
    for step in range(steps):
        error = 1 / (1 + F.exp(-_margin(F.col("idx"), ahead, ahead_bias))) - F.col("y")
        size = F.sqrt(F.size("idx"))
        found = (
            rows.select(error.alias("e"), "idx", size.alias("z"))
            .select(F.explode(F.concat(F.array(F.lit(-1)), F.col("idx"))).alias("i"), "e", "z")
            .groupBy("i")
            .agg(F.sum(F.when(F.col("i") < 0, F.col("e")).otherwise(F.col("e") / F.col("z"))).alias("g"))
            .collect()
        )
        grad = {r.i: r.g / n for r in found}
        new_bias = ahead_bias - rate * grad.get(-1, 0.0)
        new = [a * (1 - rate * ridge) - rate * grad.get(i, 0.0) for i, a in enumerate(ahead)]
        speed = step / (step + 3)
        ahead = [b + speed * (b - a) for a, b in zip(w, new)]
        ahead_bias = new_bias + speed * (new_bias - bias)
        w, bias = new, new_bias
    return Model(w, bias, dims)


def probability(host: Column, path: Column, model: Model) -> Column:
    return 1 / (1 + F.exp(-_margin(features(host, path, model.dims), model.weights, model.bias)))


def judge(pages: DataFrame, rules: Sequence[Rule], model: Model) -> DataFrame:
    """page_id, host, path, rule, p_block, verdict: the rule's, else block from a probability of one half on."""
    url = F.col("url")
    return (
        pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
        .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
        .withColumn("p_block", probability(F.col("host"), F.col("path"), model))
        .select(
            "page_id",
            "host",
            "path",
            F.col("_rule")["rule"].alias("rule"),
            "p_block",
            F.coalesce(F.col("_rule")["verdict"], F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        )
    )
