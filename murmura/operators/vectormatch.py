"""Match pains to canonicals by their vectors, in the three contexts of `match`, without comparing all pairs.

Canonicals are put into balls: the nearest of a bounded number of pivots (canonicals drawn by hash), the ball's
greatest angle to the pivot, and its greatest factor. A pain's best possible adjusted score in a ball follows from
its angle to the pivot. The search is best first in two steps: every pain looks through its most promising ball; then
it visits only those balls that could still beat the best score so far (or the threshold, if nothing was accepted).
Pains that a narrow tier accepts don't ask the wider ones. No pair that could win is left out, so the results are
those of all pairs.

Balls are compared as products of blocks of vectors. Neighbouring balls of a block share a bin, as many as make a fair
part of its canonicals; pains and bins are cut, and each pair of cuts is a group of its own. A pain travels once for each
cut of the bins it visits, with the list of the balls it asks there, not once for each ball.

Scores: 1 for equal normalised texts, else the cosine mapped to 0..1; the factor of the method is that of a second
opinion inside the band 0.6 to 0.8 (with `band`), of vectors alone elsewhere. A vector of zeros scores 0; pains and
canonicals without a vector take no part (embed them first, `embeddings.with_vectors`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura import constants as K
from murmura.functions import similarity as S
from murmura.operators.match import CONTEXT, NORM, with_context
from murmura.session import cut_lineage

#: Pivots (all categories together), rows of an angle product, and cells of a block product.
PIVOTS, CUT, CELLS = 256, 2048, 1 << 21
#: Rows of a part of a block: at most LARGE, and of smaller blocks some parts of SMALL rows or more, to be many tasks' work.
LARGE, SMALL, SOME = 16384, 1024, 8
#: Angles are widened by this much, so that rounding never hides a ball.
SLACK = 1e-7


def _unit(rows: DataFrame, vector: str) -> DataFrame:
    """`unit`: the vector at length one; none for zeros."""
    # The list of one is worked out once; in the lambda below it would be for each element.
    length = F.explode(F.array(S.norm(F.col(vector))))
    rows = rows.filter(F.col(vector).isNotNull()).withColumn("__length", length)
    unit = F.transform(vector, lambda x: x.cast("double") / F.col("__length"))
    return rows.withColumn("unit", F.when(F.col("__length") > 0, unit)).filter("unit IS NOT NULL").drop("__length")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def pivots(canonicals: DataFrame, many: int = PIVOTS) -> np.ndarray:
    """At most `many` of the canonicals' unit vectors."""
    found = canonicals.select(F.xxhash64("id").alias("h"), "id", "unit").orderBy("h", "id").limit(many).select("unit").collect()
    return np.array([r.unit for r in found])


def _angles(rows: DataFrame, pivot: np.ndarray, nearest: bool) -> DataFrame:
    """rows with the nearest pivot and its angle (`ball`, `angle`), or with the angles to all pivots (`angles`)."""
    added = [T.StructField("ball", T.IntegerType()), T.StructField("angle", T.DoubleType())]
    added = added if nearest else [T.StructField("angles", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*rows.schema.fields, *added])
    sent = rows.sparkSession.sparkContext.broadcast(pivot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CUT):
                batch = whole.slice(at, CUT)
                angle = np.arccos(np.clip(_matrix(batch.column("unit")) @ sent.value.T, -1, 1))
                if nearest:
                    ball = angle.argmin(axis=1)
                    more = [pa.array(ball, pa.int32()), pa.array(angle[np.arange(len(ball)), ball])]
                else:
                    more = [pa.array(list(angle), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    return rows.mapInArrow(run, schema)


def _method_factors(band: bool) -> tuple[float, float]:
    """Of scores in the band and outside it."""
    alone = K.METHOD_FACTORS["embeddings_only"]
    return (K.METHOD_FACTORS["embedding_plus_llm"] if band else alone), alone


def _bounds(asks: DataFrame, balls: DataFrame, tier_factor: float, band: bool) -> DataFrame:
    """Per pain the balls of its block with the best adjusted score they can hold: key, block, vector, visits (ball, bound, bin).

    Also `cut_v`, its part of the pains of its block. `balls`: `_binned`.
    """
    # One for each pivot at most.
    listed = balls.groupBy("block").agg(F.collect_list(F.struct("ball", "radius", "factor", "bin", "cuts")).alias("balls"), F.first("parts").alias("parts"))
    inside, alone = _method_factors(band)

    def bound(b: Column, angles: Column) -> Column:
        least = F.greatest(F.get(angles, b["ball"]) - b["radius"] - SLACK, F.lit(0.0))
        score = (F.cos(least) + 1) / 2
        # A lower score inside the band can be worth more than a higher one above it.
        best = F.when(score < 0.6, score * alone).otherwise(F.greatest(score * alone, F.least(score, F.lit(0.8)) * inside))
        return F.struct((best * b["factor"] * tier_factor + 1e-9).alias("bound"), b["ball"].alias("ball"), b["bin"].alias("bin"), b["cuts"].alias("cuts"))

    joined = asks.join(listed, "block").withColumn("visits", F.transform("balls", lambda b: bound(b, F.col("angles"))))
    return joined.withColumn("cut_v", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).drop("balls", "angles", "parts")


def _parts(rows: Column) -> Column:
    """Parts that so many rows are cut into."""
    return F.greatest(F.ceil(rows / LARGE), F.least(F.lit(SOME), F.ceil(rows / SMALL))).cast("int")


def _binned(inside: DataFrame, asked: DataFrame) -> DataFrame:
    """The balls of each block: radius, factor, bin, `cuts` of the bin, and the `parts` of the pains that ask in the block."""
    balls = inside.groupBy("block", "ball").agg(F.max("angle").alias("radius"), F.max("factor").alias("factor"), F.count(F.lit(1)).alias("n"))
    block = Window.partitionBy("block")  # one row for each pivot at most
    before = F.sum("n").over(block.orderBy("ball")) - F.col("n")
    placed = balls.withColumn("part", F.ceil(F.sum("n").over(block) / _parts(F.sum("n").over(block)))).withColumn("bin", F.floor(before / F.col("part")).cast("int"))
    # Small balls fill a bin to twice a part at most; a ball that is larger is cut.
    cuts = F.ceil(F.sum("n").over(Window.partitionBy("block", "bin")) / (2 * F.col("part"))).cast("int")
    parts = asked.groupBy("block").agg(_parts(F.count(F.lit(1))).alias("parts"))
    return placed.withColumn("cuts", cuts).drop("n", "part").join(parts, "block")


def _compare(visits: DataFrame, members: DataFrame, tier_factor: float, threshold: float, band: bool) -> DataFrame:
    """visits: key, block, cut_v, chosen (of `visits`), text_hash, unit. Per key the best accepted offer (rank, creation_date, id), and `pairs` compared."""
    to = F.explode(F.array_distinct(F.transform("chosen", lambda v: F.struct(v["bin"].alias("bin"), v["cuts"].alias("cuts"))))).alias("to")
    left = visits.select("key", "block", "cut_v", "text_hash", "unit", "chosen", to).select(
        "key", "block", "cut_v", "text_hash", "unit", F.col("to.bin").alias("bin"),
        F.transform(F.filter("chosen", lambda v: v["bin"] == F.col("to.bin")), lambda v: v["ball"]).alias("balls"),
        F.explode(F.sequence(F.lit(0), F.col("to.cuts") - 1)).alias("cut_m"),
    )
    right = members.withColumn("cut_m", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")).withColumn(
        "cut_v", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).drop("cuts", "parts")
    schema = T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("rank", T.DoubleType()), T.StructField("creation_date", T.DateType()),
         T.StructField("id", T.StringType()), T.StructField("pairs", T.LongType())]
    )
    inside, alone = _method_factors(band)

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in schema})
        b = b.sort_values(["creation_date", "id"], ignore_index=True)
        left, right = np.stack(a["unit"]), np.stack(b["unit"])
        a_text, b_text, factor = a["text_hash"].to_numpy(), b["text_hash"].to_numpy(), b["factor"].to_numpy()
        asked = a["balls"].to_numpy()
        who = np.repeat(np.arange(len(a)), [len(x) for x in asked])
        where = np.concatenate(asked)
        order = np.argsort(where, kind="stable")
        who, where = who[order], where[order]
        top, best, pairs = np.full(len(a), -1.0), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        for ball, held in b.groupby("ball").indices.items():
            guests = who[np.searchsorted(where, ball, "left") : np.searchsorted(where, ball, "right")]
            pairs[guests] += len(held)
            step = max(1, CELLS // len(held))
            for at in range(0, len(guests), step):
                some = guests[at : at + step]
                score = np.clip((left[some] @ right[held].T + 1) / 2, 0, 1)
                by_method = np.where((score >= 0.6) & (score <= 0.8), inside, alone)
                adjusted = np.minimum(score * factor[held] * tier_factor * by_method, 1.0)
                adjusted[a_text[some][:, None] == b_text[held][None, :]] = 0  # equal texts are joined, whatever their vectors
                first = adjusted.argmax(axis=1)  # the first created of equal ones
                value, place = adjusted[np.arange(len(some)), first], held[first]
                better = (value > top[some]) | ((value == top[some]) & (place < best[some]))
                top[some[better]], best[some[better]] = value[better], place[better]
        ok = top >= threshold
        return pd.DataFrame(
            {
                "key": a["key"].to_numpy(),
                "rank": np.where(ok, -top, np.nan),
                "creation_date": b["creation_date"].to_numpy()[best],
                "id": np.where(ok, b["id"].to_numpy()[best], None),
                "pairs": pairs,
            }
        )

    group = ["block", "bin", "cut_v", "cut_m"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(run, schema)


def _best(offers: DataFrame) -> DataFrame:
    """key, best offer (null if none was accepted), pairs compared for it."""
    offer = F.when(F.col("id").isNotNull(), F.struct("rank", "creation_date", "id"))
    return offers.groupBy("key").agg(F.min(offer).alias("best"), F.sum("pairs").alias("pairs"))


def _identical(asked: DataFrame, members: DataFrame, tier_factor: float, threshold: float) -> DataFrame:
    """As `_best`, for canonicals whose text is that of the pain: their score is 1."""
    adjusted = F.least(F.col("factor") * tier_factor, F.lit(1.0))
    offer = F.struct((-adjusted).alias("rank"), "creation_date", "id")
    best = members.filter(adjusted >= threshold).groupBy("block", NORM).agg(F.min(offer).alias("best"))
    return asked.select("key", "block", NORM).join(best, ["block", NORM]).select("key", "best", F.lit(0).cast("long").alias("pairs"))


def match_vectors(
    pains: DataFrame,
    canonicals: DataFrame,
    vector: str = "embedding",
    thresholds: dict | None = None,
    tiers: tuple[int, ...] = (1, 2, 3),
    band: bool = True,
    text: str = "dor_especifica",
    popular_tiers: bool = False,
    many: int = PIVOTS,
) -> DataFrame:
    """All pains with canonical_id, similarity_score, context_level (NULL where none matched) and pairs compared.

    Copies of a pain's context, text and vector are compared once.
    """
    thresholds = thresholds or K.INITIAL_THRESHOLDS
    p = with_context(pains, text).withColumn("__key", F.xxhash64(*CONTEXT, NORM, vector))
    asks = _unit(p, vector).groupBy(F.col("__key").alias("key")).agg(*[F.first(c).alias(c) for c in (*CONTEXT, NORM, "unit")])
    factor = S.canonical_factor(F.col("confidence_score"), F.col("usage_count"), popular_tiers)
    stored = _unit(with_context(canonicals, "canonical_text"), vector).select("id", "creation_date", *CONTEXT, NORM, "unit", factor.alias("factor"))
    stored = cut_lineage(stored)
    none = p.select("*", *[F.lit(None).cast(t).alias(n) for n, t in (("canonical_id", "string"), ("similarity_score", "double"), ("context_level", "string"))], F.lit(0).cast("long").alias("pairs"))
    pivot = pivots(stored, many)
    if not len(pivot):
        return none.select(*pains.columns, "canonical_id", "similarity_score", "context_level", "pairs")
    hashed = F.xxhash64(NORM).alias("text_hash")
    members = cut_lineage(_angles(stored.select("id", "creation_date", *CONTEXT, NORM, "factor", hashed, "unit"), pivot, True))
    waiting = cut_lineage(_angles(asks.select("key", *CONTEXT, NORM, hashed, "unit"), pivot, False))
    answers = None
    for no, name, tier_factor in K.TIERS:
        if no not in tiers:
            continue
        block = F.concat_ws("\u001f", *CONTEXT[: 4 - no]).alias("block")
        known = (lambda rows: rows.filter(F.col("familia") != K.UNKNOWN)) if no <= 2 else (lambda rows: rows)
        inside = known(members).select(block, "ball", "id", "creation_date", "factor", NORM, "text_hash", "unit", "angle")
        asked = known(waiting).select("key", block, NORM, "text_hash", "unit", "angles")
        identical = _identical(asked, inside, tier_factor, thresholds[name])
        inside, asked = inside.drop(NORM), asked.drop(NORM)
        balls = cut_lineage(_binned(inside, asked))
        places = balls.select("block", "ball", "bin", "cuts", "parts")
        inside = inside.drop("angle").join(places, ["block", "ball"])
        bounds = cut_lineage(_bounds(asked, balls, tier_factor, band).filter(F.exists("visits", lambda v: v["bound"] >= thresholds[name])))
        first = bounds.withColumn("v", F.array_max("visits"))
        row = ["key", "block", "cut_v", "text_hash", "unit"]
        step = first.select(*row, F.array("v").alias("chosen"))
        found = cut_lineage(_best(_compare(step, inside, tier_factor, thresholds[name], band)))
        # What may still hold an equal or better one than the best so far.
        floor = F.greatest(F.coalesce(-F.col("best.rank"), F.lit(0.0)), F.lit(float(thresholds[name])))
        later = first.join(found.select("key", "best"), "key").select(
            *row, F.filter("visits", lambda v: (v["bound"] >= floor) & (v["ball"] != F.col("v.ball"))).alias("chosen")
        )
        more = _best(_compare(later, inside, tier_factor, thresholds[name], band))
        both = found.unionByName(more).unionByName(identical).groupBy("key").agg(F.min("best").alias("best"), F.sum("pairs").alias("pairs"))
        both = cut_lineage(both.withColumn("tier", F.lit(no)).withColumn("level", F.lit(name)))
        waiting = waiting.join(both.filter("best IS NOT NULL").select("key"), "key", "left_anti")
        answers = both if answers is None else answers.unionByName(both)
    offer = F.when(F.col("best").isNotNull(), F.struct("tier", "best", "level"))
    answer = answers.groupBy(F.col("key").alias("__key")).agg(F.min(offer).alias("a"), F.sum("pairs").alias("pairs"))
    return p.join(answer, "__key", "left").select(
        *pains.columns,
        F.col("a.best.id").alias("canonical_id"),
        (-F.col("a.best.rank")).alias("similarity_score"),
        F.col("a.level").alias("context_level"),
        F.coalesce("pairs", F.lit(0).cast("long")).alias("pairs"),
    )
