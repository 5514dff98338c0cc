"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words; its documents get a target number of copies (the
target over the source's size). The whole part of it is certain. For the rest each document has
an inclusion probability p in proportion to its size, capped at 1, so that p times size sums to
the remaining words. Certain documents come first, the others by random odds over inclusion odds,
(u / (1 - u)) / (p / (1 - p)); along that order every document that fits into what is left is
taken. At the end none that is left out fits; the smallest of them is taken as well if that
brings the source closer to its target.

u is a hash of the row (its id, source and text with a seed): reruns and other partitionings
agree, and a document's copies follow from its own row and one small row per source. Nothing
sorts a source as a whole: words are summed by source and bin of the odds, a running sum over the
bins finds the bin where a document does not fit, and only that bin's documents are ranked one by
one. The next round goes on behind it with the documents that still fit; what is left at least
halves with the typical round, so a few rounds end it.

Defined results: a null or empty text has size 0. A null source is a source, ordered last.
Equal rows share their u and are taken together or not at all. Empty tables give empty results; a source
without words has target 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import WORD, driver_rows, stored, table, unused

WEIGHTS, SHARE, MOST, SEED = (3.0, 1.0, 2.0), 1.5, 2.0, 20240
BIN_ROWS = 4096  # documents of a bin, about
FINE = 1 << 56   # steps of the rank per unit of the logarithm of the odds
FIRST, LAST = -(1 << 63), (1 << 63) - 1
_SOURCES = T.StructType([T.StructField(n, t) for n, t in (
    ("source", T.StringType()), ("source_size", T.LongType()), ("target", T.DoubleType()),
    ("whole", T.IntegerType()), ("left", T.DoubleType()), ("scale", T.DoubleType()),
    ("parts", T.ArrayType(T.StructType([T.StructField("after", T.LongType()), T.StructField("until", T.LongType()),
                                        T.StructField("most", T.DoubleType())]))),
    ("extra", T.LongType()))])
_NEAR = "s string, after long, deficit double"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> Column:
    """The row's random number as a long; u is its place in the range of longs."""
    return F.xxhash64(F.lit(seed), docs[doc_id], docs[source], docs[text])


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = MOST) -> list[float]:
    """``total`` shared by weight; a target stops at ``most`` times its size, the excess is reshared."""
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    left, weight, out = float(total), math.fsum(weights), [0.0] * len(sizes)
    for k, i in enumerate(order):
        if left * weights[i] / weight < most * sizes[i]:
            for j in order[k:]:
                out[j] = left * weights[j] / weight
            break
        out[i] = float(most * sizes[i])
        left -= out[i]
        weight = math.fsum(weights[j] for j in order[k + 1:])
    return out


def rank(draw_column: Column, size: Column, scale: Column) -> Column:
    """Place of a document in its source's order: the logarithm of its random odds over its inclusion odds."""
    p = scale * F.greatest(size, F.lit(1))
    u = (F.shiftright(draw_column, 12) + 0.5) / float(1 << 52) + 0.5
    odds = F.log(u / (1.0 - u)) - F.log(p / (1.0 - p))
    return F.when(p >= 1.0, F.lit(FIRST + 1)).otherwise(
        F.floor(F.greatest(F.lit(-100.0), F.least(F.lit(100.0), odds)) * float(FINE)).cast("long"))


def scales(rows: DataFrame, sizes: dict, left: dict) -> dict:
    """Inclusion probability per word of each source, so that probability times size sums to ``left``.

    Documents of probability 1 are set apart until the others' stay below it.
    """
    spark, bound, out = rows.sparkSession, {s: float(LAST) for s, x in left.items() if x > 0}, {}
    square = F.col("size").cast("decimal(19,0)") * F.col("size").cast("decimal(19,0)")
    while bound:
        near = driver_rows(spark, list(bound.items()), "s string, bound double")
        found = (rows.join(F.broadcast(near), F.col("source").eqNullSafe(F.col("s"))).where("size < bound")
                 .groupBy("source").agg(F.sum("size").alias("size"), F.sum(square).alias("square"),
                                        F.max("size").alias("most")).collect())
        again = {}
        for r in found:
            rest = left[r["source"]] - (sizes[r["source"]] - r["size"])
            scale = rest / float(r["square"]) if r["square"] and rest > 0 else 0.0
            out[r["source"]] = max(scale, 1e-18)
            if scale * r["most"] >= 1 and 1 / scale < bound[r["source"]]:
                again[r["source"]] = 1 / scale
        bound = again
    return out


def allocation(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
               ) -> DataFrame:
    """One row per source with its target and which ranks and sizes it takes.

    ``rows``: source, size and draw of each document (stored: it is read several times).
    Only one row per source passes through the driver.
    """
    spark = rows.sparkSession
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["size"] for r in found]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share * sum(sizes), most)
    whole = {r["source"]: int(aim // r["size"]) if r["size"] else 0 for r, aim in zip(found, aims)}
    left = {r["source"]: aim - whole[r["source"]] * r["size"] for r, aim in zip(found, aims)}
    scale = scales(rows, {r["source"]: r["size"] for r in found}, left)
    parts = {s: [] for s in left}
    deficit, after = dict(left), {s: FIRST for s in left}
    # At most a fourth of a source's documents have a rank within one unit of the logarithm.
    width = max(1, min(FINE, 4 * FINE * BIN_ROWS // max(1, sum(r["n"] for r in found))))
    chosen = driver_rows(spark, [(s, scale.get(s, 1e-18)) for s in left], "s string, scale double")
    ranked = (rows.join(F.broadcast(chosen), F.col("source").eqNullSafe(F.col("s"))).drop("s")
              .withColumn("rank", rank(F.col("draw"), F.col("size"), F.col("scale")))
              .withColumn("b", F.floor(F.col("rank") / F.lit(width))))
    open_ = [s for s in left if deficit[s] >= 1]
    while open_:
        near = driver_rows(spark, [(s, after[s], deficit[s]) for s in open_], _NEAR)
        fits = (ranked.join(F.broadcast(near), F.col("source").eqNullSafe(F.col("s")))
                .where("rank > after and size <= deficit and size > 0").drop("s"))
        by_bin = fits.groupBy("source", "b").agg(F.sum("size").alias("size"), F.first("deficit").alias("deficit"))
        by_bin = by_bin.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("b")))
        over = F.col("upto") > F.col("deficit")
        cross = {r["source"]: r for r in by_bin.groupBy("source").agg(
            F.sum("size").alias("all"), F.min(F.when(over, F.col("b"))).alias("bin"),
            F.min(F.when(over, F.col("upto") - F.col("size"))).alias("before")).collect()}
        bins = [(s, r["bin"], r["before"]) for s, r in cross.items() if r["bin"] is not None]
        ends = {}
        if bins:
            places = driver_rows(spark, bins, "s string, bin long, before long")
            one = (fits.join(F.broadcast(places), F.col("source").eqNullSafe(F.col("s")) & (F.col("b") == F.col("bin")))
                   .withColumn("upto", F.col("before") + F.sum("size").over(
                       Window.partitionBy("source").orderBy("rank"))))  # equal ranks share a sum
            ends = {r["source"]: r for r in one.groupBy("source").agg(
                F.min(F.when(over, F.col("rank"))).alias("rank"),
                F.max(F.when(~over, F.col("upto"))).alias("upto"), F.first("before").alias("before")).collect()}
        for s in open_:
            if s not in ends:  # all that fit, or none does
                parts[s].append((after[s], LAST, deficit[s]))
                deficit[s] -= cross[s]["all"] if s in cross else 0
                after[s] = None
            else:
                r = ends[s]
                parts[s].append((after[s], r["rank"], deficit[s]))
                deficit[s] -= r["before"] if r["upto"] is None else r["upto"]
                after[s] = r["rank"]
        open_ = [s for s in open_ if after[s] is not None and deficit[s] >= 1]

    def sources(extra: dict) -> DataFrame:
        return driver_rows(spark, [(r["source"], r["size"], aim, whole[r["source"]], left[r["source"]],
                                    scale.get(r["source"], 1e-18), parts[r["source"]], extra.get(r["source"]))
                                   for r, aim in zip(found, aims)], _SOURCES)

    spare = sources({}).where("left > 0").join(
        F.broadcast(driver_rows(spark, [(s, x) for s, x in deficit.items()], "t string, deficit double")),
        F.col("source").eqNullSafe(F.col("t"))).select(F.col("source").alias("s"), "parts", "deficit")
    off = F.abs(F.col("size") - F.col("deficit"))
    last = (ranked.join(F.broadcast(spare), F.col("source").eqNullSafe(F.col("s")))
            .where(~_within(F.col("rank"), F.col("size"), F.col("parts"))).where(off < F.col("deficit"))
            .groupBy("source", "draw").agg(F.sum("size").alias("size"), F.first("deficit").alias("deficit"))
            .where(off < F.col("deficit"))
            .groupBy("source").agg(F.min_by("draw", F.struct(off, F.col("draw"))).alias("draw")))
    return sources({r["source"]: r["draw"] for r in last.collect()})


def _within(rank_column: Column, size: Column, parts: Column) -> Column:
    return F.exists(parts, lambda p: (rank_column > p["after"]) & (rank_column < p["until"]) & (size <= p["most"]))


def copies(draw_column: Column, size: Column, plan: str = "") -> Column:
    """Copies of a row, from its draw, its size and its source's allocation (columns, or fields of ``plan``)."""
    whole, left, scale, parts, extra = (F.col(plan + c) for c in ("whole", "left", "scale", "parts", "extra"))
    chosen = (_within(rank(draw_column, size, scale), size, parts)
              | F.coalesce(draw_column == extra, F.lit(False)))
    return whole + F.when(chosen & (left > 0), 1).otherwise(0)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mixed documents: each row as often as it is taken, columns as before."""
    number = draw(docs, doc_id, text, source, seed)
    rows = stored(docs.select(docs[source].alias("source"), words(docs[text]).alias("size"), number.alias("draw")),
                  "mix")
    plan = allocation(rows, weights, share, most)
    s, c, k, z, t = unused(docs, "s", "cutoff", "draw", "words", "taken")
    small = plan.select(F.col("source").alias(s), F.struct("whole", "left", "scale", "parts", "extra").alias(c))
    held = docs.withColumns({k: number, z: words(docs[text])}).join(F.broadcast(small), docs[source].eqNullSafe(F.col(s)))
    n = copies(F.col(k), F.col(z), f"{c}.")
    return (held.withColumn(t, F.explode(F.array_repeat(F.lit(1), n)))
            .select(*[F.col(f"`{x}`") for x in docs.columns]))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = stored(docs.select("doc_id", "source", words(F.col("text")).alias("size"),
                              draw(docs, "doc_id", "text", "source", SEED).alias("draw")), "mix")
    plan = allocation(rows.select("source", "size", "draw")).withColumnRenamed("source", "s")
    return rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * copies(F.col("draw"), F.col("size"))).cast("long").alias("taken"))
