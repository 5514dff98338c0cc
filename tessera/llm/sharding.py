"""K-d tree sharding: shards of near-equal bytes that are compact in the metadata dimensions.

The root is all documents. A node that has to give k shards is split in the dimension in which
its documents spread most (relative to the whole table) at the weighted quantile that leaves
k // 2 shards' bytes on the left. All nodes of a level are split by the same few aggregates: a
histogram of bytes over the current interval of each node, narrowed around the quantile until
the remaining bin hardly weighs anything; equal values are split by a hash of the row. The
driver sees histograms of a fixed number of bins for at most as many nodes as shards, never
rows. DataFrame functions only.

Only ids, sizes, checksums and dimensions are stored and shuffled, never texts.

Defined results: a null text has no bytes, a null dimension counts as -1, infinite values and NaN
lie beyond all others. Copies of a text may part at a split (their bytes are what counts), equal
rows too. An empty table gives an empty result; more shards than documents
leave some shards empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import stored, table

SHARDS, BINS, OVERHEAD = 40, 512, 16
TOLERANCE = 0.0005   # of a shard's bytes: a bin this light is not narrowed further
SLOT_ROWS = 4096     # documents numbered together
FAR = 1e300          # where infinite values and NaN are placed
MOST_ROUNDS = 400    # a histogram narrows an interval by its bins; doubles need far fewer rounds than this


@dataclass
class Node:
    shards: int
    first: int                      # number of its first shard
    split: tuple | None = None      # (dimension, value, tie): left if (x, h) <= (value, tie)
    children: list[Node] = field(default_factory=list)

    def leaf(self) -> Column:
        """The first shard of the node that a row has reached so far."""
        if not self.children:
            return F.lit(self.first)
        dim, value, tie = self.split
        x = F.col(f"d{dim}")
        left = (x < F.lit(value)) | ((x == F.lit(value)) & (F.col("h") <= F.lit(tie)))
        return F.when(left, self.children[0].leaf()).otherwise(self.children[1].leaf())

    def leaves(self) -> list[Node]:
        return [x for c in self.children for x in c.leaves()] if self.children else [self]


def place(value: Column, kind: T.DataType) -> Column:
    """A dimension as a number: numbers and times as they are, strings by their first six bytes."""
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.unix_timestamp(value.cast("timestamp")).cast("double")
    digits = F.rpad(F.substring(F.hex(F.encode(value.cast("string"), "UTF-8")), 1, 12), 12, "0")
    return F.conv(digits, 16, 10).cast("double")


def _row_hash() -> Column:
    """In [0, 1): parts equal values; its last 13 of 53 bits part equal rows, by where they stand."""
    row = F.shiftrightunsigned(F.xxhash64(F.lit(17), F.col("doc_id"), F.col("text_crc32"), F.col("size")), 24)
    place_ = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 51)
    return (row * (1 << 13) + place_) / F.lit(float(1 << 53))


def _finite(x: Column) -> Column:
    """Infinite values and NaN as numbers beyond all usual ones, which a histogram can hold; NaN is the largest."""
    return (F.when(F.isnan(x) | (x > FAR), F.lit(FAR)).when(x < -FAR, F.lit(-FAR)).otherwise(x))


def measured(docs: DataFrame, doc_id: str, text: str, dimensions: Sequence[str]) -> DataFrame:
    """doc_id, size, text_crc32, dimensions d0.. as numbers and the row's hash h; stored."""
    body = F.coalesce(docs[text], F.lit(""))
    low = F.lit(-1.0)
    rows = docs.select(docs[doc_id].alias("doc_id"),
                       (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
                       *[F.coalesce(_finite(place(docs[c], docs.schema[c].dataType)), low).alias(f"d{i}")
                         for i, c in enumerate(dimensions)])
    return stored(rows.withColumn("h", _row_hash()), "shard-rows")


def _narrowed(rows: DataFrame, leaf: Column, aims: dict[int, dict]) -> None:
    """One histogram over the interval of each unfinished node; moves each to the bin of its quantile."""
    spark = rows.sparkSession
    todo = [(k, a["dim"], a["tie"], a["value"], a["low"], a["high"]) for k, a in sorted(aims.items()) if not a["done"]]
    small = spark.createDataFrame(todo, "leaf int, dim int, tie boolean, value double, low double, high double")
    dims = F.array(*[F.col(c) for c in rows.columns if c.startswith("d") and c[1:].isdigit()])
    held = rows.withColumn("leaf", leaf).join(F.broadcast(small), "leaf")
    at = F.element_at(dims, F.col("dim") + 1)
    held = held.withColumn("x", F.when(F.col("tie"), F.when(at == F.col("value"), F.col("h"))).otherwise(at))
    held = held.where(F.col("x").between(F.col("low"), F.col("high")))
    share = (F.col("x") - F.col("low")) / (F.col("high") - F.col("low"))
    bin_ = F.when(F.col("high") > F.col("low"), F.least(F.floor(share * BINS), F.lit(BINS - 1))).otherwise(0)
    found = (held.groupBy("leaf", bin_.alias("bin"))
             .agg(F.sum("size").alias("size"), F.min("x").alias("low"), F.max("x").alias("high")).collect())
    for leaf_id, a in aims.items():
        if a["done"]:
            continue
        bins = sorted((r for r in found if r["leaf"] == leaf_id), key=lambda r: r["bin"])
        for i, r in enumerate(bins):
            if a["below"] + r["size"] >= a["target"] or i == len(bins) - 1:
                break
            a["below"] += r["size"]
            a["previous"] = r["high"]
        a["low"], a["high"], a["weight"] = r["low"], r["high"], r["size"]
        light = r["size"] <= a["tolerance"]
        if light or (r["low"] == r["high"] and a["tie"]):
            # The bin goes to the side that is left closer to its target.
            over, under = a["below"] + r["size"] - a["target"], a["target"] - a["below"]
            cut = r["high"] if over <= under or a["previous"] is None else a["previous"]
            a["split"] = (a["dim"], a["value"], cut) if a["tie"] else (a["dim"], cut, 2.0)
            a["done"] = True
        elif r["low"] == r["high"]:
            a.update(tie=True, value=r["low"], low=0.0, high=1.0, previous=-1.0)


def tree(rows: DataFrame, dimensions: int, shards: int = SHARDS) -> Node:
    """The tree over the measured rows."""
    names = [f"d{i}" for i in range(dimensions)]
    whole = rows.agg(F.sum("size").alias("size"), *[F.min(c).alias(f"{c}_low") for c in names],
                     *[F.max(c).alias(f"{c}_high") for c in names]).first()
    root = Node(shards, 0)
    if whole["size"] is None:
        return root
    spread = [whole[f"{c}_high"] - whole[f"{c}_low"] or 1.0 for c in names]
    tolerance = TOLERANCE * whole["size"] / shards
    while todo := {n.first: n for n in root.leaves() if n.shards > 1 and n.split is None}:
        leaf = root.leaf()
        found = (rows.withColumn("leaf", leaf).where(F.col("leaf").isin(list(todo))).groupBy("leaf")
                 .agg(F.sum("size").alias("size"), *[F.min(c).alias(f"{c}_low") for c in names],
                      *[F.max(c).alias(f"{c}_high") for c in names]).collect())
        aims = {}
        for r in found:
            node = todo[r["leaf"]]
            widths = [(r[f"{c}_high"] - r[f"{c}_low"]) / s for c, s in zip(names, spread)]
            dim = max(range(dimensions), key=lambda i: (widths[i], -i))
            aims[r["leaf"]] = {
                "dim": dim, "tie": False, "value": 0.0, "low": r[f"d{dim}_low"], "high": r[f"d{dim}_high"],
                "below": 0, "target": r["size"] * (node.shards // 2) / node.shards, "previous": None,
                "tolerance": tolerance, "done": False, "split": None}
        rounds = 0
        while any(not a["done"] for a in aims.values()):
            _narrowed(rows, leaf, aims)
            rounds += 1
            if rounds > MOST_ROUNDS:
                raise RuntimeError(f"no quantile after {rounds} rounds: {aims}")
        for first, node in todo.items():
            node.split = aims[first]["split"] if first in aims else (0, 0.0, 0.0)
            if first in aims:
                left = node.shards // 2
                node.children = [Node(left, first), Node(node.shards - left, first + left)]
    return root


def numbered(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """Adds ``slot``: 0, 1, ... in each shard, without sorting a shard in one task."""
    total = rows.count()
    shards = max(1, rows.agg(F.max(shard)).first()[0] or 0) + 1
    groups = max(1, -(-total // (shards * SLOT_ROWS)))
    held = rows.withColumn("g", F.pmod(F.xxhash64(F.lit(3), F.col("doc_id"), F.col("h")), F.lit(groups)))
    sizes = held.groupBy(shard, "g").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(shard).orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(shard, "g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(shard, "g").orderBy("doc_id", "h"))
    return (held.withColumn("k", inside).join(sizes, [shard, "g"])
            .withColumn("slot", (F.col("before") + F.col("k") - 1).cast("long")).drop("g", "k", "before"))


def shard(docs: DataFrame, dimensions: Sequence[str], shards: int = SHARDS, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each document."""
    rows = measured(docs, doc_id, text, dimensions)
    root = tree(rows, len(dimensions), shards)
    return numbered(rows.withColumn("shard", root.leaf().cast("int"))).select(
        "doc_id", "size", "text_crc32", "shard", "slot")


def op6_kd_shards(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = shard(docs, ["source", "lang", "n_chars", "doc_id"])
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
