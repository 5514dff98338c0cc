"""Helpers that several operators use: scratch tables, sizes, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.session import checkpoint_root

#: ``[^\x20\x09-\x0D]+``: the words of a text (fixed value, from the query contracts).
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 4 << 20  # of an Arrow batch of wide rows; a worker and its executor hold several, and their buffers double
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; removed when the session's JVM ends."""
    path = f"{checkpoint_root(spark)}/tessera-llm/{name}-{uuid.uuid4().hex[:12]}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


@contextmanager
def set_for(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs run inside."""
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def arrow_rows(spark: SparkSession, rows: int | None):
    """Arrow batches of at most so many rows and some megabytes for the jobs run inside (wide rows: texts, blobs)."""
    return set_for(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
                           "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)} if rows else {})


@contextmanager
def writing(spark: SparkSession, batch_rows: int | None = None) -> Iterator[None]:
    """For a write: Arrow batches of so many rows, and the job's shuffle files go when it ends."""
    with arrow_rows(spark, batch_rows), set_for(spark, {_CLEANUP: "true"}):
        yield


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session hold some megabytes at most.

    For operators that return texts from Python without storing them: the job that reads them runs elsewhere.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage; a lost executor costs only the tasks that were running there. Shuffle files of the job go when
    it ends. ``drop_stored`` removes the table; what is left goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with writing(spark, batch_rows):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` returned, once no later job reads them."""
    for t in tables:
        spark = t.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(t.stored_path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SKETCH_WORDS = 1 << 19  # 64-bit words of a Bloom filter, at most: some megabytes


def likely_in(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose key no row of ``wanted`` (stored; a column of the same name) has.

    For the rows that an exact join would shuffle only to drop them. A Bloom filter of about 16 bits a key (2 set, in
    one word of 64) is broadcast; its size is bounded, so with very many keys it lets more rows pass.
    """
    words = min(SKETCH_WORDS, max(1, wanted.count() // 4))
    word, bits, seen = unused(rows, "word", "bits", "seen")

    def placed(df: DataFrame) -> dict:
        h = F.xxhash64(df[key])
        bit = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, n).bitwiseAND(63).cast("int"))
               for n in (40, 52)]
        return {word: F.pmod(h, F.lit(words)), bits: bit[0].bitwiseOR(bit[1])}

    sketch = wanted.select(key).withColumns(placed(wanted)).groupBy(word).agg(F.bit_or(bits).alias(seen))
    held = rows.withColumns(placed(rows)).join(F.broadcast(sketch), word)
    return held.where(F.col(seen).bitwiseAND(F.col(bits)) == F.col(bits)).select(*[F.col(f"`{c}`") for c in rows.columns])


def driver_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A few rows of the driver as a DataFrame; as Arrow, so no Python workers are started on the executors for them."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [()] * len(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kinds)],
                                                      schema=kinds), schema)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores added until none clashes with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(id, component)`` per node.

    ``component`` is the smallest node id that the node reaches. Each round gives every node
    the smallest label among itself and its neighbours, then follows the label of that label
    (pointer jumping), so long chains close in a logarithmic number of rounds. A hub's
    neighbours are reduced by a map-side minimum; labels are stored between rounds.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null")
    both = stored(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    first = both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component"))
    held = labels = stored(first, "labels")
    for _ in range(max_rounds):
        near = (both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near")))
        step = (labels.join(near, labels.id == near.a)
                .select("id", F.col("component").alias("old"), F.least("component", "near").alias("component")))
        up = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
        jumped = step.join(up, "component", "left").select(
            "id", "old", F.least("component", F.coalesce("up", "component")).alias("component"))
        jumped = stored(jumped, "labels")
        drop_stored(held)
        held, labels = jumped, jumped.select("id", "component")
        if jumped.where("old <> component").isEmpty():
            drop_stored(both)
            return labels
    raise RuntimeError(f"labels still change after {max_rounds} rounds")
