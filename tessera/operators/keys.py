"""Surrogate keys and latest-record-per-key.

``assign_keys`` gives dense keys ``base+1 .. base+n`` in the order of the
given columns without a single-partition window:

1. write the input once under the checkpoint root: it is evaluated a single
   time, whatever the passes below read again;
2. range-partition by the order columns (the sampling pass reads the stored
   rows), sort within partitions and write that table: its files, in the order
   of their task numbers, hold the rows in key order;
3. count rows per file and turn the counts into running offsets (one row per
   file);
4. a row's key is its file's offset plus its position in the file, which the
   scan gives as ``_metadata.row_index``: positions are stored, so tasks that
   rerun after the loss of an executor find the same ones.

``latest_per_key`` keeps one row per key with a max-struct aggregate instead
of a window: the aggregate combines map-side, so a key holding a third of all
rows is reduced before the shuffle rather than sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType, DataType

from tessera.session import stored



def assign_keys(df: DataFrame, order_by: Sequence[str], key_col: str, base: int = 0,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = base + 1-based position of the row in ``order_by`` order.

    Ties in ``order_by`` are ordered by a hash of the whole row (identical
    rows in any order), which also spreads a hot order value over several
    partitions.
    """
    # A hash of the whole row breaks ties deterministically, so a value shared
    # by many rows is spread over several range partitions instead of one.
    columns = df.columns
    tail = "_" * max([0, *(len(c) for c in columns)])  # longer than any name of the input's
    file_col, row_col, offset_col, count_col = (f"{x}{tail}" for x in ("file", "row", "offset", "count"))
    once = stored(df, "keys-in")
    order = [F.col(c) for c in order_by] + [F.xxhash64(*[F.col(c) for c in columns])]
    # Without an explicit count AQE sizes the range partitions (it only merges
    # neighbouring ranges, so the order across partitions is kept).
    ranged = once.repartitionByRange(num_partitions, *order) if num_partitions else once.repartitionByRange(*order)
    in_order = stored(ranged.sortWithinPartitions(*order), "keys-sorted", maxRecordsPerFile=0)
    placed = in_order.select("*", F.col("_metadata.file_name").alias(file_col), F.col("_metadata.row_index").alias(row_col))
    counts = placed.groupBy(file_col).agg(F.count(F.lit(1)).alias(count_col))
    task = F.regexp_extract(file_col, r"^part-(\d+)", 1).cast("long")
    # Running offsets over the per-file counts: at most one row per task, in one task.
    running = Window.orderBy(task, file_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(file_col, F.coalesce(F.sum(count_col).over(running), F.lit(0)).alias(offset_col))
    keyed = placed.join(F.broadcast(offsets), file_col, "inner")
    keyed = keyed.withColumn(key_col, (F.lit(base) + F.col(offset_col) + F.col(row_col) + 1).cast("long"))
    # A scan reads several small files in one task; who asks for partitions gets them, by the dense key.
    keyed = keyed.repartitionByRange(num_partitions, key_col) if num_partitions else keyed
    return keyed.select(*columns, key_col)


def _orderable(dt: DataType) -> bool:
    if isinstance(dt, (MapType, VariantType)):
        return False
    if isinstance(dt, ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order_by`` tuple.

    NULLs sort lowest (so they lose, as with ``ORDER BY ... DESC NULLS LAST``);
    remaining orderable columns break ties, so the pick is deterministic.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    tie = [c for c in rest if _orderable(df.schema[c].dataType)]
    ordering = F.struct(*[F.col(c) for c in order_by + tie])
    payload = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    picked = df.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_latest"))
    return picked.select(*keys, "_latest.*").select(*df.columns)
