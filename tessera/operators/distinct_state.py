"""Distinct counts that can be kept and merged: bitmaps over dense numbers.

A count of distinct ids per group cannot be added up when new rows arrive. Kept as bitmaps it can:
every id gets a dense number once (``number_new``), a group's ids are bits in pieces of 32,768
(Spark's own bitmap aggregates), and two states of a group are merged by OR, piece by piece. Sums
ride along. Rows seen before are never read again.

A state has one row per group and piece that holds any id (4 KB each, mostly zeros, which compress);
ids numbered in the order of arrival fall into few pieces per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import assign_keys

PIECE, BITS = "_piece", "_bits"


def empty_numbers(spark, id_col: str, number_col: str) -> DataFrame:
    return spark.createDataFrame([], f"`{id_col}` string, `{number_col}` long")


def number_new(known: DataFrame, ids: DataFrame, id_col: str, number_col: str, order_by: Sequence[str] = ()) -> DataFrame:
    """``known`` (id, number) and the distinct new ids of ``ids`` with the next dense numbers.

    ``order_by``: columns of ``ids`` by whose smallest value new ids are numbered, so that ids of a
    day stand together. NULL ids get no number.
    """
    fresh = ids.where(F.col(id_col).isNotNull()).join(known.select(id_col), id_col, "left_anti")
    fresh = fresh.groupBy(id_col).agg(*[F.min(c).alias(f"_by_{c}") for c in order_by]) if order_by else (
        fresh.select(id_col).distinct())
    base = known.agg(F.max(number_col)).first()[0] or 0
    keyed = assign_keys(fresh, [*[f"_by_{c}" for c in order_by], id_col], number_col, base=base)
    return known.select(id_col, number_col).unionByName(keyed.select(id_col, number_col))


def state_of(rows: DataFrame, numbers: DataFrame, groups: Sequence[str], id_col: str, number_col: str,
             sums: Sequence[str]) -> DataFrame:
    """The state of ``rows``: groups, piece, bits, and the sums of the piece's rows."""
    held = rows.join(numbers.select(F.col(id_col).alias("_id"), F.col(number_col).alias("_n")),
                     F.col(id_col) == F.col("_id"), "left")
    piece = F.bitmap_bucket_number("_n").alias(PIECE)
    return held.groupBy(*groups, piece).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias(BITS),
                                            *[F.sum(c).alias(c) for c in sums])


def merged(first: DataFrame, second: DataFrame, groups: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """One state of the rows of both."""
    return first.unionByName(second).groupBy(*groups, PIECE).agg(
        F.bitmap_or_agg(BITS).alias(BITS), *[F.sum(c).cast(first.schema[c].dataType).alias(c) for c in sums])


def counted(state: DataFrame, groups: Sequence[str], sums: Sequence[str], count_col: str) -> DataFrame:
    """Per group: the sums and how many distinct ids it has."""
    ids = F.when(F.col(PIECE).isNotNull(), F.bitmap_count(BITS)).otherwise(0)
    return state.groupBy(*groups).agg(*[F.sum(c).cast(state.schema[c].dataType).alias(c) for c in sums],
                                      F.sum(ids).alias(count_col))
