"""Joins of facts to dimensions.

``temporal_join`` pairs each fact row with the dimension versions whose
half-open validity interval ``[start, end)`` (open end = NULL) holds the fact
timestamp.  Keyed (``on=``) it is an equi join with a residual interval test;
unkeyed it pairs the row with *every* valid version (the original semantics).

Strategies for the unkeyed form:

* ``broadcast``: nested-loop join with the version side broadcast.  Chosen only
  after its size in bytes proved small (``max_broadcast_bytes``).
* ``index`` (also ``bucket``): equi join on the nodes of an interval index
  (``operators.interval_index``); copies of a version grow with the logarithm
  of its length, whatever the number of versions.

An unkeyed join gives many rows per fact, so facts are dealt to tasks by the
bytes they were read from before it (``fan_out_parts``): a task's work and its
aggregates stay the same on larger tables.

Look-ups (``lookup_join``) and keyed joins broadcast a side only if the
optimizer's own estimate of its bytes is small.  Otherwise AQE decides at run
time, by the bytes that its shuffle has written, and splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.interval_index import DEFAULT_UNIT_SECONDS, interval_join
from tessera.operators.sizes import bytes_at_most, fan_out_parts  # noqa: F401 (used through this module too)

DEFAULT_MAX_BROADCAST_BYTES = 8 << 20
DEFAULT_MAX_NESTED_LOOP_BYTES = 1 << 20
DEFAULT_BUCKET_SECONDS = DEFAULT_UNIT_SECONDS


def unkeyed_strategy(versions: DataFrame, max_nested_loop_bytes: int = DEFAULT_MAX_NESTED_LOOP_BYTES) -> str:
    """What "auto" means for these versions."""
    return "broadcast" if bytes_at_most(versions, max_nested_loop_bytes) else "index"


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df`` (no job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a side whose estimated bytes are few, as Spark's own threshold judges it; else left to AQE."""
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df


def interval_contains(ts: Column, start: Column, end: Column) -> Column:
    """``start <= ts < end`` with a NULL end meaning open."""
    return (ts >= start) & (end.isNull() | (ts < end))


def _key_pairs(on: Sequence[str] | Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def temporal_join(facts: DataFrame, versions: DataFrame, ts: str, start: str, end: str,
                  on: Sequence[str] | Sequence[tuple[str, str]] | None = None,
                  how: str = "left", strategy: str = "auto",
                  bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                  max_nested_loop_bytes: int = DEFAULT_MAX_NESTED_LOOP_BYTES,
                  max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Join fact rows to the versions valid at ``facts[ts]``.

    Column names of the two sides must not overlap except for the ``on`` keys
    given as plain names (those are taken from the fact side).  Returns all
    fact columns followed by all version columns.
    """
    if how not in ("left", "inner"):
        raise ValueError("temporal_join supports how='left' or 'inner'")
    f, v = facts.alias("_f"), versions.alias("_v")
    cond = interval_contains(F.col(f"_f.{ts}"), F.col(f"_v.{start}"), F.col(f"_v.{end}"))
    same_name_keys: set[str] = set()
    if on:
        pairs = _key_pairs(on)
        same_name_keys = {rk for lk, rk in pairs if lk == rk}
        for lk, rk in pairs:
            cond = cond & (F.col(f"_f.{lk}") == F.col(f"_v.{rk}"))
        right = broadcast_if_small(v, max_broadcast_bytes)
        joined = f.join(right, cond, how)
    else:
        if strategy == "auto":
            strategy = unkeyed_strategy(versions, max_nested_loop_bytes)
        if strategy == "broadcast":
            joined = f.join(F.broadcast(v), cond, how)
        elif strategy in ("index", "bucket"):
            return interval_join(facts, versions, ts, start, end, how, bucket_seconds)
        else:
            raise ValueError(f"unknown strategy {strategy!r}")
    cols = [F.col(f"_f.{c}") for c in facts.columns]
    cols += [F.col(f"_v.{c}") for c in versions.columns if c not in same_name_keys]
    return joined.select(*cols)


def lookup_join(facts: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "left",
                max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Equi join on shared key name(s) (USING semantics: one copy of the key)."""
    keys = [key] if isinstance(key, str) else list(key)
    return facts.join(broadcast_if_small(dim, max_broadcast_bytes), on=keys, how=how)
