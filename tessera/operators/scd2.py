"""Type-2 slowly changing customer dimension.

``stage_customers`` flattens a bronze customer feed, keeps the latest record
per customer, and adds the change hash.  ``scd2_merge`` applies a staged load
to the current dimension and returns the complete new dimension:

1. closed versions (``is_current`` false) pass through untouched;
2. a current version whose id is absent from the load, or whose hash is
   unchanged, passes through;
3. a current version whose hash changed is closed: ``is_current=false``,
   ``end_date=now``;
4. a changed or new id gets a new current version starting at ``now``;
5. new versions get dense keys ``max(key)+1, ...`` in id order
   (``assign_keys``, no single-partition window).

Work at scale: the load is joined to the dimension twice, both times on the
narrow ``(id, hash)`` projection of the other side: a left-anti join finds
the new versions, a left join marks the versions to close.  When the load is
small (a daily delta) it is broadcast behind a check of its bytes and the
dimension is never shuffled; otherwise both sides shuffle on the id and AQE
splits hot ids.

A load that names an id twice is reduced to one row per id inside the merge,
the latest by its lineage columns: two rows would each open a version.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.clean import change_hash
from tessera.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, broadcast_if_small
from tessera.operators.keys import assign_keys, latest_per_key
from tessera.operators.rejects import REASONS_COL, with_reasons
from tessera.schemas import CUSTOMERS_SCD2, INGEST_TS_COL, RESCUE_COL, SOURCE_FILE_COL

SCD2_COLUMNS = [f.name for f in CUSTOMERS_SCD2.fields]
HASH_COLUMNS = ("name", "email", "region")


def load_time() -> str:
    """The present instant as a timestamp literal with its zone."""
    return _dt.datetime.now(_dt.timezone.utc).isoformat(sep=" ")


def _ts(value) -> F.Column:
    if isinstance(value, F.Column):
        return value.cast("timestamp")
    return F.lit(value).cast("timestamp")


def stage_customers(bronze: DataFrame, now=None, hash_columns: Sequence[str] = HASH_COLUMNS,
                    dedupe: bool = True, null_token: str | None = None) -> DataFrame:
    """Bronze customers -> staged rows (one per id, hash, interval columns).

    ``now``: start of the staged versions (default: the time of this call, as
    a literal, so a version that ends and the one that follows it share it
    however often the plan runs).
    Rows with a NULL customer_id are dropped (see ``rejected_customers``).
    """
    now = load_time() if now is None else now
    flat = (bronze.filter(F.col("customer_id").isNotNull())
            .select("customer_id", "name", F.col("contact.email").alias("email"), "region",
                    INGEST_TS_COL, SOURCE_FILE_COL))
    if dedupe:
        flat = latest_per_key(flat, ["customer_id"], [INGEST_TS_COL, SOURCE_FILE_COL])
    return (flat.withColumn("hash_value", change_hash(list(hash_columns), null_token))
            .withColumn("start_date", _ts(now))
            .withColumn("end_date", F.lit(None).cast("timestamp"))
            .withColumn("is_current", F.lit(True)))


def customer_reject_reasons(rescue_col: str = RESCUE_COL) -> dict[str, F.Column]:
    """Why a bronze customer row is not staged: reason -> condition."""
    corrupt = F.coalesce(F.col(rescue_col).startswith('{"_corrupt_record":'), F.lit(False))
    return {"unreadable document": corrupt,
            "no customer_id": F.col("customer_id").isNull() & ~corrupt}


def rejected_customers(bronze: DataFrame) -> DataFrame:
    """The rows that staging leaves out, with their ``reasons``."""
    return with_reasons(bronze, customer_reject_reasons()).filter(F.size(REASONS_COL) > 0)


def empty_dimension(spark) -> DataFrame:
    return spark.createDataFrame([], CUSTOMERS_SCD2)


def max_key(dim: DataFrame, key_col: str = "customer_key") -> int:
    """max(key) over the dimension as a driver scalar (0 when empty)."""
    value = dim.agg(F.max(key_col)).first()[0]
    return int(value or 0)


def scd2_merge(current: DataFrame, staged: DataFrame, now=None, id_col: str = "customer_id",
               key_col: str = "customer_key", hash_col: str = "hash_value",
               max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, initial_start=None) -> DataFrame:
    """Return the dimension after applying ``staged`` (rules in the module doc).

    ``now``: the change time; closed versions end at it.  Defaults to the
    staged rows' own ``start_date``.  ``initial_start``: when the first version
    of an id that the dimension does not know begins (default: the change
    time), so that facts older than the first load find a version.
    """
    columns = current.columns
    staged = staged.filter(F.col(id_col).isNotNull())
    change_time = F.col("start_date") if now is None else _ts(now)
    staged = staged.withColumn("start_date", change_time)
    staged = latest_per_key(staged, [id_col], [c for c in (INGEST_TS_COL, SOURCE_FILE_COL) if c in staged.columns])

    closed = current.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    live = current.filter(F.coalesce(F.col("is_current"), F.lit(False)))

    # 4. changed or new ids: staged rows without a live version of the same hash.
    live_ids = live.select(id_col, hash_col)
    fresh = staged.join(live_ids, on=[id_col, hash_col], how="left_anti")
    if initial_start is not None:
        known = current.select(F.col(id_col).alias("_k_id")).distinct().withColumn("_known", F.lit(True))
        begin = F.when(F.col("_known"), F.col("start_date")).otherwise(_ts(initial_start))
        fresh = (fresh.join(known, fresh[id_col] == known["_k_id"], "left").withColumn("start_date", begin)
                 .select(*staged.columns))
    base = max_key(current, key_col)
    fresh_keyed = assign_keys(fresh, [id_col], key_col, base=base)
    inserted = fresh_keyed.select(*[F.col(c) if c in fresh_keyed.columns
                                    else F.lit(None).alias(c) for c in columns])

    # 2./3. live versions: close those whose id arrives with another hash.
    incoming = broadcast_if_small(
        staged.select(F.col(id_col).alias("_s_id"), F.col(hash_col).alias("_s_hash"),
                      F.col("start_date").alias("_s_start")),
        max_broadcast_bytes)
    marked = live.join(incoming, live[id_col] == incoming["_s_id"], "left")
    changed = F.col("_s_id").isNotNull() & (F.col("_s_hash") != F.col(hash_col))
    updated = (marked.withColumn("is_current", ~changed)
               .withColumn("end_date", F.when(changed, F.col("_s_start")).otherwise(F.col("end_date")))
               .select(*columns))

    return closed.select(*columns).unionByName(updated).unionByName(inserted.select(*columns))


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Insert-only merge: ``target`` plus the ``source`` rows whose keys are absent."""
    keys = list(keys)
    probe = broadcast_if_small(target.select(*keys).distinct(), max_broadcast_bytes)
    missing = source.join(probe, on=keys, how="left_anti")
    return target.unionByName(missing.select(*target.columns))


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """SQL UNION: rows of both inputs, duplicates removed (matched by name)."""
    return first.unionByName(second).distinct()


def unchanged_versions(staged: DataFrame, current: DataFrame, id_col: str = "customer_id",
                       hash_col: str = "hash_value", key_col: str = "customer_key") -> DataFrame:
    """Staged rows that equal a current version (inner join on id and hash),
    carrying the existing key."""
    live = current.filter(F.col("is_current")).select(id_col, hash_col, key_col)
    return staged.join(live, on=[hash_col, id_col], how="inner")


def staged_with_match(staged: DataFrame, current: DataFrame, id_col: str = "customer_id",
                      hash_col: str = "hash_value", key_col: str = "customer_key") -> DataFrame:
    """Every staged row, with the key of an equal current version or NULL."""
    live = current.filter(F.col("is_current")).select(id_col, hash_col, key_col)
    return staged.join(live, on=[hash_col, id_col], how="left")
