"""Catalog tables of the layered model (schemas META, BRONZE, SILVER, GOLD).

Plain Spark catalog calls; the table format is a parameter (parquet here; no
table format with a transaction log is on the classpath).

**Versions.**  A table that is replaced as a whole (``overwrite_table``,
``publish``, ``write_clustered``, ``write_partitioned``) gets a new folder per
write, ``<schema folder>/<table>.versions/v<n>``.  The catalog's LOCATION is
switched to it as the last step, one catalog call.  A write that dies at any
point leaves the table as it was, readers of the old version are not
disturbed, and a plan may read the very table it replaces.  Leftovers of dead
writes are never committed (no ``_SUCCESS``) and go with the next write, as do
versions older than the one before the current.  Where the schema changes in
more than new columns, the table is dropped and created again over the new
folder; ``attach_table`` completes such a switch, and registers a table's last
committed version in a catalog that does not know it (a new session over the
same root).

Partition folders of such tables are found in the file system, not in the
catalog, so that one switch moves them all.

**Appends** go into the current version's folder.  They are Spark's own
appends: files of an uncommitted task are never read.

**Layouts** of the fact table's clustering keys:
``write_partitioned``: one folder per value of the leading key (the order
date), rows sorted by the other keys inside each file.  A ``rebalance`` hint
lets AQE split a hot date into several files and merge small ones; no sampling
pass, and date filters prune folders.
``write_clustered`` (pipeline default): a range partitioning over all keys plus
a sort, so min/max statistics skip files on the leading key, and a hot date is
split by the following keys; costs a sampling pass over the input.
``interleaved_layout``: ranges of the interleaved bits of all keys' quantile
ranks, so statistics skip files on each of the keys (``operators.layout``).
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructField, StructType

from tessera.session import TABLE_CODEC

LAYERS = ("meta", "bronze", "silver", "gold")
_IN_CATALOG = "spark.sql.hive.manageFilesourcePartitions"


def create_layers(spark: SparkSession, root: str | None = None, prefix: str = "",
                  layers: Sequence[str] = LAYERS) -> dict[str, str]:
    """CREATE SCHEMA IF NOT EXISTS for each layer; returns layer -> schema name."""
    names = {}
    for layer in layers:
        name = f"{prefix}{layer}"
        if root:
            location = f"{root.rstrip('/')}/{name}.db".replace("'", "\\'")
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name) LOCATION '{location}'",
                      args={"name": name})
        else:
            spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})
        names[layer] = name
    return names


def current_catalog(spark: SparkSession) -> str:
    return spark.catalog.currentCatalog()


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


# -- Versions ---------------------------------------------------------------

class Folder:
    """A folder of a table's versions on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, name: str):
        schema, _, table = name.rpartition(".")
        database = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase())
        self.path = f"{database.locationUri.rstrip('/')}/{table}.versions"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> dict[int, bool]:
        """Number of each version -> whether its write was committed."""
        folder = self._path(self.path)
        if not self._fs.exists(folder):
            return {}
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        numbers = [int(n[1:]) for n in names if re.fullmatch(r"v\d{8}", n)]
        return {n: self._fs.exists(self._path(f"{self.version(n)}/_SUCCESS")) for n in sorted(numbers)}

    def version(self, number: int) -> str:
        return f"{self.path}/v{number:08d}"

    def delete(self, number: int) -> None:
        self._fs.delete(self._path(self.version(number)), True)


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


_SETTING = threading.Lock()


@contextmanager
def _partitions_from_files(spark: SparkSession) -> Iterator[None]:
    """One statement at a time: the setting is the whole session's, and steps run in threads."""
    with _SETTING:
        before = spark.conf.get(_IN_CATALOG)
        spark.conf.set(_IN_CATALOG, "false")
        try:
            yield
        finally:
            spark.conf.set(_IN_CATALOG, before)


def _create_over(spark: SparkSession, name: str, path: str, schema: StructType, fmt: str,
                 partition_by: Sequence[str]) -> None:
    """Register ``name`` over the files at ``path``; the files are there already."""
    with _partitions_from_files(spark):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IDENTIFIER(:t) ({columns}) USING {fmt}{parts} LOCATION '{location}'",
                  args={"t": name})


def switch_to(spark: SparkSession, name: str, path: str, schema: StructType, fmt: str = "parquet",
              partition_by: Sequence[str] = ()) -> None:
    """Let the catalog's ``name`` be the files at ``path``."""
    partition_by = list(partition_by)
    schema = StructType([f for f in schema.fields if f.name not in partition_by]
                        + [schema[c] for c in partition_by])
    if table_exists(spark, name):
        have, parts = spark.table(name).schema, partition_columns(spark, name)
        known = {f.name: f for f in have.fields}
        fresh = [f for f in schema.fields if f.name not in known]
        if _shape(have) != _shape(schema) and not partition_by and not parts and fresh:
            add_columns(spark, name, StructType(fresh))
            have = spark.table(name).schema
        if _shape(have) == _shape(schema) and parts == partition_by and not _tracked(spark, name, parts):
            location = path.replace("'", "\\'")
            spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET LOCATION '{location}'", args={"t": name})
            return
        spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": name})
    _create_over(spark, name, path, schema, fmt, partition_by)


def _tracked(spark: SparkSession, name: str, parts: Sequence[str]) -> bool:
    """Whether the catalog itself lists the table's partitions."""
    if not parts:
        return False
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": name}).collect()
    return any(r["col_name"] == "Partition Provider" and r["data_type"] == "Catalog" for r in rows)


def _writer(df: DataFrame, fmt: str, mode: str) -> DataFrameWriter:
    writer = df.write.format(fmt).mode(mode)
    return writer.option("compression", TABLE_CODEC) if fmt.lower() == "parquet" else writer


def write_version(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Replace table ``name`` by ``df``: a new folder, then one switch; returns the folder."""
    spark = df.sparkSession
    folder = Folder(spark, name)
    have = folder.versions()
    committed = [n for n, whole in have.items() if whole]
    path = folder.version(max(have, default=0) + 1)
    writer = _writer(df, fmt, "errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    switch_to(spark, name, path, df.schema, fmt, partition_by)
    # The version before stays for plans that still read it.
    for n in have:
        if n not in committed[-1:]:
            folder.delete(n)
    return path


def attach_table(spark: SparkSession, name: str, fmt: str = "parquet") -> bool:
    """Register the last committed version of a table that the catalog lacks; True if there was one.

    The catalog lacks it in a new session whose catalog keeps nothing, and after a write that
    changed the schema and died between dropping the table and creating it again.
    """
    if table_exists(spark, name):
        return False
    folder = Folder(spark, name)
    committed = [n for n, whole in folder.versions().items() if whole]
    if not committed:
        return False
    path = folder.version(committed[-1])
    found = spark.read.format(fmt).load(path)
    parts = [n for n in found.columns if _is_folder_key(spark, path, n)]
    _create_over(spark, name, path, found.schema, fmt, parts)
    return True


def _is_folder_key(spark: SparkSession, path: str, column: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*"))
    return found is not None and len(found) > 0


def create_table_if_missing(spark: SparkSession, name: str, schema: StructType,
                            fmt: str = "parquet") -> bool:
    """Create an empty table with ``schema`` unless it exists; True if created.

    A table with a committed version that the catalog lacks counts as existing."""
    if table_exists(spark, name) or attach_table(spark, name, fmt):
        return False
    write_version(spark.createDataFrame([], schema), name, fmt)
    return True


def publish(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Replace table ``name`` with ``df`` even when ``df`` reads ``name``."""
    write_version(df, name, fmt)


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    write_version(df, name, fmt)


# -- Schema -------------------------------------------------------------------

def add_columns(spark: SparkSession, name: str, fields: StructType) -> None:
    """ALTER TABLE ADD COLUMNS; older files give NULL for them."""
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)
    spark.sql(f"ALTER TABLE IDENTIFIER(:t) ADD COLUMNS ({listed})", args={"t": name})


def missing_fields(spark: SparkSession, name: str, schema: StructType) -> list[StructField]:
    """Fields of ``schema`` that table ``name`` lacks; one of another type raises."""
    have = {f.name.lower(): f for f in spark.table(name).schema.fields}
    out = []
    for f in schema.fields:
        known = have.get(f.name.lower())
        if known is None:
            out.append(StructField(f.name, f.dataType, True))
        elif known.dataType.simpleString() != f.dataType.simpleString():
            raise TypeError(f"{name}.{f.name} is {known.dataType.simpleString()}, not {f.dataType.simpleString()}")
    return out


def aligned(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns of table ``name``, in its order; those it lacks are NULL."""
    from pyspark.sql import functions as F
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(f"`{have[f.name.lower()]}`").alias(f.name) if f.name.lower() in have
                       else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in df.sparkSession.table(name).schema.fields])


# -- Appends ------------------------------------------------------------------

def append_table(df: DataFrame, name: str, fmt: str = "parquet", evolve: bool = False) -> None:
    """Append, columns matched by name, into the table's own partitioning.

    ``evolve``: columns that the table lacks are added to it first, and columns
    that ``df`` lacks are NULL; otherwise both are errors.
    """
    spark = df.sparkSession
    if evolve:
        fresh = missing_fields(spark, name, df.schema)
        if fresh:
            add_columns(spark, name, StructType(fresh))
        df = aligned(df, name)
    writer = _writer(df, fmt, "append")
    parts = partition_columns(spark, name)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.saveAsTable(name)


def insert_into(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """``INSERT INTO name SELECT ...``: columns bound by *position*, as in SQL.
    Prefer ``append_table`` (by name) unless the positional form is intended."""
    df.write.insertInto(name, overwrite=overwrite)


def overwrite_partitions(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Replace those partitions of table ``name`` for which ``df`` has rows; the others keep their files.

    New folders are written beside the table and moved in at the end. A run that dies among the moves
    leaves some of these partitions old, new or missing, so the caller notes what it has written only
    afterwards and writes the same partitions again.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, name)
    (_writer(df.select(*spark.table(name).columns), fmt, "overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(table_path(spark, name)))
    spark.catalog.refreshTable(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def table_path(spark: SparkSession, name: str) -> str:
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": name}).collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


# -- Layouts ------------------------------------------------------------------

def cluster_layout(df: DataFrame, keys: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``keys`` (file-level skipping on those keys)."""
    keys = list(keys)
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_clustered(df: DataFrame, name: str, keys: Sequence[str], fmt: str = "parquet") -> None:
    write_version(cluster_layout(df, keys), name, fmt)


def partition_layout(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Rebalance on the partition columns (AQE splits skewed and merges small
    partitions), then sort each file by partition and sort keys."""
    return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by)


def write_partitioned(df: DataFrame, name: str, partition_by: Sequence[str],
                      sort_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    write_version(partition_layout(df, partition_by, sort_by), name, fmt, partition_by)


def create_or_append(df: DataFrame, name: str, cluster_by: Sequence[str] = (), fmt: str = "parquet",
                     partition_by: Sequence[str] = ()) -> str:
    """Create the table from ``df`` when missing, else append (by name); returns the operation.

    ``partition_by`` folders the table by those columns (sorted by the rest of ``cluster_by``);
    otherwise ``cluster_by`` is a range layout.  A caller that counts the rows as they are written
    lays ``df`` out itself, below its count, and gives no ``cluster_by``."""
    spark = df.sparkSession
    if cluster_by:
        df = (partition_layout(df, partition_by, [c for c in cluster_by if c not in partition_by]) if partition_by
              else cluster_layout(df, cluster_by))
    if not table_exists(spark, name) and not attach_table(spark, name, fmt):
        write_version(df, name, fmt, partition_by)
        return "CREATE TABLE AS SELECT"
    append_table(df.select(*spark.table(name).columns), name, fmt)
    return "WRITE"


def register_path_table(spark: SparkSession, name: str, path: str, schema: StructType, fmt: str = "parquet",
                        partition_by: Sequence[str] = ()) -> None:
    """(Re)register an external table over a folder written outside the catalog; its partition
    folders are found in the file system, so new ones need no registration."""
    columns = StructType([f for f in schema.fields if f.name not in partition_by]
                         + [schema[c] for c in partition_by])
    if table_exists(spark, name):
        same = (_shape(spark.table(name).schema) == _shape(columns)
                and table_path(spark, name).rstrip("/") == _qualified(spark, path))
        if same:
            spark.catalog.refreshTable(name)
            return
        spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": name})
    _create_over(spark, name, path, columns, fmt, list(partition_by))


def _qualified(spark: SparkSession, path: str) -> str:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(jpath).toString().rstrip("/")
