"""Session settings every operator relies on.

* ``spark.sql.session.timeZone=UTC``: timestamps parsed from zoned strings are
  instants; ``cast(ts as date)`` follows the session zone, so UTC is pinned.
* AQE with skew-join splitting and partition coalescing: joins on hot keys
  (one customer or item holding a large share of the rows) get split at run
  time instead of landing in one task.
* The checkpoint folder is read from the session (``spark.checkpoint.dir``);
  a local one is created only when the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings (all are session-modifiable SQL confs).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A list of many files is looked up in this many tasks, not in one task per file.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "24",
}

# Bytes of Parquet tables that stay: about half of those by Spark's default codec.
TABLE_CODEC = "zstd"
_SAMPLES = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_CHECKPOINT = {"dir": None}


def configure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume; returns ``spark``."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def build_session(master: str = "local[8]", app: str = "tessera",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs (the UI stays off)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               # Small local inputs: let AQE keep enough post-shuffle partitions
               # to use every core (clusters keep their own settings).
               .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k"))
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure_session(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and working tables.

    Uses ``spark.checkpoint.dir`` when the cluster sets it, else the folder set
    on the context; only a local master gets one under the system temp folder.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    already = spark.sparkContext.getCheckpointDir()
    if already and _LOCAL_CHECKPOINT["dir"] is None:
        return already.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _LOCAL_CHECKPOINT["dir"] is None:
        _LOCAL_CHECKPOINT["dir"] = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if not already:
        spark.sparkContext.setCheckpointDir(_LOCAL_CHECKPOINT["dir"])
    return _LOCAL_CHECKPOINT["dir"]


@contextmanager
def _set_for(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """For writes of one thread: a job's shuffle files go when it ends, not when the driver next collects garbage."""
    return _set_for(spark, _CLEANUP, "true")


def range_samples(spark: SparkSession, rows_per_part: int):
    """For writes of one thread: how many keys per partition a range partitioning brings to the driver, about a third
    of what it takes at most."""
    return _set_for(spark, _SAMPLES, str(rows_per_part))


def stored(df: DataFrame, name: str = "stored", **options) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint root and read it back: computed once, lineage cut.

    ``options`` go to the writer. The folder is removed when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tessera-{name}-{uuid.uuid4().hex[:12]}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder under the checkpoint root, unique per call."""
    root = checkpoint_root(spark)
    path = f"{root}/tessera-{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path
