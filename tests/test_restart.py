"""Writes and runs that die: table versions, merge progress, audited row counts, the writer lock."""

import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.plans.runner import merged_upto, record_merged
from tessera.schemas import CUSTOMERS_SCD2
from tessera.sources import tables
from tessera.sources.audit import audit_history, audited_write
from tessera.sources.lock import LockTaken, WriterLock, writer_lock
from tessera.sources.tables import (Folder, attach_table, cluster_layout, create_layers, create_table_if_missing,
                                    overwrite_table, partition_columns, publish, write_version)


@pytest.fixture()
def silver(spark, workdir):
    return create_layers(spark, root=f"{workdir}/wh", prefix=f"v{uuid.uuid4().hex[:6]}_")["silver"]


def ids(spark, name):
    return sorted(r.id for r in spark.table(name).collect())


class Dead(RuntimeError):
    pass


def die(*_args, **_kwargs):
    raise Dead


@pytest.mark.parametrize("step", ["files", "switch", "create"])
@pytest.mark.parametrize("first", [True, False])
def test_a_write_that_dies_leaves_the_table_and_the_next_succeeds(spark, silver, monkeypatch, step, first):
    name = f"{silver}.t"
    if not first:
        overwrite_table(spark.range(3), name)
    held = None if first else spark.table(name)
    boom = F.udf(lambda x: 1 // (x - 1), "long")
    new = spark.range(5).withColumn("id", boom("id")) if step == "files" else spark.range(5)
    if step == "create":  # the schema changes, so the table is dropped and created
        new = spark.range(5).select(F.col("id").cast("string").alias("id"))
    with monkeypatch.context() as m:
        if step == "switch":
            m.setattr(tables, "switch_to", die)
        elif step == "create":
            m.setattr(tables, "_create_over", die)
        with pytest.raises(Exception):
            overwrite_table(new, name)
    if first:
        assert not spark.catalog.tableExists(name)
    elif step != "create":
        assert ids(spark, name) == [0, 1, 2]
    if held is not None:
        assert held.count() == 3  # a plan over the old version still reads it
    if step == "create":
        assert attach_table(spark, name) and ids(spark, name) == ["0", "1", "2", "3", "4"]
    publish(spark.range(7), name)
    assert ids(spark, name) == list(range(7))
    assert attach_table(spark, name) is False


def test_versions_that_are_kept(spark, silver):
    name = f"{silver}.t"
    for n in (1, 2, 3, 4):
        overwrite_table(spark.range(n), name)
    assert Folder(spark, name).versions() == {3: True, 4: True}
    publish(spark.table(name).union(spark.table(name)), name)  # reads the table it replaces
    assert ids(spark, name) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_leftovers_of_dead_writes_go(spark, silver):
    name = f"{silver}.t"
    overwrite_table(spark.range(2), name)
    folder = Folder(spark, name)
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(folder.version(2))
    assert folder.versions() == {1: True, 2: False} and ids(spark, name) == [0, 1]
    overwrite_table(spark.range(3), name)
    assert folder.versions() == {1: True, 3: True} and ids(spark, name) == [0, 1, 2]


def test_a_catalog_that_forgot_the_table(spark, silver):
    """As after a new session over the same root: the last whole version is registered, folders of keys included."""
    name = f"{silver}.t"
    write_version(spark.range(6).select("id", (F.col("id") % 2).cast("int").alias("g")), name, partition_by=["g"])
    spark.sql(f"DROP TABLE {name}")
    assert create_table_if_missing(spark, name, CUSTOMERS_SCD2) is False
    assert ids(spark, name) == list(range(6)) and partition_columns(spark, name) == ["g"]
    write_version(spark.range(4).select("id", (F.col("id") % 2).cast("int").alias("g")), name, partition_by=["g"])
    assert ids(spark, name) == [0, 1, 2, 3]


def test_a_managed_table_becomes_versioned(spark, silver):
    name = f"{silver}.m"
    spark.range(3).write.saveAsTable(name)
    publish(spark.table(name).withColumn("id", F.col("id") + 10), name)
    assert ids(spark, name) == [10, 11, 12]
    spark.range(2).select("id", F.lit(1).alias("g")).write.partitionBy("g").saveAsTable(f"{silver}.p")
    write_version(spark.range(5).select("id", F.lit(2).alias("g")), f"{silver}.p", partition_by=["g"])
    assert ids(spark, f"{silver}.p") == [0, 1, 2, 3, 4]


def test_partitions_are_overwritten_alone(spark, silver):
    name = f"{silver}.p"
    rows = spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("g"))
    write_version(rows, name, partition_by=["g"])
    before = {f for f in spark.table(name).inputFiles() if "g=1" not in f}
    tables.overwrite_partitions(rows.where("g = 1 and id < 10"), name)
    assert sorted(r.id for r in spark.table(name).where("g = 1").collect()) == [1, 4, 7]
    assert {f for f in spark.table(name).inputFiles() if "g=1" not in f} == before
    assert spark.table(name).count() == 23


def test_columns_are_added_to_a_table(spark, silver):
    name = f"{silver}.e"
    overwrite_table(spark.createDataFrame([(1, "a")], "id long, x string"), name)
    tables.append_table(spark.createDataFrame([("b", 2, 2.5)], "X string, id long, y double"), name, evolve=True)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a", None), (2, "b", 2.5)]
    with pytest.raises(TypeError, match="is string, not bigint"):
        tables.append_table(spark.createDataFrame([(1, 2)], "id long, x long"), name, evolve=True)
    assert spark.table(name).count() == 2


def test_merge_progress_is_kept(spark, workdir):
    path = f"{workdir}/progress"
    assert merged_upto(spark, path) == -1
    record_merged(spark, path, 3)
    record_merged(spark, path, 7)
    assert merged_upto(spark, path) == 7


def test_audited_rows_equal_stored_rows_under_a_range_layout(spark, workdir):
    name = f"t{uuid.uuid4().hex[:8]}"
    df = spark.range(20000).repartition(7).select("id", (F.col("id") % 5).alias("k"))
    rows = audited_write(df, lambda d: overwrite_table(d, name), name, "WRITE", f"{workdir}/audit",
                         layout=lambda d: cluster_layout(d, ["k"]))
    assert rows == spark.table(name).count() == 20000
    spark.sql(f"DROP TABLE {name}")


def test_audit_records_of_steps_that_end_together(spark, workdir):
    path = f"{workdir}/audit"
    from tessera.sources.audit import append_audit
    threads = [threading.Thread(target=append_audit, args=(spark, path, f"t{i}", "WRITE", i)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(int(r.numOutputRows) for r in audit_history(spark, path).collect()) == list(range(8))


def test_one_writer_at_a_time(spark, workdir):
    path = f"{workdir}/meta/_writer"
    with writer_lock(spark, path) as lock:
        assert lock.holder()["owner"] == lock.own
        with pytest.raises(LockTaken, match=lock.own):
            with writer_lock(spark, path, wait_seconds=0.3):
                pass
        lock.touch()
    assert WriterLock(spark, path).holder() is None
    seen = []

    def work(n):
        with writer_lock(spark, path, wait_seconds=30):
            seen.append(("in", n))
            time.sleep(0.2)
            seen.append(("out", n))

    threads = [threading.Thread(target=work, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [a for a, _ in seen] == ["in", "out"] * 4
    assert all(seen[i][1] == seen[i + 1][1] for i in range(0, 8, 2))


def test_a_dead_holder_is_replaced(spark, workdir):
    path = f"{workdir}/meta/_writer"
    dead = WriterLock(spark, path)
    assert dead.try_take()
    time.sleep(0.3)
    assert not WriterLock(spark, path, stale_seconds=60).try_take()
    with writer_lock(spark, path, stale_seconds=0.2) as lock:
        with pytest.raises(LockTaken):
            dead.touch()
        dead.release()  # not its own any more
        assert lock.holder()["owner"] == lock.own
