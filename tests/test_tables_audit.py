"""Catalog tables, publish swap, audited writes and the audit read-back."""

import uuid

import pytest
from pyspark.sql import functions as F

from tessera.sources.audit import audit_history, audited_write, latest_audit
from tessera.sources.tables import (create_layers, create_or_append, create_table_if_missing,
                                    publish, table_exists)
from tessera.schemas import CUSTOMERS_SCD2


@pytest.fixture()
def layers(spark, workdir):
    return create_layers(spark, root=f"{workdir}/wh", prefix=f"t{uuid.uuid4().hex[:6]}_")


def test_layers_and_create_if_missing(spark, layers):
    name = f"{layers['silver']}.customers_scd2"
    assert create_table_if_missing(spark, name, CUSTOMERS_SCD2)
    assert not create_table_if_missing(spark, name, CUSTOMERS_SCD2)
    assert spark.table(name).schema == CUSTOMERS_SCD2


def test_publish_replaces_table_read_by_itself(spark, layers):
    name = f"{layers['silver']}.t"
    spark.range(3).write.saveAsTable(name)
    publish(spark.table(name).withColumn("id", F.col("id") + 10), name)
    publish(spark.table(name).withColumn("id", F.col("id") + 10), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [20, 21, 22]
    assert not table_exists(spark, f"{name}__next")


def test_create_or_append(spark, layers):
    name = f"{layers['gold']}.fact"
    df = spark.range(5).select(F.col("id").alias("k"), (F.col("id") % 2).alias("g"))
    assert create_or_append(df, name, ["g", "k"]) == "CREATE TABLE AS SELECT"
    assert create_or_append(df.select("g", "k"), name, ["g", "k"]) == "WRITE"
    assert spark.table(name).count() == 10


def test_audited_write_counts_and_failures(spark, layers, workdir):
    audit = f"{workdir}/history"
    name = f"{layers['silver']}.p"
    n = audited_write(spark.range(7), lambda d: d.write.saveAsTable(name), "silver.p", "WRITE", audit)
    assert n == 7
    with pytest.raises(Exception):
        audited_write(spark.range(3), lambda d: d.write.saveAsTable(name), "silver.p", "WRITE", audit)
    hist = audit_history(spark, audit)
    rows = sorted((r.status, r.numOutputRows) for r in hist.collect())
    assert rows == [("FAILED", None), ("SUCCESS", "7")]
    last = latest_audit(hist).collect()[0]
    assert last.status == "FAILED" and last.error_message
    assert set(hist.columns) >= {"timestamp", "userName", "operation", "jobRunId", "notebookId",
                                 "numOutputRows", "table_name", "batch_id", "status", "error_message"}


def test_write_partitioned_overwrites_and_prunes(spark, layers):
    from tessera.sources.tables import write_partitioned
    name = f"{layers['gold']}.f"
    df = spark.range(20).select((F.col("id") % 4).alias("d"), (F.col("id") % 3).alias("c"), "id")
    write_partitioned(df, name, ["d"], ["c", "id"])
    write_partitioned(df.filter("d > 1"), name, ["d"], ["c", "id"])  # full replace, not per partition
    assert sorted({r.d for r in spark.table(name).collect()}) == [2, 3]
    plan = spark.table(name).filter("d = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_create_or_append_partitioned(spark, layers):
    name = f"{layers['gold']}.fa"
    df = spark.range(6).select((F.col("id") % 2).alias("g"), F.col("id").alias("k"))
    assert create_or_append(df, name, ["g", "k"], partition_by=["g"]) == "CREATE TABLE AS SELECT"
    assert create_or_append(df, name, ["g", "k"], partition_by=["g"]) == "WRITE"
    assert spark.table(name).count() == 12


def test_insert_into_is_positional(spark, layers):
    from tessera.sources.tables import current_catalog, insert_into
    name = f"{layers['silver']}.pos"
    spark.createDataFrame([("a", "b")], "x string, y string").write.saveAsTable(name)
    insert_into(spark.createDataFrame([("c", "d")], "y string, x string"), name)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("a", "b"), ("c", "d")]
    assert current_catalog(spark) == "spark_catalog"
