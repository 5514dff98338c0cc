"""SCD2 merge: the five-step fixture, key assignment and properties."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators.keys import assign_keys, latest_per_key
from tessera.operators.scd2 import (empty_dimension, insert_missing, scd2_merge, stage_customers,
                                    staged_with_match, unchanged_versions, union_distinct)
from tessera.schemas import CUSTOMERS_RAW
from tessera.sources.feeds import as_bronze

T = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def staged(spark, pairs, now):
    rows = [(cid, f"n-{h}", None, None, h, now, None, True, now, "f.json") for cid, h in pairs]
    return spark.createDataFrame(rows, "customer_id string, name string, email string, region string, "
                                       "hash_value string, start_date timestamp, end_date timestamp, "
                                       "is_current boolean, _ingest_timestamp timestamp, "
                                       "_source_file_name string")


def table(df):
    return sorted((r.customer_key, r.customer_id, r.hash_value, r.start_date, r.end_date, r.is_current)
                  for r in df.collect())


def test_five_steps(spark):
    t1, t2, t3, t4, t5 = T[:5]
    d = scd2_merge(empty_dimension(spark), staged(spark, [("c1", "h1"), ("c2", "h2")], t1), t1).checkpoint()
    assert table(d) == [(1, "c1", "h1", t1, None, True), (2, "c2", "h2", t1, None, True)]
    d2 = scd2_merge(d, staged(spark, [("c1", "h1"), ("c2", "h2")], t2), t2).checkpoint()
    assert table(d2) == table(d)
    d3 = scd2_merge(d2, staged(spark, [("c1", "h1"), ("c2", "h2x"), ("c3", "h3")], t3), t3).checkpoint()
    assert table(d3) == [(1, "c1", "h1", t1, None, True), (2, "c2", "h2", t1, t3, False),
                         (3, "c2", "h2x", t3, None, True), (4, "c3", "h3", t3, None, True)]
    d4 = scd2_merge(d3, staged(spark, [("c1", "h1"), ("c3", "h3")], t4), t4).checkpoint()
    assert table(d4) == table(d3)
    d5 = scd2_merge(d4, staged(spark, [("c2", "h2")], t5), t5).checkpoint()
    assert table(d5) == [(1, "c1", "h1", t1, None, True), (2, "c2", "h2", t1, t3, False),
                         (3, "c2", "h2x", t3, t5, False), (4, "c3", "h3", t3, None, True),
                         (5, "c2", "h2", t5, None, True)]


def test_stage_customers_flattens_hashes_and_dedupes(spark):
    bronze = spark.createDataFrame(
        [("c1", "A", ("a@x",), "EU"), ("c2", "B", (None,), None), (None, "Z", ("z@x",), "US")],
        CUSTOMERS_RAW)
    b1 = as_bronze(bronze, "f1.json", "2024-01-01 00:00:00")
    b2 = as_bronze(bronze.filter(F.col("customer_id") == "c1").withColumn("region", F.lit("APAC")),
                   "f2.json", "2024-01-02 00:00:00")
    out = stage_customers(b1.unionByName(b2), now="2024-01-03 00:00:00")
    rows = {r.customer_id: r for r in out.collect()}
    assert set(rows) == {"c1", "c2"}
    assert rows["c1"].region == "APAC" and rows["c1"]._source_file_name == "f2.json"
    assert rows["c1"].email == "a@x" and len(rows["c1"].hash_value) == 64
    assert rows["c2"].is_current and rows["c2"].end_date is None


def test_assign_keys_dense_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(5)
    out = assign_keys(df, ["v"], "k", base=10, num_partitions=7).collect()
    assert sorted((r.v, r.k) for r in out) == [(v, v + 11) for v in range(1000)]


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 5, "c"), (2, None, "x")],
                               "k int, ts int, p string")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["ts"]).collect())
    assert got == [(1, 5, "c"), (2, None, "x")]


def test_latest_per_key_plan_combines_map_side(spark):
    df = spark.range(10000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = latest_per_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_insert_missing_union_and_match_joins(spark):
    cur = scd2_merge(empty_dimension(spark), staged(spark, [("c1", "h1"), ("c2", "h2")], T[0]), T[0])
    s2 = staged(spark, [("c1", "h1"), ("c2", "h2x"), ("c3", "h3")], T[1])
    cols = ["customer_id", "hash_value"]
    assert sorted(tuple(r) for r in insert_missing(cur.select(*cols), s2.select(*cols), ["customer_id"]).collect()) \
        == [("c1", "h1"), ("c2", "h2"), ("c3", "h3")]
    assert union_distinct(cur.select(*cols), s2.select(*cols)).count() == 4
    assert sorted((r.customer_id, r.customer_key) for r in unchanged_versions(s2, cur).collect()) == [("c1", 1)]
    matched = [(r.customer_id, r.customer_key) for r in staged_with_match(s2, cur).collect()]
    assert sorted(matched, key=str) == [("c1", 1), ("c2", None), ("c3", None)]


loads = st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]),
                                    st.sampled_from(["h1", "h2", "h3"])),
                          max_size=4, unique_by=lambda p: p[0]),
                 min_size=1, max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(loads)
def test_scd2_properties(spark, sequence):
    dim = empty_dimension(spark)
    for i, load in enumerate(sequence):
        dim = scd2_merge(dim, staged(spark, load, T[i]), T[i]).checkpoint()
        rows = dim.collect()
        keys = [r.customer_key for r in rows]
        assert sorted(keys) == list(range(1, len(keys) + 1))  # dense and unique
        by_id = {}
        for r in rows:
            by_id.setdefault(r.customer_id, []).append(r)
        for versions in by_id.values():
            assert sum(v.is_current for v in versions) == 1
            versions.sort(key=lambda v: v.start_date)
            for a, b in zip(versions, versions[1:]):
                assert a.end_date == b.start_date  # intervals tile
            assert versions[-1].end_date is None
        current = {r.customer_id: r.hash_value for r in rows if r.is_current}
        for cid, h in load:
            assert current[cid] == h
    again = scd2_merge(dim, staged(spark, sequence[-1], T[8]), T[8])
    assert table(again) == table(dim)  # replaying the last load changes nothing


def test_assign_keys_spreads_a_hot_value(spark):
    # a third of the rows share one order value
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("v"),
                                  F.col("id"))
    out = assign_keys(df, ["v"], "k", num_partitions=6)
    rows = out.collect()
    assert sorted(r.k for r in rows) == list(range(1, 3001))
    by_key = sorted(rows, key=lambda r: r.k)
    assert [r.v for r in by_key] == sorted(r.v for r in rows)  # keys follow the order column
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1000  # the 1,000 rows with v=7 are not in one task


def test_assign_keys_default_partitioning_keeps_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(9)
    out = assign_keys(df, ["v"], "k", base=3).collect()
    assert sorted((r.v, r.k) for r in out) == [(v, v + 4) for v in range(5000)]


def test_null_ids_are_rejected_not_merged(spark):
    from tessera.operators.scd2 import rejected_customers
    bronze = as_bronze(spark.createDataFrame(
        [("c1", "A", ("a@x",), "EU"), (None, "Z", ("z@x",), "US")], CUSTOMERS_RAW), "f.json")
    staged_rows = stage_customers(bronze, now="2024-01-01 00:00:00")
    dim = scd2_merge(empty_dimension(spark), staged_rows)
    assert [r.customer_id for r in dim.collect()] == ["c1"]
    assert [r.name for r in rejected_customers(bronze).collect()] == ["Z"]
