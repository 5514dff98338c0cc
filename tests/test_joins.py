"""Temporal (validity-interval) join, look-up join and the daily summary."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators.joins import temporal_join
from tessera.plans.gold import build_sales_fact, build_sales_summary

TX = [("o1", "i1", 2, Decimal("3.50"), dt.datetime(2024, 2, 1, 1)),
      ("o2", "i9", 1, Decimal("1.00"), None),
      ("o3", "i1", 1, Decimal("2.00"), dt.datetime(2023, 1, 1))]
TX_SCHEMA = "order_id string, item_id string, quantity int, price decimal(10,2), order_timestamp timestamp"
VERSIONS = [(1, "c1", "A", "a@x", "EU", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1, 1)),
            (2, "c1", "A", "a@x", "EU", dt.datetime(2024, 2, 1, 1), None),
            (3, "c2", "B", "b@x", "US", dt.datetime(2024, 1, 1), None)]
V_SCHEMA = ("customer_key long, customer_id string, name string, email string, region string, "
            "start_date timestamp, end_date timestamp")


@pytest.fixture()
def tx(spark):
    return spark.createDataFrame(TX, TX_SCHEMA)


@pytest.fixture()
def versions(spark):
    return spark.createDataFrame(VERSIONS, V_SCHEMA)


@pytest.fixture()
def products(spark):
    return spark.createDataFrame([("i1", "Pen", "Office")], "item_id string, product_name string, category string")


@pytest.mark.parametrize("strategy", ["broadcast", "bucket", "auto"])
def test_unkeyed_temporal_join_fans_out(spark, tx, versions, products, strategy):
    fact = build_sales_fact(tx, versions, products, strategy=strategy, bucket_seconds=3600 * 24 * 7)
    got = sorted((r.order_id, r.customer_key, r.line_total) for r in fact.collect())
    assert got == [("o1", 2, Decimal("7.00")), ("o1", 3, Decimal("7.00")),
                   ("o2", None, Decimal("1.00")), ("o3", None, Decimal("2.00"))]


def test_summary_matches_fixture(spark, tx, versions, products):
    summary = build_sales_summary(build_sales_fact(tx, versions, products))
    rows = [tuple(r) for r in summary.collect()]
    assert rows == [
        (dt.date(2024, 2, 1), "EU", Decimal("7.00"), 2, Decimal("7.00"), 1),
        (dt.date(2024, 2, 1), "US", Decimal("7.00"), 2, Decimal("7.00"), 1),
        (dt.date(2023, 1, 1), "Unknown", Decimal("2.00"), 1, Decimal("2.00"), 1),
        (None, "Unknown", Decimal("1.00"), 1, Decimal("1.00"), 1),
    ]
    assert [f.dataType.simpleString() for f in summary.schema.fields] == \
        ["date", "string", "decimal(31,2)", "bigint", "decimal(32,2)", "bigint"]


def test_keyed_temporal_join(spark, tx, versions, products):
    keyed_tx = tx.withColumn("customer_id", F.lit("c1"))
    fact = build_sales_fact(keyed_tx, versions, products, customer_on=["customer_id"])
    got = sorted((r.order_id, r.customer_key) for r in fact.collect())
    assert got == [("o1", 2), ("o2", None), ("o3", None)]


def test_bucket_join_open_and_long_intervals(spark):
    facts = spark.createDataFrame(
        [(i, dt.datetime(2020, 1, 1) + dt.timedelta(days=i * 3)) for i in range(200)],
        "id int, ts timestamp")
    vers = spark.createDataFrame(
        [(1, dt.datetime(2019, 1, 1), None), (2, dt.datetime(2020, 3, 1), dt.datetime(2020, 3, 2)),
         (3, dt.datetime(2020, 2, 1), dt.datetime(2021, 6, 1)), (4, dt.datetime(2030, 1, 1), None)],
        "k int, s timestamp, e timestamp")
    a = temporal_join(facts, vers, "ts", "s", "e", strategy="broadcast")
    b = temporal_join(facts, vers, "ts", "s", "e", strategy="bucket", bucket_seconds=86_400 * 10)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_unkeyed_plan_is_nested_loop_with_broadcast(spark, tx, versions):
    out = temporal_join(tx, versions, "order_timestamp", "start_date", "end_date")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan


@pytest.mark.parametrize("keyed", [False, True])
def test_direct_summary_equals_fact_summary(spark, tx, versions, products, keyed):
    from tessera.plans.gold import build_sales_summary_direct
    dup_products = products.unionByName(products).unionByName(
        spark.createDataFrame([("i9", "Cup", "Home")], products.schema))
    t = tx.withColumn("customer_id", F.lit("c1")) if keyed else tx
    on = ["customer_id"] if keyed else None
    for prods in (products, dup_products):
        via_fact = build_sales_summary(build_sales_fact(t, versions, prods, customer_on=on)).collect()
        direct = build_sales_summary_direct(t, versions, prods, customer_on=on).collect()
        assert via_fact == direct


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_day = st.integers(min_value=0, max_value=60)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(facts=st.lists(st.one_of(st.none(), _day), min_size=1, max_size=12),
       versions=st.lists(st.tuples(_day, st.one_of(st.none(), st.integers(1, 30))), max_size=6),
       width=st.sampled_from([1, 3, 7, 40]))
def test_temporal_join_strategies_match_brute_force(spark, facts, versions, width):
    base = dt.datetime(2024, 1, 1)
    f_rows = [(i, None if d is None else base + dt.timedelta(days=d, hours=5)) for i, d in enumerate(facts)]
    v_rows = [(k, base + dt.timedelta(days=s), None if n is None else base + dt.timedelta(days=s + n))
              for k, (s, n) in enumerate(versions)]
    f = spark.createDataFrame(f_rows, "id int, ts timestamp")
    v = spark.createDataFrame(v_rows, "k int, s timestamp, e timestamp")
    expect = []
    for i, ts in f_rows:
        hits = [k for k, s, e in v_rows if ts is not None and s <= ts and (e is None or ts < e)]
        expect += [(i, k) for k in hits] or [(i, None)]
    for strategy in ("broadcast", "bucket"):
        out = temporal_join(f, v, "ts", "s", "e", strategy=strategy, bucket_seconds=86_400 * width)
        got = sorted(((r.id, r.k) for r in out.collect()), key=str)
        assert got == sorted(expect, key=str), strategy


def test_hot_key_is_split_by_aqe_in_keyed_temporal_join(spark):
    """A customer holding a third of the facts: with the broadcast disabled the
    keyed join is a sort-merge join, and AQE splits the hot partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))).alias("cid"),
            F.lit(dt.datetime(2024, 6, 1)).alias("ts"), "id")
        vers = spark.range(501).select(
            F.when(F.col("id") == 500, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("customer_id"),
            F.lit(dt.datetime(2024, 1, 1)).alias("s"), F.lit(None).cast("timestamp").alias("e"), F.col("id").alias("k"))
        out = temporal_join(facts, vers, "ts", "s", "e", on=[("cid", "customer_id")], max_broadcast_bytes=0)
        assert len(out.collect()) == 30000
        plan = out._jdf.queryExecution().executedPlan().toString()  # final adaptive plan
        assert "SortMergeJoin(skew=true)" in plan, plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
