"""Registered queries: one per operator, each over the whole testdata tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle in ``tessera.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

import dataclasses
import uuid

from tessera.functions import clean
from tessera.operators import distinct_state, joins, keys, layout, rejects, scd2
from tessera.plans import gold, retail, scenarios
from tessera.plans.gold import build_sales_fact
from tessera.plans.runner import PipelineConfig, run_pipeline
from tessera.plans.silver import build_products, build_transactions
from tessera.schemas import CUSTOMERS_RAW, PRODUCTS_RAW
from tessera.session import configure_session, scratch_dir, stored
from tessera.sources import feeds, tables
from tessera.sources.audit import audit_history, audited_write, latest_audit
from tessera.sources.tables import append_table, create_layers, overwrite_table
from tessera.streaming.ingest import FeedSpec, ingest, read_bronze

Query = Callable[[SparkSession, str], DataFrame]


def q_clean_title_case(spark, sf_dir):
    return feeds.products_raw(spark, sf_dir).select(
        "item_id", clean.title_case("product_name").alias("product_name"))


def q_clean_timestamp_utc(spark, sf_dir):
    return (feeds.order_timestamps(spark, sf_dir)
            .select("order_id", clean.parse_zoned_timestamp("order_timestamp").alias("order_timestamp")))


def q_clean_currency_decimal(spark, sf_dir):
    raw = feeds.transactions_raw(spark, sf_dir, with_line=True)
    return raw.select("order_id", "line_number",
                      clean.to_money(clean.strip_currency("price")).alias("price"))


def q_clean_digits_int(spark, sf_dir):
    raw = feeds.transactions_raw(spark, sf_dir, with_line=True)
    return raw.select("order_id", "line_number",
                      clean.to_int(clean.digits_only("quantity")).alias("quantity"))


def q_filter_corrupt(spark, sf_dir):
    raw = feeds.transactions_raw(spark, sf_dir, with_line=True)
    return clean.drop_corrupt(raw, "corrupted_flag").select("order_id", "line_number", "corrupted_flag")


def q_change_hash(spark, sf_dir):
    staged = scd2.stage_customers(feeds.as_bronze(feeds.customers_raw(spark, sf_dir), "c.json"),
                                  now=retail.FIRST_LOAD)
    return staged.select("customer_id", "hash_value")


def q_silver_transactions(spark, sf_dir):
    return retail.silver_transactions(spark, sf_dir)


def q_silver_products(spark, sf_dir):
    return retail.silver_products(spark, sf_dir)


def _staged(spark, sf_dir, second: bool):
    feed = feeds.customers_changed(spark, sf_dir) if second else feeds.customers_raw(spark, sf_dir)
    name = "customers_2.json" if second else "customers_1.json"
    t = retail.CUSTOMER_CHANGE if second else retail.FIRST_LOAD
    return scd2.stage_customers(feeds.as_bronze(feed, name), now=t)


def _initial_dim(spark, sf_dir):
    return scd2.scd2_merge(scd2.empty_dimension(spark), _staged(spark, sf_dir, False)).checkpoint()


def q_scd2_initial(spark, sf_dir):
    return _initial_dim(spark, sf_dir)


def q_scd2_second_load(spark, sf_dir):
    return scd2.scd2_merge(_initial_dim(spark, sf_dir), _staged(spark, sf_dir, True))


def q_scd2_noop_reload(spark, sf_dir):
    staged = scd2.stage_customers(
        feeds.as_bronze(feeds.customers_raw(spark, sf_dir), "customers_1.json"),
        now=retail.CUSTOMER_CHANGE)
    return scd2.scd2_merge(_initial_dim(spark, sf_dir), staged)


_STAGED_COLS = ["customer_id", "name", "email", "region", "hash_value"]


def q_insert_missing(spark, sf_dir):
    target = _staged(spark, sf_dir, False).select(*_STAGED_COLS)
    source = _staged(spark, sf_dir, True).select(*_STAGED_COLS)
    return scd2.insert_missing(target, source, ["customer_id"])


def q_union_distinct(spark, sf_dir):
    return scd2.union_distinct(_staged(spark, sf_dir, False).select(*_STAGED_COLS),
                               _staged(spark, sf_dir, True).select(*_STAGED_COLS))


def q_join_unchanged(spark, sf_dir):
    out = scd2.unchanged_versions(_staged(spark, sf_dir, True), _initial_dim(spark, sf_dir))
    return out.select("customer_key", *_STAGED_COLS)


def q_join_left_staged(spark, sf_dir):
    out = scd2.staged_with_match(_staged(spark, sf_dir, True), _initial_dim(spark, sf_dir))
    return out.select("customer_key", *_STAGED_COLS)


def _orders_ts(spark, sf_dir):
    return feeds.table(spark, sf_dir, "orders", spread=True).select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("order_ts"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_price"))


def _temporal_unkeyed(spark, sf_dir, strategy):
    dim = retail.nation_dimension(spark, sf_dir).select(
        "customer_key", "region", "start_date", "end_date")
    orders = _orders_ts(spark, sf_dir)
    # Each order meets half of all versions: its pairs stay together, so that its distinct count needs no shuffle of them.
    orders = orders.repartition(joins.fan_out_parts(orders, 512 << 10), "o_orderkey")
    pairs = joins.temporal_join(orders, dim, "order_ts", "start_date", "end_date",
                                how="left", strategy=strategy, bucket_seconds=86_400 * 30)
    return pairs.groupBy("customer_key", "region").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_distinct("o_orderkey").alias("orders"),
        F.sum("total_price").alias("total_price"),
        F.min("order_ts").alias("first_ts"),
        F.max("order_ts").alias("last_ts"))


def q_temporal_join_unkeyed(spark, sf_dir):
    return _temporal_unkeyed(spark, sf_dir, "broadcast")


def q_temporal_join_bucketed(spark, sf_dir):
    return _temporal_unkeyed(spark, sf_dir, "bucket")


def q_temporal_join_keyed(spark, sf_dir):
    orders = _orders_ts(spark, sf_dir).join(
        feeds.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("cust")),
        "o_orderkey")
    dim = retail.customer_dimension(spark, sf_dir).select(
        "customer_key", "customer_id", "region", "start_date", "end_date")
    out = joins.temporal_join(orders, dim, "order_ts", "start_date", "end_date",
                              on=[("cust", "customer_id")], how="left")
    return out.select("o_orderkey", "customer_key", "customer_id", "region")


def q_lookup_product(spark, sf_dir):
    tx = retail.silver_transactions(spark, sf_dir).select("order_id", "item_id", "quantity")
    pr = retail.silver_products(spark, sf_dir).select(
        "item_id", "product_name", F.col("category").alias("product_category"))
    return joins.lookup_join(tx, pr, "item_id", "left")


def q_sales_fact(spark, sf_dir):
    fact = retail.sales_fact(spark, sf_dir)
    return fact.groupBy("customer_key", "region", "product_category").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.sum("line_total").alias("revenue"),
        F.sum("quantity").alias("units"))


def q_sales_summary(spark, sf_dir):
    return retail.sales_summary(spark, sf_dir)


def q_sales_summary_via_fact(spark, sf_dir):
    return retail.sales_summary_via_fact(spark, sf_dir)


def q_sales_fact_keyed(spark, sf_dir):
    return retail.sales_fact(spark, sf_dir, keyed=True)


def q_sales_summary_keyed(spark, sf_dir):
    return retail.sales_summary(spark, sf_dir, keyed=True)


def q_latest_per_key(spark, sf_dir):
    return keys.latest_per_key(feeds.table(spark, sf_dir, "events", spread=True), ["user_id"],
                               ["ts", "event_id"])


def q_top1_latest(spark, sf_dir):
    orders = feeds.table(spark, sf_dir, "orders")
    return (orders.orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
            .limit(1).select("o_orderkey", "o_orderdate"))


def q_assign_keys(spark, sf_dir):
    part = feeds.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return keys.assign_keys(part, ["p_name", "p_partkey"], "part_key", base=1000)


def _ingest_twice(spark, spec: FeedSpec) -> DataFrame:
    """Drain the landing folder, then run again (no new file: nothing added)."""
    ingest(spark, spec)
    ingest(spark, spec)
    return read_bronze(spark, spec.target_path)


def q_ingest_csv_rescue(spark, sf_dir):
    root = scratch_dir(spark, "csv")
    scenarios.write_product_layouts(spark, sf_dir, f"{root}/landing")
    spec = FeedSpec("products", f"{root}/landing", PRODUCTS_RAW, "csv", f"{root}/bronze",
                    f"{root}/checkpoint", options={"recursiveFileLookup": "true"})
    return _ingest_twice(spark, spec).select("item_id", "product_name", "category", "_rescue")


def q_ingest_json_rescue(spark, sf_dir):
    root = scratch_dir(spark, "json")
    scenarios.write_customer_variants(spark, sf_dir, f"{root}/landing")
    spec = FeedSpec("customers", f"{root}/landing", CUSTOMERS_RAW, "json", f"{root}/bronze",
                    f"{root}/checkpoint", options={"recursiveFileLookup": "true"})
    bronze = _ingest_twice(spark, spec)
    return bronze.select("customer_id", "name", F.col("contact.email").alias("email"), "region",
                         "_rescue")


def q_stream_append_once(spark, sf_dir):
    root = scratch_dir(spark, "events")
    scenarios.write_events_csv(spark, sf_dir, f"{root}/landing")
    names = feeds.table(spark, sf_dir, "events").columns
    schema = StructType([StructField(n, StringType(), True) for n in names])
    spec = FeedSpec("events", f"{root}/landing", schema, "csv", f"{root}/bronze", f"{root}/checkpoint",
                    max_files_per_trigger=3)
    bronze = _ingest_twice(spark, spec)
    return bronze.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("user_id").alias("users"),
        F.sum(F.col("value").try_cast("decimal(12,2)")).alias("value_sum"),
        F.count_distinct("_batch_id").alias("batches"))


def _product_writes(spark, sf_dir):
    """Three audited writes: products overwrite, products append, category counts."""
    root = scratch_dir(spark, "tables")
    layer = create_layers(spark, root=f"{root}/warehouse", prefix=f"t{uuid.uuid4().hex[:8]}_")
    audit = f"{root}/meta/history"
    products = build_products(feeds.as_bronze(feeds.products_raw(spark, sf_dir), "products_raw.csv"))
    table = f"{layer['silver']}.products"
    audited_write(products, lambda d: overwrite_table(d, table), "silver.products",
                  "CREATE OR REPLACE TABLE", audit)
    audited_write(products, lambda d: append_table(d, table), "silver.products", "WRITE", audit)
    counts_t = f"{layer['gold']}.category_counts"
    counts = spark.table(table).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    audited_write(counts, lambda d: overwrite_table(d, counts_t), "gold.category_counts",
                  "CREATE OR REPLACE TABLE", audit)
    return table, audit


def q_overwrite_append_table(spark, sf_dir):
    table, _ = _product_writes(spark, sf_dir)
    return spark.table(table).select("item_id", "product_name", "category")


def q_audit_after_writes(spark, sf_dir):
    _, audit = _product_writes(spark, sf_dir)
    return audit_history(spark, audit).groupBy("table_name", "operation", "status").agg(
        F.count(F.lit(1)).alias("writes"),
        F.sum(F.col("numOutputRows").cast("bigint")).alias("rows"))


def q_latest_audit(spark, sf_dir):
    _, audit = _product_writes(spark, sf_dir)
    return latest_audit(audit_history(spark, audit)).select("table_name", "operation", "numOutputRows")


def q_medallion_two_runs(spark, sf_dir):
    """Files -> bronze -> silver -> SCD2 -> fact -> summary, run twice: the
    second run lands a changed customer file only."""
    root = scratch_dir(spark, "pipeline")
    landing = f"{root}/landing"
    scenarios.write_retail_landing(spark, sf_dir, landing, customers="nation")
    cfg = PipelineConfig(root=f"{root}/lake", landing=landing, prefix=f"p{uuid.uuid4().hex[:8]}_",
                         now=retail.FIRST_LOAD)
    run_pipeline(spark, cfg)
    scenarios.write_retail_landing(spark, sf_dir, landing, customers="nation", changed=True,
                                   transactions=False, products=False)
    run_pipeline(spark, dataclasses.replace(cfg, now=retail.NATION_CHANGE))
    return spark.table(f"{cfg.prefix}gold.daily_sales_summary")


class _Interrupted(RuntimeError):
    pass


def q_medallion_restart(spark, sf_dir):
    """As ``medallion_two_runs``, but every run is interrupted at one step after the other and begun again."""
    root = scratch_dir(spark, "restart")
    landing = f"{root}/landing"
    cfg = PipelineConfig(root=f"{root}/lake", landing=landing, prefix=f"r{uuid.uuid4().hex[:8]}_",
                         now=retail.FIRST_LOAD)

    def until(step: str, after: bool):
        def hook(name: str, done: bool) -> None:
            if name.endswith(step) and done == after:
                raise _Interrupted(name)
        return hook

    def interrupted(config: PipelineConfig, stops) -> None:
        for step, after in stops:
            try:
                run_pipeline(spark, dataclasses.replace(config, on_step=until(step, after)))
            except _Interrupted:
                continue
            raise AssertionError(f"the run did not come to {step}")
        run_pipeline(spark, config)

    scenarios.write_retail_landing(spark, sf_dir, landing, customers="nation")
    interrupted(cfg, [("silver.customers_scd2", False), ("silver.transactions", True), ("gold.daily_sales_fact", False)])
    scenarios.write_retail_landing(spark, sf_dir, landing, customers="nation", changed=True,
                                   transactions=False, products=False)
    interrupted(dataclasses.replace(cfg, now=retail.NATION_CHANGE),
                [("silver.customers_scd2", True), ("gold.daily_sales_summary", False)])
    return spark.table(f"{cfg.prefix}gold.daily_sales_summary")


def q_medallion_customers(spark, sf_dir):
    """The whole customer table through the pipeline, keyed; the second run writes only the order dates
    that its customer changes touch."""
    root = scratch_dir(spark, "customers")
    landing = f"{root}/landing"
    scenarios.write_retail_landing(spark, sf_dir, landing, customers="customer", with_customer=True)
    cfg = PipelineConfig(root=f"{root}/lake", landing=landing, prefix=f"c{uuid.uuid4().hex[:8]}_",
                         now=retail.FIRST_LOAD, customer_on=["customer_id"], fact_mode="changes")
    run_pipeline(spark, cfg)
    scenarios.write_retail_landing(spark, sf_dir, landing, customers="customer", changed=True,
                                   transactions=False, products=False)
    run_pipeline(spark, dataclasses.replace(cfg, now=retail.CUSTOMER_CHANGE))
    return spark.table(f"{cfg.prefix}gold.daily_sales_summary")


def q_audit_matches_tables(spark, sf_dir):
    """Audited and stored rows of each kind of write: laid out, in folders, appended, published, evolved."""
    root = scratch_dir(spark, "counts")
    layer = create_layers(spark, root=f"{root}/warehouse", prefix=f"t{uuid.uuid4().hex[:8]}_")
    audit = f"{root}/meta/history"
    products = build_products(feeds.as_bronze(feeds.products_raw(spark, sf_dir), "products_raw.csv"))
    silver = layer["silver"]

    def clustered(d):
        return tables.cluster_layout(d, ["category", "item_id"])

    def by_folder(d):
        return tables.partition_layout(d, ["category"], ["item_id"])

    kinds = {
        "clustered": [(lambda d, t: overwrite_table(d, t), clustered)],
        "partitioned": [(lambda d, t: tables.write_version(d, t, partition_by=["category"]), by_folder)],
        "interleaved": [(lambda d, t: overwrite_table(d, t),
                         lambda d: layout.interleaved_layout(d, ["category", "product_name", "item_id"]))],
        "append": [(lambda d, t: tables.create_or_append(d, t), clustered)] * 2,
        "append_partitioned": [(lambda d, t: tables.create_or_append(d, t, partition_by=["category"]), by_folder)] * 2,
        "publish": [(lambda d, t: overwrite_table(d, t), None),
                    (lambda d, t: tables.publish(d, t), None)],
        "dynamic": [(lambda d, t: tables.write_version(d, t, partition_by=["category"]), by_folder),
                    (lambda d, t: tables.overwrite_partitions(d, t), by_folder)],
    }
    stored_rows = None
    for kind, writes in kinds.items():
        table = f"{silver}.{kind}"
        for how, laid_out in writes:
            audited_write(products, lambda d, how=how, table=table: how(d, table), kind, "WRITE", audit, layout=laid_out)
        rows = spark.table(table).select(F.lit(kind).alias("kind"), "item_id")
        stored_rows = rows if stored_rows is None else stored_rows.unionByName(rows)
    stored_rows = stored_rows.groupBy("kind").agg(F.count(F.lit(1)).alias("stored_rows"),
                                                  F.count_distinct("item_id").alias("items"))
    audited = audit_history(spark, audit).groupBy(F.col("table_name").alias("kind")).agg(
        F.sum(F.col("numOutputRows").cast("bigint")).alias("audited_rows"), F.count(F.lit(1)).alias("writes"))
    return audited.join(stored_rows, "kind")


def _customers_with_rejects(spark, sf_dir):
    """The customer feed, every 17th without an id, and per nation one document that cannot be read."""
    good = feeds.as_bronze(feeds.customers_raw(spark, sf_dir), "customers_1.json")
    key = F.col("customer_id").cast("long")
    good = good.withColumn("customer_id", F.when(key % 17 == 4, None).otherwise(F.col("customer_id")))
    bad = feeds.as_bronze(feeds.table(spark, sf_dir, "nation").select(
        F.lit(None).cast("string").alias("customer_id"), F.col("n_name").alias("name"),
        F.lit(None).cast(CUSTOMERS_RAW["contact"].dataType).alias("contact"), F.lit(None).cast("string").alias("region")),
        "broken.json")
    rescue = F.to_json(F.struct(F.concat(F.lit("{"), F.col("name")).alias("_corrupt_record")))
    return good.unionByName(bad.withColumn("_rescue", rescue))


def q_rejected_customers(spark, sf_dir):
    split = rejects.split_rows(_customers_with_rejects(spark, sf_dir), scd2.customer_reject_reasons(),
                               f"{scratch_dir(spark, 'rejects')}/customers")
    staged = scd2.stage_customers(split.accepted, now=retail.FIRST_LOAD).select(
        F.lit("accepted").alias("outcome"), "customer_id", "name")
    out = split.rejected.select(F.array_join(rejects.REASONS_COL, ", ").alias("outcome"), "customer_id", "name")
    counts = {"accepted": split.accepted_rows, **split.by_reason}
    told = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    return staged.unionByName(out).withColumn("counted", told[F.col("outcome")].cast("long"))


def q_scd2_initial_start(spark, sf_dir):
    """New customers begin long before their load, changed ones at it."""
    dim = scd2.scd2_merge(scd2.empty_dimension(spark), _staged(spark, sf_dir, False), initial_start="1980-01-01 00:00:00")
    dim = stored(dim, "dimension")
    return scd2.scd2_merge(dim, _staged(spark, sf_dir, True), initial_start="1980-01-01 00:00:00").select(
        "customer_key", "customer_id", "name", "start_date", "end_date", "is_current")


def q_scd2_repeated_ids(spark, sf_dir):
    """A load that names every customer twice, the later record with the changed name, merged without staging's own dedupe."""
    old = feeds.as_bronze(feeds.customers_raw(spark, sf_dir), "customers_1.json", "2024-01-01 00:00:00")
    new = feeds.as_bronze(feeds.customers_changed(spark, sf_dir), "customers_2.json", "2024-01-02 00:00:00")
    twice = scd2.stage_customers(old.unionByName(new), now=retail.CUSTOMER_CHANGE, dedupe=False)
    return scd2.scd2_merge(_initial_dim(spark, sf_dir), twice).select(
        "customer_key", "customer_id", "name", "hash_value", "start_date", "end_date", "is_current")


def q_scd2_default_now(spark, sf_dir):
    """Without a load time one is taken per load: a version that ends and the one that follows share it."""
    staged = scd2.stage_customers(feeds.as_bronze(feeds.customers_changed(spark, sf_dir), "customers_2.json"))
    dim = scd2.scd2_merge(_initial_dim(spark, sf_dir), staged)
    recent = F.abs(F.unix_seconds("start_date") - F.unix_seconds(F.current_timestamp())) < 3600
    return dim.agg(F.count_if(recent & F.col("is_current")).alias("opened"),
                   F.count_if(F.col("end_date").isNotNull()).alias("closed"),
                   F.count_distinct(F.coalesce(F.col("end_date"), F.when(recent, F.col("start_date")))).alias("times"))


def q_sales_fact_dedupe(spark, sf_dir):
    """Products and transactions sent twice, counted once."""
    first = feeds.as_bronze(feeds.products_raw(spark, sf_dir), "products_1.csv", "2024-01-01 00:00:00")
    again = feeds.as_bronze(feeds.products_raw(spark, sf_dir).withColumn("category", F.upper("category")),
                            "products_2.csv", "2024-01-02 00:00:00")
    raw = feeds.transactions_raw(spark, sf_dir, with_customer=True)
    sent = feeds.as_bronze(raw, "transactions_1.csv").unionByName(feeds.as_bronze(raw, "transactions_2.csv"))
    fact = build_sales_fact(build_transactions(sent, extra_columns=["customer_id"]),
                            retail.customer_dimension(spark, sf_dir), build_products(first.unionByName(again)),
                            customer_on=["customer_id"],
                            dedupe_keys={"transactions": ["order_id", "item_id", "quantity", "price"],
                                         "products": ["item_id"]})
    return fact.groupBy("customer_key", "product_category").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units"))


def _new_table(spark, name):
    root = scratch_dir(spark, name)
    layer = create_layers(spark, root=f"{root}/warehouse", prefix=f"t{uuid.uuid4().hex[:8]}_")
    return f"{layer['silver']}.{name}"


def q_append_evolved(spark, sf_dir):
    """Two batches of different fields in one table."""
    table = _new_table(spark, "parts")
    part = feeds.table(spark, sf_dir, "part")
    overwrite_table(part.where("p_size <= 25").select("p_partkey", "p_name", "p_type"), table)
    append_table(part.where("p_size > 25 OR p_size IS NULL").select("p_brand", "p_partkey", "p_type", "p_size"), table,
                 evolve=True)
    return spark.table(table)


def q_insert_positional(spark, sf_dir):
    table = _new_table(spark, "positions")
    part = feeds.table(spark, sf_dir, "part")
    overwrite_table(part.select(F.col("p_name").alias("a"), F.col("p_type").alias("b")), table)
    tables.insert_into(part.select(F.col("p_brand").alias("b"), F.col("p_name").alias("a")), table)
    return spark.table(table)


def q_create_or_append(spark, sf_dir):
    table = _new_table(spark, "appended")
    part = feeds.table(spark, sf_dir, "part").select("p_partkey", "p_type")
    done = [tables.create_or_append(part, table, ["p_type", "p_partkey"]) for _ in range(2)]
    return spark.table(table).withColumn("operations", F.lit(", ".join(done)))


def q_lineage_columns(spark, sf_dir):
    """What the ingest adds to each row: load time, file, batch."""
    root = scratch_dir(spark, "lineage")
    scenarios.write_events_csv(spark, sf_dir, f"{root}/landing")
    names = feeds.table(spark, sf_dir, "events").columns
    schema = StructType([StructField(n, StringType(), True) for n in names])
    spec = FeedSpec("events", f"{root}/landing", schema, "csv", f"{root}/bronze", f"{root}/checkpoint")
    ingest(spark, spec, now="2024-05-06 07:08:09")
    bronze = read_bronze(spark, spec.target_path)
    in_landing = F.col("_source_file_name").contains(f"{root}/landing/") & F.col("_source_file_name").endswith(".csv")
    return bronze.groupBy("_ingest_timestamp", "_batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(in_landing).alias("with_file"),
        F.count_distinct("_source_file_name").alias("files"))


def q_summary_first_page(spark, sf_dir):
    """The first 200 lines of the report in its order: latest day first, regions by name."""
    return retail.sales_summary(spark, sf_dir).limit(200)


def q_temporal_join_indexed(spark, sf_dir):
    """Lines on their way on each day that has orders: every line item is a version (a day in transit per
    unit), far more than 10,000."""
    days = feeds.table(spark, sf_dir, "orders").groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("orders"))
    lines = feeds.table(spark, sf_dir, "lineitem", spread=True).select(
        F.col("l_quantity").cast("decimal(12,2)").alias("l_quantity"), F.col("l_shipdate").cast("timestamp").alias("shipped"),
        F.date_add("l_shipdate", F.col("l_quantity").cast("int")).cast("timestamp").alias("received"))
    found = joins.temporal_join(days.withColumn("day", F.col("o_orderdate").cast("timestamp")), lines, "day", "shipped",
                                "received", strategy="index")
    return found.groupBy("o_orderdate", "orders").agg(F.count("shipped").alias("lines"),
                                                      F.sum("l_quantity").alias("quantity"))


def q_sales_summary_state(spark, sf_dir):
    """The daily summary from a state that two feeds were merged into; the first feed is not read again.

    Orders have lines in both feeds, so their distinct count cannot be added up."""
    raw = feeds.transactions_raw(spark, sf_dir, with_customer=True, with_line=True)
    dim, products = retail.customer_dimension(spark, sf_dir), retail.silver_products(spark, sf_dir)
    groups, sums = ["order_date", "region"], ["line_total", "quantity"]
    numbers, state = distinct_state.empty_numbers(spark, "order_id", "order_no"), None
    for part in (F.col("line_number") % 2 == 1, F.col("line_number") % 2 == 0):
        lines = build_transactions(feeds.as_bronze(raw.where(part), "t.csv"), extra_columns=["customer_id"])
        fact = stored(build_sales_fact(lines, dim, products, customer_on=["customer_id"])
                      .select("order_id", *groups, "line_total", F.col("quantity").cast("long").alias("quantity")), "feed")
        numbers = stored(distinct_state.number_new(numbers, fact, "order_id", "order_no", ["order_date"]), "numbers")
        new = distinct_state.state_of(fact, numbers, groups, "order_id", "order_no", sums)
        state = stored(new if state is None else distinct_state.merged(state, new, groups, sums), "state")
    return gold.summary_of_counts(distinct_state.counted(state, groups, sums, "orders_count"))


QUERIES: dict[str, Query] = {
    "clean_title_case": q_clean_title_case,
    "clean_timestamp_utc": q_clean_timestamp_utc,
    "clean_currency_decimal": q_clean_currency_decimal,
    "clean_digits_int": q_clean_digits_int,
    "filter_corrupt": q_filter_corrupt,
    "change_hash": q_change_hash,
    "silver_transactions": q_silver_transactions,
    "silver_products": q_silver_products,
    "scd2_initial": q_scd2_initial,
    "scd2_second_load": q_scd2_second_load,
    "scd2_noop_reload": q_scd2_noop_reload,
    "insert_missing": q_insert_missing,
    "union_distinct": q_union_distinct,
    "join_unchanged": q_join_unchanged,
    "join_left_staged": q_join_left_staged,
    "temporal_join_unkeyed": q_temporal_join_unkeyed,
    "temporal_join_bucketed": q_temporal_join_bucketed,
    "temporal_join_keyed": q_temporal_join_keyed,
    "lookup_product": q_lookup_product,
    "sales_fact": q_sales_fact,
    "sales_summary": q_sales_summary,
    "sales_summary_via_fact": q_sales_summary_via_fact,
    "sales_fact_keyed": q_sales_fact_keyed,
    "sales_summary_keyed": q_sales_summary_keyed,
    "latest_per_key": q_latest_per_key,
    "top1_latest": q_top1_latest,
    "assign_keys": q_assign_keys,
    "ingest_csv_rescue": q_ingest_csv_rescue,
    "ingest_json_rescue": q_ingest_json_rescue,
    "stream_append_once": q_stream_append_once,
    "overwrite_append_table": q_overwrite_append_table,
    "audit_after_writes": q_audit_after_writes,
    "latest_audit": q_latest_audit,
    "medallion_two_runs": q_medallion_two_runs,
    "medallion_restart": q_medallion_restart,
    "medallion_customers": q_medallion_customers,
    "audit_matches_tables": q_audit_matches_tables,
    "rejected_customers": q_rejected_customers,
    "scd2_initial_start": q_scd2_initial_start,
    "scd2_repeated_ids": q_scd2_repeated_ids,
    "scd2_default_now": q_scd2_default_now,
    "sales_fact_dedupe": q_sales_fact_dedupe,
    "append_evolved": q_append_evolved,
    "insert_positional": q_insert_positional,
    "create_or_append": q_create_or_append,
    "lineage_columns": q_lineage_columns,
    "summary_first_page": q_summary_first_page,
    "temporal_join_indexed": q_temporal_join_indexed,
    "sales_summary_state": q_sales_summary_state,
}


def registered() -> dict[str, Query]:
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure_session(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {name: wrap(fn) for name, fn in QUERIES.items()}
