"""Raw retail feeds derived from the driver's TPC-H-like parquet tables.

Deterministic, no randomness: noise, bad values and orphans are injected by
key arithmetic so every engine can recompute the same rows.  All derivations
are DataFrame plans over the whole input tables.

Mapping (feed column <- testdata):

* transactions: one row per lineitem; order_id/item_id from l_orderkey /
  l_partkey (every 97th line gets an unknown item 'X<partkey>'); quantity as
  text ('7', '7 pcs', every 50th empty); price '$1,234.56' from
  l_extendedprice (every 60th 'n/a'); order_timestamp = order date, hour
  ``o_orderkey % 24``, minute 15, zone by ``o_orderkey % 6`` from
  PST PDT EST EDT Z CST (CST does not parse), a leading space for every 5th
  order; corrupted_flag from o_orderstatus P->'Y', O->NULL, F->'N'.
* products: p_partkey, p_name (every 3rd upper-cased), p_type.
* customers: c_custkey, c_name, contact.email = lower(c_name)@example.com
  (NULL for custkey % 11 == 5), region = r_name via nation (NULL for
  custkey % 13 == 6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import INGEST_TS_COL, RESCUE_COL, SOURCE_FILE_COL

# Zones cycled by o_orderkey % 6, in this order.
FEED_ZONES = ["PST", "PDT", "EST", "EDT", "Z", "CST"]
# Fixed lineage timestamp for feeds that do not come from a file stream.
FEED_INGEST_TS = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """One testdata table.  ``spread``: the driver writes each table as a
    single parquet file with one row group, which Spark reads in one task;
    for the large tables, round-robin the rows over the default parallelism
    when there are fewer files than that (a no-op for inputs that already
    come in many files)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        target = spark.sparkContext.defaultParallelism
        if len(df.inputFiles()) < target:
            df = df.repartition(target)
    return df


def _line_no() -> F.Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def order_timestamp_text(orderkey: str = "o_orderkey", orderdate: str = "o_orderdate") -> F.Column:
    """'yyyy-MM-dd HH:15:00 <zone>' with HH = key % 24, zone by key % 6,
    and a leading space for every 5th key."""
    key = F.col(orderkey)
    zone = F.element_at(F.array(*[F.lit(z) for z in FEED_ZONES]), (key % 6 + 1).cast("int"))
    ts = F.concat(F.date_format(orderdate, "yyyy-MM-dd"), F.lit(" "),
                  F.lpad((key % 24).cast("string"), 2, "0"), F.lit(":15:00 "), zone)
    return F.when(key % 5 == 0, F.concat(F.lit(" "), ts)).otherwise(ts)


def order_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: order_id and its zoned timestamp text."""
    od = table(spark, sf_dir, "orders", spread=True)
    return od.select(F.col("o_orderkey").cast("string").alias("order_id"),
                     order_timestamp_text().alias("order_timestamp"))


def transactions_raw(spark: SparkSession, sf_dir: str, with_customer: bool = False,
                     with_line: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", spread=True).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    n = _line_no()
    qty = F.col("l_quantity").cast("int").cast("string")
    cols = [
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(n % 97 == 0, F.concat(F.lit("X"), F.col("l_partkey").cast("string")))
         .otherwise(F.col("l_partkey").cast("string")).alias("item_id"),
        F.when(n % 50 == 0, F.lit(""))
         .when(n % 3 == 0, F.concat(qty, F.lit(" pcs")))
         .otherwise(qty).alias("quantity"),
        F.when(n % 60 == 0, F.lit("n/a"))
         .otherwise(F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))).alias("price"),
        order_timestamp_text().alias("order_timestamp"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Y"))
         .when(F.col("o_orderstatus") == "F", F.lit("N")).alias("corrupted_flag"),
    ]
    if with_customer:
        cols.append(F.col("o_custkey").cast("string").alias("customer_id"))
    if with_line:
        cols.append(F.col("l_linenumber").alias("line_number"))
    return j.select(*cols)


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
         .alias("product_name"),
        F.col("p_type").alias("category"))


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region name.  Both tables have a fixed size whatever the
    scale factor (25 and 5 rows by the TPC-H definition), which is the bound
    that makes broadcasting them safe."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey) \
                 .select("n_nationkey", "n_name", "r_regionkey", "r_name")


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    c = c.join(F.broadcast(customer_regions(spark, sf_dir)),
               c.c_nationkey == F.col("n_nationkey"), "left")
    email = F.concat(F.lower("c_name"), F.lit("@example.com"))
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.struct(F.when(F.col("c_custkey") % 11 == 5, F.lit(None).cast("string"))
                  .otherwise(email).alias("email")).alias("contact"),
        F.when(F.col("c_custkey") % 13 == 6, F.lit(None).cast("string"))
         .otherwise(F.col("r_name")).alias("region"))


def customers_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later customer feed: every customer re-sent, 1 in 7 with a new name,
    plus every supplier arriving as a new customer 'N<suppkey>'."""
    base = customers_raw(spark, sf_dir).withColumn("_k", F.col("customer_id").cast("long"))
    resent = base.withColumn("name", F.when(F.col("_k") % 7 == 3, F.concat("name", F.lit(" Jr")))
                             .otherwise(F.col("name"))).drop("_k")
    s = table(spark, sf_dir, "supplier")
    s = s.join(F.broadcast(customer_regions(spark, sf_dir)), s.s_nationkey == F.col("n_nationkey"), "left")
    new = s.select(
        F.concat(F.lit("N"), F.col("s_suppkey").cast("string")).alias("customer_id"),
        F.col("s_name").alias("name"),
        F.struct(F.concat(F.lower("s_name"), F.lit("@example.com")).alias("email")).alias("contact"),
        F.col("r_name").alias("region"))
    return resent.unionByName(new)


def as_bronze(raw: DataFrame, source_file: str, ingest_ts: str = FEED_INGEST_TS) -> DataFrame:
    """Bronze shape for a feed that did not come through file ingest."""
    return (raw.withColumn(RESCUE_COL, F.lit(None).cast("string"))
            .withColumn(INGEST_TS_COL, F.to_timestamp(F.lit(ingest_ts)))
            .withColumn(SOURCE_FILE_COL, F.lit(source_file)))


def nation_customers(spark: SparkSession, sf_dir: str, changed: bool = False) -> DataFrame:
    """Nation-level customer feed (25 rows): id 'NAT<k>', name, email, region.

    ``changed``: the later feed, every nation renamed and even nations moved
    to the next region, so every nation gets a second version.
    """
    n = customer_regions(spark, sf_dir)
    region = table(spark, sf_dir, "region")
    name = F.col("n_name")
    region_name = F.col("r_name")
    if changed:
        nxt = region.select(F.col("r_regionkey").alias("_rk"), F.col("r_name").alias("_next"))
        n = n.join(F.broadcast(nxt), (F.col("r_regionkey") + 1) % 5 == F.col("_rk"), "left")
        name = F.concat(name, F.lit(" II"))
        region_name = F.when(F.col("n_nationkey") % 2 == 0, F.col("_next")).otherwise(region_name)
    return n.select(
        F.concat(F.lit("NAT"), F.col("n_nationkey").cast("string")).alias("customer_id"),
        name.alias("name"),
        F.struct(F.concat(F.lower("n_name"), F.lit("@example.com")).alias("email")).alias("contact"),
        region_name.alias("region"))
