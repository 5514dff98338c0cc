"""End-to-end retail plans over the driver's testdata (feeds -> silver -> gold).

The customer dimensions are built with the same SCD2 merge a pipeline run
uses, with fixed load times so results are reproducible:

* nation dimension: 25 nation-level customers loaded at 1990-01-01, all
  renamed (even nations also moved region) at 1998-01-01 -> 50 versions.
  Used for the unkeyed temporal join: every transaction meets 25 versions.
* customer dimension: every customer loaded at 1990-01-01, a changed feed
  (1 in 7 renamed, every supplier as a new id) loaded at 1998-06-01.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.scd2 import empty_dimension, scd2_merge, stage_customers
from tessera.plans.gold import build_sales_fact, build_sales_summary, build_sales_summary_direct
from tessera.plans.silver import build_products, build_transactions
from tessera.sources import feeds

# Fixed load times of the derived dimensions.
FIRST_LOAD = "1990-01-01 00:00:00"
NATION_CHANGE = "1998-01-01 00:00:00"
CUSTOMER_CHANGE = "1998-06-01 00:00:00"


def silver_transactions(spark: SparkSession, sf_dir: str, with_customer: bool = False) -> DataFrame:
    bronze = feeds.as_bronze(feeds.transactions_raw(spark, sf_dir, with_customer),
                             "transactions_raw.csv")
    return build_transactions(bronze, extra_columns=["customer_id"] if with_customer else ())


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_products(feeds.as_bronze(feeds.products_raw(spark, sf_dir), "products_raw.csv"))


def two_load_dimension(spark: SparkSession, first: DataFrame, second: DataFrame,
                       t1: str, t2: str) -> DataFrame:
    dim1 = scd2_merge(empty_dimension(spark), stage_customers(feeds.as_bronze(first, "customers_1.json"), t1))
    dim1 = dim1.checkpoint(eager=True)
    dim2 = scd2_merge(dim1, stage_customers(feeds.as_bronze(second, "customers_2.json"), t2))
    # A pipeline writes the dimension as a table; cut the lineage the same way
    # so readers (fact build, size checks) do not rerun both merges.
    return dim2.checkpoint(eager=True)


def nation_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_load_dimension(spark, feeds.nation_customers(spark, sf_dir),
                              feeds.nation_customers(spark, sf_dir, changed=True),
                              FIRST_LOAD, NATION_CHANGE)


def customer_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_load_dimension(spark, feeds.customers_raw(spark, sf_dir),
                              feeds.customers_changed(spark, sf_dir),
                              FIRST_LOAD, CUSTOMER_CHANGE)


def sales_fact(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    if keyed:
        return build_sales_fact(silver_transactions(spark, sf_dir, with_customer=True),
                                customer_dimension(spark, sf_dir), silver_products(spark, sf_dir),
                                customer_on=["customer_id"])
    return build_sales_fact(silver_transactions(spark, sf_dir), nation_dimension(spark, sf_dir),
                            silver_products(spark, sf_dir))


def sales_summary(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """Daily summary without materialising the fact (eager aggregation)."""
    if keyed:
        return build_sales_summary_direct(silver_transactions(spark, sf_dir, with_customer=True),
                                          customer_dimension(spark, sf_dir),
                                          silver_products(spark, sf_dir), customer_on=["customer_id"])
    return build_sales_summary_direct(silver_transactions(spark, sf_dir), nation_dimension(spark, sf_dir),
                                      silver_products(spark, sf_dir))


def sales_summary_via_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily summary aggregated from the full (unkeyed) fact."""
    return build_sales_summary(sales_fact(spark, sf_dir))
