"""Table schemas of the layered model (raw feeds, bronze, silver, gold, audit)."""

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampType)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Names and types of this module are the tables' contract.
# Raw feeds: every field lands as string; typing happens in silver.
TRANSACTIONS_RAW = _strings("order_id", "item_id", "quantity", "price",
                            "order_timestamp", "corrupted_flag")
PRODUCTS_RAW = _strings("item_id", "product_name", "category")
CUSTOMERS_RAW = StructType([
    StructField("customer_id", StringType(), True),
    StructField("name", StringType(), True),
    StructField("contact", StructType([StructField("email", StringType(), True)]), True),
    StructField("region", StringType(), True),
])

RESCUE_COL = "_rescue"
INGEST_TS_COL = "_ingest_timestamp"
SOURCE_FILE_COL = "_source_file_name"
BATCH_COL = "_batch_id"

LINEAGE = [StructField(INGEST_TS_COL, TimestampType(), True),
           StructField(SOURCE_FILE_COL, StringType(), True)]


def bronze_schema(raw: StructType) -> StructType:
    return StructType(list(raw.fields) + [StructField(RESCUE_COL, StringType(), True)] + LINEAGE)


SILVER_TRANSACTIONS = StructType([
    StructField("order_id", StringType(), True),
    StructField("item_id", StringType(), True),
    StructField("quantity", IntegerType(), True),
    StructField("price", DecimalType(10, 2), True),
    StructField("order_timestamp", TimestampType(), True),
] + LINEAGE)

CUSTOMERS_SCD2 = StructType([
    StructField("customer_key", LongType(), True),
    StructField("customer_id", StringType(), True),
    StructField("name", StringType(), True),
    StructField("email", StringType(), True),
    StructField("region", StringType(), True),
    StructField("hash_value", StringType(), True),
    StructField("start_date", TimestampType(), True),
    StructField("end_date", TimestampType(), True),
    StructField("is_current", BooleanType(), True),
] + LINEAGE)

SALES_FACT_COLUMNS = ["order_id", "order_date", "item_id", "product_name", "product_category",
                      "customer_key", "customer_id", "customer_name", "customer_email", "region",
                      "quantity", "price", "line_total", "order_timestamp"]

SALES_SUMMARY = StructType([
    StructField("order_date", DateType(), True),
    StructField("region", StringType(), True),
    StructField("total_revenue", DecimalType(31, 2), True),
    StructField("total_units_sold", LongType(), True),
    StructField("avg_order_value", DecimalType(32, 2), True),
    StructField("orders_count", LongType(), False),
])

AUDIT = StructType([
    StructField("timestamp", TimestampType(), True),
    StructField("userName", StringType(), True),
    StructField("operation", StringType(), True),
    StructField("jobRunId", StringType(), True),
    StructField("notebookId", StringType(), True),
    StructField("numOutputRows", StringType(), True),
    StructField("table_name", StringType(), True),
    StructField("batch_id", LongType(), True),
    StructField("status", StringType(), True),
    StructField("error_message", StringType(), True),
])
