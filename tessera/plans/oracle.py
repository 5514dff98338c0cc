"""DuckDB oracle SQL for the registered queries (same column names and types).

The feeds are re-derived in SQL from the same parquet tables; the expected
cleaning results are written directly (e.g. the zone offset as hours) so the
oracle does not share code paths with the Spark side.
"""

from __future__ import annotations

# -- shared CTE bodies --------------------------------------------------------

_TX_JOIN = """
tx_j AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         o.o_custkey, o.o_orderdate, o.o_orderstatus, o.o_orderkey,
         l.l_orderkey * 8 + l.l_linenumber AS n
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_UTC_TS = """o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)
      + CASE o_orderkey % 6 WHEN 0 THEN 8 WHEN 1 THEN 7 WHEN 2 THEN 5 WHEN 3 THEN 4 WHEN 4 THEN 0 END)
      + to_minutes(15)"""

_SILVER_TX = f"""
{_TX_JOIN},
silver_tx AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CASE WHEN n % 97 = 0 THEN 'X' || CAST(l_partkey AS VARCHAR) ELSE CAST(l_partkey AS VARCHAR) END AS item_id,
         CASE WHEN n % 50 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         CASE WHEN n % 60 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(10,2)) END AS price,
         CAST({_UTC_TS} AS TIMESTAMP) AS order_timestamp,
         TIMESTAMP '2024-01-01 00:00:00' AS _ingest_timestamp,
         'transactions_raw.csv' AS _source_file_name,
         CAST(o_custkey AS VARCHAR) AS customer_id
  FROM tx_j
  WHERE o_orderstatus IS DISTINCT FROM 'P')"""

_TITLE = "array_to_string(list_transform(string_split(lower({0}), ' '), lambda x: upper(x[1]) || x[2:]), ' ')"

_SILVER_PRODUCTS = f"""
silver_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS item_id, {_TITLE.format('p_name')} AS product_name,
         p_type AS category, TIMESTAMP '2024-01-01 00:00:00' AS _ingest_timestamp,
         'products_raw.csv' AS _source_file_name
  FROM part)"""

_CUSTOMERS = """
cust AS (
  SELECT c.c_custkey AS k, CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS name,
         CASE WHEN c.c_custkey % 11 = 5 THEN NULL ELSE lower(c.c_name) || '@example.com' END AS email,
         CASE WHEN c.c_custkey % 13 = 6 THEN NULL ELSE r.r_name END AS region
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
cust2 AS (
  SELECT k, customer_id, CASE WHEN k % 7 = 3 THEN name || ' Jr' ELSE name END AS name, email, region FROM cust
  UNION ALL
  SELECT s.s_suppkey, 'N' || CAST(s.s_suppkey AS VARCHAR), s.s_name, lower(s.s_name) || '@example.com', r.r_name
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
staged1 AS (
  SELECT customer_id, name, email, region, sha256(concat_ws('|', name, email, region)) AS hash_value FROM cust),
staged2 AS (
  SELECT customer_id, name, email, region, sha256(concat_ws('|', name, email, region)) AS hash_value FROM cust2)"""

_DIM_COLS = ("customer_key, customer_id, name, email, region, hash_value, start_date, end_date, "
             "is_current, _ingest_timestamp, _source_file_name")

_DIM1 = f"""
{_CUSTOMERS},
dim1 AS (
  SELECT CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS customer_key,
         customer_id, name, email, region, hash_value,
         TIMESTAMP '1990-01-01 00:00:00' AS start_date, CAST(NULL AS TIMESTAMP) AS end_date,
         true AS is_current, TIMESTAMP '2024-01-01 00:00:00' AS _ingest_timestamp,
         'customers_1.json' AS _source_file_name
  FROM staged1)"""

_DIM2 = f"""
{_DIM1},
fresh2 AS (
  SELECT s.* FROM staged2 s
  WHERE NOT EXISTS (SELECT 1 FROM dim1 d WHERE d.customer_id = s.customer_id AND d.hash_value = s.hash_value)),
dim2 AS (
  SELECT d.customer_key, d.customer_id, d.name, d.email, d.region, d.hash_value, d.start_date,
         CASE WHEN f.customer_id IS NOT NULL THEN TIMESTAMP '1998-06-01 00:00:00' ELSE d.end_date END AS end_date,
         f.customer_id IS NULL AS is_current, d._ingest_timestamp, d._source_file_name
  FROM dim1 d LEFT JOIN fresh2 f ON d.customer_id = f.customer_id
  UNION ALL
  SELECT CAST((SELECT max(customer_key) FROM dim1) + row_number() OVER (ORDER BY customer_id) AS BIGINT),
         customer_id, name, email, region, hash_value, TIMESTAMP '1998-06-01 00:00:00',
         CAST(NULL AS TIMESTAMP), true, TIMESTAMP '2024-01-01 00:00:00', 'customers_2.json'
  FROM fresh2)"""

_NATION_DIM = """
nat AS (
  SELECT n.n_nationkey AS k, 'NAT' || CAST(n.n_nationkey AS VARCHAR) AS customer_id, n.n_name AS name,
         lower(n.n_name) || '@example.com' AS email, r.r_name AS region,
         n.n_name || ' II' AS name2,
         CASE WHEN n.n_nationkey % 2 = 0 THEN r2.r_name ELSE r.r_name END AS region2
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
       LEFT JOIN region r2 ON (r.r_regionkey + 1) % 5 = r2.r_regionkey),
ndim AS (
  SELECT CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS customer_key, customer_id,
         name, email, region, TIMESTAMP '1990-01-01 00:00:00' AS start_date,
         TIMESTAMP '1998-01-01 00:00:00' AS end_date
  FROM nat
  UNION ALL
  SELECT CAST(25 + row_number() OVER (ORDER BY customer_id) AS BIGINT), customer_id, name2, email,
         region2, TIMESTAMP '1998-01-01 00:00:00', CAST(NULL AS TIMESTAMP)
  FROM nat)"""

_PRODUCTS_FOR_FACT = f"""
{_SILVER_PRODUCTS},
prod AS (SELECT item_id, product_name, category AS product_category FROM silver_products)"""

_FACT_UNKEYED = f"""
WITH {_SILVER_TX}, {_NATION_DIM}, {_PRODUCTS_FOR_FACT},
fact AS (
  SELECT t.order_id, CAST(t.order_timestamp AS DATE) AS order_date, t.item_id, p.product_name,
         p.product_category, d.customer_key, d.customer_id, d.name AS customer_name,
         d.email AS customer_email, d.region, t.quantity, t.price,
         CAST(t.quantity * t.price AS DECIMAL(21,2)) AS line_total, t.order_timestamp
  FROM silver_tx t
  LEFT JOIN ndim d ON t.order_timestamp >= d.start_date
                  AND (d.end_date IS NULL OR t.order_timestamp < d.end_date)
  LEFT JOIN prod p ON t.item_id = p.item_id)"""

_FACT_KEYED = f"""
WITH {_SILVER_TX}, {_DIM2[1:]}, {_PRODUCTS_FOR_FACT},
fact AS (
  SELECT t.order_id, CAST(t.order_timestamp AS DATE) AS order_date, t.item_id, p.product_name,
         p.product_category, d.customer_key, d.customer_id, d.name AS customer_name,
         d.email AS customer_email, d.region, t.quantity, t.price,
         CAST(t.quantity * t.price AS DECIMAL(21,2)) AS line_total, t.order_timestamp
  FROM silver_tx t
  LEFT JOIN dim2 d ON t.customer_id = d.customer_id AND t.order_timestamp >= d.start_date
                  AND (d.end_date IS NULL OR t.order_timestamp < d.end_date)
  LEFT JOIN prod p ON t.item_id = p.item_id)"""

_FACT_COLS = ("order_id, order_date, item_id, product_name, product_category, customer_key, "
              "customer_id, customer_name, customer_email, region, quantity, price, line_total, "
              "order_timestamp")

# Exact half-up rounding of revenue / orders to cents, without a DOUBLE step.
_SUMMARY = """
SELECT order_date, coalesce(region, 'Unknown') AS region,
       CAST(sum(line_total) AS DECIMAL(31,2)) AS total_revenue,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       CAST(CAST(CASE WHEN sum(line_total) >= 0
                      THEN (2 * CAST(sum(line_total) * 100 AS HUGEINT) + count(DISTINCT order_id))
                           // (2 * count(DISTINCT order_id))
                      ELSE -((2 * CAST(-sum(line_total) * 100 AS HUGEINT) + count(DISTINCT order_id))
                           // (2 * count(DISTINCT order_id))) END AS DECIMAL(38,0))
            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(32,2)) AS avg_order_value,
       CAST(count(DISTINCT order_id) AS BIGINT) AS orders_count
FROM fact GROUP BY order_date, region"""

_TEMPORAL_UNKEYED = f"""
WITH {_NATION_DIM[1:]},
o AS (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS order_ts,
             CAST(o_totalprice AS DECIMAL(12,2)) AS total_price FROM orders)
SELECT d.customer_key, d.region, CAST(count(*) AS BIGINT) AS pairs,
       CAST(count(DISTINCT o.o_orderkey) AS BIGINT) AS orders,
       CAST(sum(o.total_price) AS DECIMAL(22,2)) AS total_price,
       min(o.order_ts) AS first_ts, max(o.order_ts) AS last_ts
FROM o LEFT JOIN ndim d ON o.order_ts >= d.start_date AND (d.end_date IS NULL OR o.order_ts < d.end_date)
GROUP BY d.customer_key, d.region"""

_STAGED_COLS = "customer_id, name, email, region, hash_value"

ORACLE: dict[str, str] = {
    "clean_title_case": f"""
SELECT CAST(p_partkey AS VARCHAR) AS item_id, {_TITLE.format('p_name')} AS product_name FROM part""",

    "clean_timestamp_utc": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST({_UTC_TS} AS TIMESTAMP) AS order_timestamp
FROM orders""",

    "clean_currency_decimal": f"""
WITH {_TX_JOIN[1:]}
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_number,
       CASE WHEN n % 60 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(10,2)) END AS price
FROM tx_j""",

    "clean_digits_int": f"""
WITH {_TX_JOIN[1:]}
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_number,
       CASE WHEN n % 50 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS quantity
FROM tx_j""",

    "filter_corrupt": f"""
WITH {_TX_JOIN[1:]}
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_number,
       CASE WHEN o_orderstatus = 'F' THEN 'N' END AS corrupted_flag
FROM tx_j WHERE o_orderstatus <> 'P'""",

    "change_hash": f"""
WITH {_CUSTOMERS[1:]}
SELECT customer_id, hash_value FROM staged1""",

    "silver_transactions": f"""
WITH {_SILVER_TX[1:]}
SELECT order_id, item_id, quantity, price, order_timestamp, _ingest_timestamp, _source_file_name
FROM silver_tx""",

    "silver_products": f"""
WITH {_SILVER_PRODUCTS[1:]}
SELECT item_id, product_name, category, _ingest_timestamp, _source_file_name FROM silver_products""",

    "scd2_initial": f"""
WITH {_DIM1[1:]}
SELECT {_DIM_COLS} FROM dim1""",

    "scd2_second_load": f"""
WITH {_DIM2[1:]}
SELECT {_DIM_COLS} FROM dim2""",

    "scd2_noop_reload": f"""
WITH {_DIM1[1:]}
SELECT {_DIM_COLS} FROM dim1""",

    "insert_missing": f"""
WITH {_CUSTOMERS[1:]}
SELECT {_STAGED_COLS} FROM staged1
UNION ALL
SELECT {_STAGED_COLS} FROM staged2 s
WHERE NOT EXISTS (SELECT 1 FROM staged1 t WHERE t.customer_id = s.customer_id)""",

    "union_distinct": f"""
WITH {_CUSTOMERS[1:]}
SELECT {_STAGED_COLS} FROM staged1
UNION
SELECT {_STAGED_COLS} FROM staged2""",

    "join_unchanged": f"""
WITH {_DIM1[1:]}
SELECT d.customer_key, s.customer_id, s.name, s.email, s.region, s.hash_value
FROM staged2 s JOIN dim1 d ON s.hash_value = d.hash_value AND s.customer_id = d.customer_id
WHERE d.is_current""",

    "join_left_staged": f"""
WITH {_DIM1[1:]}
SELECT d.customer_key, s.customer_id, s.name, s.email, s.region, s.hash_value
FROM staged2 s LEFT JOIN (SELECT * FROM dim1 WHERE is_current) d
  ON s.hash_value = d.hash_value AND s.customer_id = d.customer_id""",

    "temporal_join_unkeyed": _TEMPORAL_UNKEYED,
    "temporal_join_bucketed": _TEMPORAL_UNKEYED,

    "temporal_join_keyed": f"""
WITH {_DIM2[1:]}
SELECT o.o_orderkey, d.customer_key, d.customer_id, d.region
FROM orders o LEFT JOIN dim2 d
  ON CAST(o.o_custkey AS VARCHAR) = d.customer_id
 AND CAST(o.o_orderdate AS TIMESTAMP) >= d.start_date
 AND (d.end_date IS NULL OR CAST(o.o_orderdate AS TIMESTAMP) < d.end_date)""",

    "lookup_product": f"""
WITH {_SILVER_TX[1:]}, {_PRODUCTS_FOR_FACT[1:]}
SELECT t.item_id, t.order_id, t.quantity, p.product_name, p.product_category
FROM silver_tx t LEFT JOIN prod p ON t.item_id = p.item_id""",

    "sales_fact": f"""{_FACT_UNKEYED}
SELECT customer_key, region, product_category, CAST(count(*) AS BIGINT) AS fact_rows,
       CAST(sum(line_total) AS DECIMAL(31,2)) AS revenue, CAST(sum(quantity) AS BIGINT) AS units
FROM fact GROUP BY customer_key, region, product_category""",

    "sales_summary": f"{_FACT_UNKEYED}{_SUMMARY}",
    "sales_summary_via_fact": f"{_FACT_UNKEYED}{_SUMMARY}",

    "sales_fact_keyed": f"""{_FACT_KEYED}
SELECT {_FACT_COLS} FROM fact""",

    "sales_summary_keyed": f"{_FACT_KEYED}{_SUMMARY}",

    "latest_per_key": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
         event_id DESC NULLS LAST, event_type DESC NULLS LAST, value DESC NULLS LAST,
         props DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1""",

    "top1_latest": """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""",

    "assign_keys": """
SELECT p_partkey, p_name, CAST(1000 + row_number() OVER (ORDER BY p_name, p_partkey) AS BIGINT) AS part_key
FROM part""",

    "ingest_csv_rescue": """
SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS product_name,
       CASE WHEN p_size BETWEEN 24 AND 29 OR p_size BETWEEN 36 AND 45 THEN NULL ELSE p_type END AS category,
       CASE WHEN p_size BETWEEN 17 AND 23 THEN '{"color":"' || p_brand || '"}'
            WHEN p_size BETWEEN 30 AND 35 THEN '{"_c3":"' || p_brand || '","_c4":"' || p_size || '"}'
            WHEN p_size BETWEEN 41 AND 45 THEN '{"_c2":"' || p_size || '","product_name_3":"' || p_brand || '"}'
            WHEN p_size > 45 THEN '{"_meta_file":"' || p_size || '","_rescue":"' || p_brand || '"}' END AS _rescue
FROM part""",

    "ingest_json_rescue": f"""
WITH {_CUSTOMERS[1:]},
seg AS (SELECT c_custkey, c_mktsegment FROM customer)
SELECT c.customer_id, c.name,
       CASE WHEN c.k % 4 IN (0, 1) THEN c.email END AS email,
       CASE WHEN c.k % 4 = 3 THEN NULL ELSE c.region END AS region,
       CASE WHEN c.k % 4 = 1 THEN '{{"contact":{{"phone":"555-' || c.customer_id || '"}},"tier":"'
                                  || s.c_mktsegment || '"}}'
            WHEN c.k % 4 = 2 THEN '{{"contact":"oops"}}' END AS _rescue
FROM cust c JOIN seg s ON c.k = s.c_custkey""",

    "stream_append_once": """
SELECT event_type, CAST(count(*) AS BIGINT) AS events, CAST(count(DISTINCT user_id) AS BIGINT) AS users,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS value_sum, CAST(3 AS BIGINT) AS batches
FROM events GROUP BY event_type""",

    "overwrite_append_table": f"""
WITH {_SILVER_PRODUCTS[1:]}
SELECT item_id, product_name, category FROM silver_products
UNION ALL
SELECT item_id, product_name, category FROM silver_products""",

    "audit_after_writes": """
SELECT 'silver.products' AS table_name, 'CREATE OR REPLACE TABLE' AS operation, 'SUCCESS' AS status,
       CAST(1 AS BIGINT) AS writes, CAST(count(*) AS BIGINT) AS rows FROM part
UNION ALL
SELECT 'silver.products', 'WRITE', 'SUCCESS', CAST(1 AS BIGINT), CAST(count(*) AS BIGINT) FROM part
UNION ALL
SELECT 'gold.category_counts', 'CREATE OR REPLACE TABLE', 'SUCCESS', CAST(1 AS BIGINT),
       CAST(count(DISTINCT p_type) AS BIGINT) FROM part""",

    "latest_audit": """
SELECT 'gold.category_counts' AS table_name, 'CREATE OR REPLACE TABLE' AS operation,
       CAST(count(DISTINCT p_type) AS VARCHAR) AS numOutputRows FROM part""",

    "medallion_two_runs": f"{_FACT_UNKEYED}{_SUMMARY}",
    "medallion_restart": f"{_FACT_UNKEYED}{_SUMMARY}",
    "medallion_customers": f"{_FACT_KEYED}{_SUMMARY}",
    "sales_summary_state": f"{_FACT_KEYED}{_SUMMARY}",

    "audit_matches_tables": """
WITH n AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT p_partkey) AS BIGINT) AS items FROM part),
k(kind, writes, copies) AS (VALUES ('clustered', 1, 1), ('partitioned', 1, 1), ('interleaved', 1, 1), ('append', 2, 2),
  ('append_partitioned', 2, 2), ('publish', 2, 1), ('dynamic', 2, 1))
SELECT kind, CAST(writes AS BIGINT) AS writes, CAST(writes * n AS BIGINT) AS audited_rows,
       CAST(copies * n AS BIGINT) AS stored_rows, items FROM k, n""",

    "rejected_customers": f"""
WITH {_CUSTOMERS[1:]},
out AS (
  SELECT CASE WHEN k % 17 = 4 THEN 'no customer_id' ELSE 'accepted' END AS outcome,
         CASE WHEN k % 17 <> 4 THEN customer_id END AS customer_id, name FROM cust
  UNION ALL SELECT 'unreadable document', NULL, n_name FROM nation)
SELECT outcome, customer_id, name, CAST(count(*) OVER (PARTITION BY outcome) AS BIGINT) AS counted FROM out""",

    "scd2_initial_start": f"""
WITH {_DIM2[1:]}
SELECT customer_key, customer_id, name,
       CASE WHEN start_date < TIMESTAMP '1998-06-01 00:00:00' OR customer_id NOT IN (SELECT customer_id FROM dim1)
            THEN TIMESTAMP '1980-01-01 00:00:00' ELSE start_date END AS start_date, end_date, is_current
FROM dim2""",

    "scd2_repeated_ids": f"""
WITH {_DIM2[1:]}
SELECT customer_key, customer_id, name, hash_value, start_date, end_date, is_current FROM dim2""",

    "scd2_default_now": f"""
WITH {_DIM2[1:]}
SELECT CAST(count(*) FILTER (start_date >= TIMESTAMP '1998-06-01 00:00:00') AS BIGINT) AS opened,
       CAST(count(*) FILTER (end_date IS NOT NULL) AS BIGINT) AS closed, CAST(1 AS BIGINT) AS times
FROM dim2""",

    "sales_fact_dedupe": f"""{_FACT_KEYED.replace("FROM silver_tx t", "FROM (SELECT DISTINCT order_id, item_id, quantity, price, order_timestamp, customer_id FROM silver_tx) t")}
SELECT customer_key, upper(product_category) AS product_category, CAST(count(*) AS BIGINT) AS fact_rows,
       CAST(sum(line_total) AS DECIMAL(31,2)) AS revenue, CAST(sum(quantity) AS BIGINT) AS units
FROM fact GROUP BY 1, 2""",

    "append_evolved": """
SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_name END AS p_name, p_type,
       CASE WHEN p_size > 25 THEN p_brand END AS p_brand, CASE WHEN p_size > 25 THEN p_size END AS p_size
FROM part""",

    "insert_positional": """
SELECT p_name AS a, p_type AS b FROM part UNION ALL SELECT p_brand, p_name FROM part""",

    "create_or_append": """
SELECT p_partkey, p_type, 'CREATE TABLE AS SELECT, WRITE' AS operations FROM part
UNION ALL SELECT p_partkey, p_type, 'CREATE TABLE AS SELECT, WRITE' FROM part""",

    "lineage_columns": """
SELECT TIMESTAMP '2024-05-06 07:08:09' AS _ingest_timestamp, CAST(0 AS BIGINT) AS _batch_id,
       CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS with_file, CAST(8 AS BIGINT) AS files FROM events""",

    "summary_first_page": f"{_FACT_UNKEYED}{_SUMMARY} ORDER BY order_date DESC, region LIMIT 200",

    "temporal_join_indexed": """
WITH d AS (SELECT o_orderdate, CAST(count(*) AS BIGINT) AS orders FROM orders GROUP BY 1)
SELECT o_orderdate, orders, CAST(count(l_shipdate) AS BIGINT) AS lines,
       CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS quantity
FROM d LEFT JOIN lineitem ON o_orderdate >= l_shipdate AND o_orderdate < l_shipdate + to_days(CAST(l_quantity AS INTEGER))
GROUP BY 1, 2""",
}
