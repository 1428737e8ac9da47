"""The test tables seen as the library's entities.

Every mapping is one SELECT that both engines read the same way, with base
tables in braces. Spark runs it to feed the library; the SQL check puts it in
front of the expected result. ``raw_*`` entities are text with flaws written
in (blank cells, words for numbers, prices of zero, padded status, two
batches), so that casts, filters and de-duplication have work to do; all rows
of the table pass through.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NBSP = " "

_TWO_BATCHES = "(SELECT *, 1 AS n FROM {{{t}}} UNION ALL SELECT *, 2 AS n FROM {{{t}}}) AS b"
_STAMP = """
    CASE n WHEN 1 THEN '2024-01-01T00:00:00+00:00' ELSE '2024-02-01T00:00:00+00:00' END AS _loaded_at,
    '{file}' AS _source_file,
    CASE n WHEN 1 THEN 'first' ELSE 'second' END AS _batch_id"""
_ONE_STAMP = """
    '2024-01-01T00:00:00+00:00' AS _loaded_at,
    '{file}' AS _source_file,
    'first' AS _batch_id"""


def _two(table: str) -> str:
    return _TWO_BATCHES.format(t=table)


ENTITIES: dict[str, str] = {
    "shop_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END
        AS order_status,
    o_orderdate AS order_purchase_timestamp
FROM {orders}""",
    "shop_orders_with_delivery": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END
        AS order_status,
    o_orderdate AS order_purchase_timestamp,
    delivered AS order_delivered_customer_date,
    o_orderdate + INTERVAL 60 DAY AS order_estimated_delivery_date
FROM {orders}
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS delivered FROM {lineitem} GROUP BY l_orderkey) AS s
    ON l_orderkey = o_orderkey""",
    "shop_customers": """
SELECT c_custkey AS customer_id, CAST(floor(c_custkey / 2) AS BIGINT) AS customer_unique_id,
    c_mktsegment AS customer_city, n_name AS customer_state
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey""",
    "shop_items": """
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
    l_linenumber AS order_item_id, l_extendedprice AS price,
    floor(l_extendedprice * l_tax * 100 + 0.5) / 100 AS freight_value,
    l_extendedprice + floor(l_extendedprice * l_tax * 100 + 0.5) / 100 AS total_item_value
FROM {lineitem}""",
    "shop_products": """
SELECT p_partkey AS product_id, p_type AS product_category_name_english FROM {part}""",
    "shop_sellers": """
SELECT s_suppkey AS seller_id, s_name AS seller_city, n_name AS seller_state
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey""",
    "shop_payments": """
SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
    CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE ' Voucher ' END
        AS payment_type,
    l_extendedprice AS payment_value
FROM {lineitem}""",
    "shop_reviews": """
SELECT o_orderkey AS review_id, o_orderkey AS order_id,
    CAST(substring(o_orderpriority, 1, 1) AS INT) AS review_score,
    text AS review_comment_message
FROM {orders} LEFT JOIN {documents} ON doc_id = o_orderkey""",
    "raw_orders": f"""
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS order_id,
    CASE WHEN o_orderkey % 103 = 0 AND n = 2 THEN NULL ELSE CAST(o_custkey AS STRING) END AS customer_id,
    CASE WHEN n = 1 THEN ' Shipped{NBSP}'
         WHEN o_orderstatus = 'F' THEN 'DELIVERED ' WHEN o_orderstatus = 'O' THEN 'shipped'
         ELSE '{NBSP} Canceled' END AS order_status,
    CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN 'soon'
         WHEN o_orderkey % 13 = 0 THEN '2017' ELSE CAST(o_orderdate AS STRING) END
        AS order_purchase_timestamp,
    CAST(o_orderdate AS STRING) || '+01:00' AS order_approved_at,
    CAST(o_orderdate + INTERVAL 3 DAY AS STRING) AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 9 DAY AS STRING) ELSE '' END
        AS order_delivered_customer_date,
    CAST(CAST(o_orderdate + INTERVAL 20 DAY AS DATE) AS STRING) AS order_estimated_delivery_date,
    {_STAMP.format(file="orders.csv")}
FROM {_two("orders")}""",
    "raw_customers": f"""
SELECT CAST(c_custkey AS STRING) AS customer_id,
    CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING) END
        AS customer_unique_id,
    ' 0' || CAST(c_nationkey AS STRING) || '{NBSP}' AS customer_zip_code_prefix,
    '  ' || c_mktsegment || CASE n WHEN 1 THEN ' Old' ELSE '{NBSP}' END AS customer_city,
    lower(c_name) || ' ' AS customer_state,
    {_STAMP.format(file="customers.csv")}
FROM {_two("customer")}""",
    "raw_order_items": f"""
SELECT CAST(l_orderkey AS STRING) AS order_id,
    CASE WHEN l_quantity = 4 THEN '1.5' WHEN l_quantity = 5 THEN '1e2' WHEN l_quantity = 6 THEN ''
         ELSE CAST(l_linenumber AS STRING) END AS order_item_id,
    CASE WHEN l_quantity = 7 THEN NULL ELSE CAST(l_partkey AS STRING) END AS product_id,
    CAST(l_suppkey AS STRING) AS seller_id,
    CASE WHEN l_quantity = 8 THEN '2018-02' ELSE CAST(l_shipdate AS STRING) END AS shipping_limit_date,
    CASE WHEN l_quantity = 1 THEN '0' WHEN l_quantity = 2 THEN '-5.5' WHEN l_quantity = 3 THEN 'n/a'
         WHEN l_quantity = 9 THEN '1.5d' ELSE CAST(l_extendedprice AS STRING) END AS price,
    CASE WHEN l_quantity = 10 THEN '' ELSE CAST(l_discount AS STRING) END AS freight_value,
    {_ONE_STAMP.format(file="order_items.csv")}
FROM {{lineitem}}""",
    "raw_payments": f"""
SELECT CAST(l_orderkey AS STRING) AS order_id,
    CAST(l_linenumber AS STRING) AS payment_sequential,
    CASE WHEN l_quantity = 7 THEN NULL WHEN l_returnflag = 'A' THEN 'Credit_Card '
         WHEN l_returnflag = 'N' THEN '{NBSP}BOLETO' ELSE 'crypto' END AS payment_type,
    CASE WHEN l_quantity = 11 THEN 'many' WHEN l_quantity = 12 THEN '2.5'
         ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS payment_installments,
    CASE WHEN l_quantity = 1 THEN '0' WHEN l_quantity = 2 THEN '-0.01' WHEN l_quantity = 3 THEN ''
         ELSE CAST(l_extendedprice AS STRING) END AS payment_value,
    {_ONE_STAMP.format(file="order_payments.csv")}
FROM {{lineitem}}""",
    "raw_products": f"""
SELECT CASE WHEN p_partkey % 211 = 0 THEN NULL ELSE CAST(p_partkey AS STRING) END AS product_id,
    CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN p_type || ' ' ELSE p_type END
        AS product_category_name,
    CAST(length(p_name) AS STRING) AS product_name_lenght,
    CASE WHEN p_size = 3 THEN '3.5' ELSE CAST(p_size * n AS STRING) END AS product_description_lenght,
    CASE WHEN p_size = 4 THEN 'two' ELSE '2' END AS product_photos_qty,
    CAST(p_retailprice AS STRING) AS product_weight_g,
    CASE WHEN p_size = 5 THEN '' ELSE CAST(p_size AS STRING) END AS product_length_cm,
    CAST(p_size AS STRING) || '.25' AS product_height_cm,
    CASE WHEN p_size = 6 THEN '7f' ELSE '1e1' END AS product_width_cm,
    {_STAMP.format(file="products.csv")}
FROM {_two("part")}""",
    "raw_category_translation": f"""
SELECT p_type AS product_category_name,
    CASE n WHEN 1 THEN 'former ' ELSE '' END || lower(p_type) || ' goods' AS product_category_name_english,
    {_STAMP.format(file="translation.csv")}
FROM (SELECT p_type, n FROM {_two("part")} WHERE p_type NOT IN ('PROMO', 'LARGE') GROUP BY p_type, n) AS t""",
    "raw_reviews": f"""
SELECT CASE WHEN o_orderkey % 107 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS review_id,
    CAST(o_orderkey AS STRING) AS order_id,
    CASE WHEN o_orderkey % 17 = 0 THEN '0' WHEN o_orderkey % 19 = 0 THEN '6'
         WHEN o_orderkey % 23 = 0 THEN '' ELSE substring(o_orderpriority, 1, 1) END AS review_score,
    CASE WHEN o_orderkey % 3 = 0 THEN '{NBSP} ' ELSE ' title ' END AS review_comment_title,
    coalesce(text, '') AS review_comment_message,
    CAST(o_orderdate + INTERVAL 12 DAY AS STRING) AS review_creation_date,
    CASE WHEN o_orderkey % 5 = 0 THEN 'never' ELSE CAST(o_orderdate + INTERVAL 14 DAY AS STRING) END
        AS review_answer_timestamp,
    {_STAMP.format(file="reviews.csv")}
FROM {_two("orders")} LEFT JOIN {{documents}} ON doc_id = o_orderkey""",
    "raw_sellers": f"""
SELECT CAST(s_suppkey AS STRING) AS seller_id,
    '0' || CAST(s_nationkey AS STRING) || ' ' AS seller_zip_code_prefix,
    '{NBSP}' || upper(s_name) AS seller_city,
    CASE n WHEN 1 THEN 'xx' ELSE ' sp' END AS seller_state,
    {_STAMP.format(file="sellers.csv")}
FROM {_two("supplier")}""",
    "raw_exchange_rates": f"""
SELECT event_type AS currency_code, value AS rate, 'USD' AS base_currency,
    CAST(ts AS STRING) AS fetched_at, {_ONE_STAMP.format(file="exchange_rates.json")}
FROM {{events}}""",
    "drift_before": """
SELECT CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value,
    CASE event_type WHEN 'error' THEN 'click' ELSE event_type END AS event_type
FROM {events} WHERE ts < TIMESTAMP '2024-01-16 00:00:00'""",
    "drift_after": """
SELECT CASE WHEN event_id % 13 = 0 THEN NULL ELSE value * 1.25 END AS value, event_type
FROM {events} WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'""",
    "labelled_reviews": """
SELECT doc_id AS review_id, text AS review_comment_message,
    CASE WHEN toxic = 1 THEN NULL ELSE CAST(n_chars % 41 AS INT) - 20 END AS delivery_delay_days,
    CAST(length(text) AS INT) AS review_comment_length, length(text) > 0 AS has_comment,
    CAST(n_chars % 5 AS INT) AS payment_type_encoded, quality AS satisfied
FROM {documents} JOIN {labels} USING (doc_id)""",
    "pseudo_scores": """
SELECT l_orderkey AS id, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS label,
    CASE WHEN l_quantity >= 12 THEN 1 ELSE 0 END AS prediction,
    l_quantity / 50 AS score
FROM {lineitem}""",
    "candidate_scores": """
SELECT l_suppkey AS model, CAST(count(CASE WHEN l_quantity <= 44 THEN 1 END) AS DOUBLE) / count(*) AS accuracy,
    CAST(count(CASE WHEN l_quantity <= 40 THEN 1 END) AS DOUBLE) / count(*) AS f1,
    CAST(count(CASE WHEN l_quantity <= 26 THEN 1 END) AS DOUBLE) / count(*) AS recall_unsatisfied,
    CAST(count(CASE WHEN l_quantity <= 33 THEN 1 END) AS DOUBLE) / count(*) AS f1_unsatisfied
FROM {lineitem} GROUP BY l_suppkey""",
    "champion_scores": """
SELECT l_suppkey AS model, CAST(count(CASE WHEN l_discount <= 0.07 THEN 1 END) AS DOUBLE) / count(*) AS f1,
    CAST(count(CASE WHEN l_tax <= 0.04 THEN 1 END) AS DOUBLE) / count(*) AS recall_unsatisfied
FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey WHERE s_acctbal > 0 GROUP BY l_suppkey""",
    "scoring_requests": f"""
SELECT event_id AS id,
    CASE event_type WHEN 'view' THEN ' ' || props || ' ' WHEN 'click' THEN '{NBSP}' ELSE '' END
        AS review_comment_message,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE value - 60 END AS delivery_delay_days,
    CAST(user_id % 50 AS INT) - 2 AS review_comment_length,
    CASE WHEN user_id % 31 = 0 THEN NULL ELSE event_type = 'view' END AS has_comment,
    CAST(event_id % 6 AS INT) AS payment_type_encoded
FROM {{events}}""",
}


_known: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    at = (spark.sparkContext.applicationId, path)
    if at not in _known:
        _known[at] = spark.read.parquet(path).schema
    return spark.read.schema(_known[at]).parquet(path)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a small file out over the cores, by hash of a key.

    A test table is one file with one row group, hence one task, however
    costly its rows are. A scan with enough splits is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


SPREAD_BY = {"lineitem": "l_orderkey", "orders": "o_orderkey", "documents": "doc_id"}


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The entity as a lazy frame over the test tables."""
    text = ENTITIES[name]
    bases = set(re.findall(r"\{(\w+)\}", text))
    tables = {b: table(spark, sf_dir, b) for b in bases}
    for b in bases & SPREAD_BY.keys():
        tables[b] = spread(tables[b], SPREAD_BY[b])
    return spark.sql(text, **tables)


def with_sql(*names: str) -> str:
    """``WITH name AS (...), ...`` over the registered tables, for the SQL check."""
    parts = [f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', ENTITIES[n])}\n)" for n in names]
    return "WITH " + ",\n".join(parts)
