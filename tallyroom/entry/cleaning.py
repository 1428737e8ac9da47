"""Registered queries: expressions, de-duplication and the silver entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.entry.adapters import entity, table, with_sql
from tallyroom.entry.book import plain, query
from tallyroom.functions import exprs as X
from tallyroom.operators.dedup import consistent_sample, latest_per_key
from tallyroom.plans import gold, silver
from tallyroom.sources.readers import explode_rates

_LINEAGE = "_loaded_at, _source_file, _batch_id"


def _latest(source: str, key: str, columns: str) -> str:
    """Latest row per key of a typed CTE, ties as in the library."""
    rest = ", ".join(f"{c.strip()} ASC NULLS LAST" for c in columns.split(",") if c.strip() != key)
    return f"""
SELECT {columns}, {_LINEAGE} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _loaded_at DESC NULLS LAST,
        _batch_id DESC NULLS LAST, {rest}) AS rn
    FROM {source}) WHERE rn = 1"""


@query(
    "csv_style_safe_casts",
    with_sql("raw_order_items")
    + """
SELECT order_id, CAST(TRY_CAST(order_item_id AS INTEGER) AS BIGINT) AS item_no,
    TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(freight_value AS DOUBLE) AS freight,
    CAST(TRY_CAST(shipping_limit_date AS TIMESTAMP) AS VARCHAR) AS shipping_limit,
    TRY_CAST(shipping_limit_date AS DATE) AS shipping_day
FROM raw_order_items""",
)
def csv_style_safe_casts(spark: SparkSession, d: str) -> DataFrame:
    raw = entity(spark, d, "raw_order_items")
    return plain(
        raw.select(
            "order_id",
            X.safe_int("order_item_id").alias("item_no"),
            X.safe_double("price").alias("price"),
            X.safe_double("freight_value").alias("freight"),
            X.safe_timestamp("shipping_limit_date").alias("shipping_limit"),
            X.safe_date("shipping_limit_date").alias("shipping_day"),
        )
    )


@query(
    "normalise_strings",
    with_sql("raw_customers", "raw_reviews")
    + """
SELECT customer_id AS id, TRIM(customer_zip_code_prefix) AS code, LOWER(TRIM(customer_city)) AS low,
    UPPER(TRIM(customer_state)) AS up, NULLIF(TRIM(customer_city), '') AS kept
FROM raw_customers
UNION ALL
SELECT order_id, NULLIF(TRIM(review_comment_title), ''), LOWER(TRIM(review_score)), UPPER(TRIM(review_score)),
    NULLIF(TRIM(review_score), '')
FROM raw_reviews""",
)
def normalise_strings(spark: SparkSession, d: str) -> DataFrame:
    customers = entity(spark, d, "raw_customers").select(
        F.col("customer_id").alias("id"),
        X.trimmed("customer_zip_code_prefix").alias("code"),
        X.clean_lower("customer_city").alias("low"),
        X.clean_upper("customer_state").alias("up"),
        X.blank_to_null("customer_city").alias("kept"),
    )
    reviews = entity(spark, d, "raw_reviews").select(
        F.col("order_id").alias("id"),
        X.blank_to_null("review_comment_title").alias("code"),
        X.clean_lower("review_score").alias("low"),
        X.clean_upper("review_score").alias("up"),
        X.blank_to_null("review_score").alias("kept"),
    )
    return customers.unionByName(reviews)


@query(
    "surrogate_key",
    """
SELECT doc_id, md5(coalesce(CAST(doc_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
    coalesce(CASE WHEN lang = 'en' THEN NULL ELSE lang END, '_dbt_utils_surrogate_key_null_') || '-' ||
    coalesce(text, '_dbt_utils_surrogate_key_null_')) AS surrogate_key
FROM documents""",
)
def surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    lang = F.when(F.col("lang") != "en", F.col("lang"))
    return table(spark, d, "documents").select(
        "doc_id", X.surrogate_key("doc_id", lang, "text").alias("surrogate_key")
    )


@query(
    "json_rates_explode",
    """
SELECT CAST(je.key AS VARCHAR) AS currency_code, CAST(je.value AS DOUBLE) AS rate,
    CASE WHEN event_type = 'error' THEN 'UNKNOWN' ELSE event_type END AS base_currency,
    CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS fetched_at, event_id
FROM events, json_each(CAST(props AS JSON)) AS je""",
)
def json_rates_explode(spark: SparkSession, d: str) -> DataFrame:
    kind, at = F.col("event_type"), F.col("user_id").cast("string")
    first, second = kind.isin("view", "click"), kind.isin("purchase", "signup")
    documents = table(spark, d, "events").select(
        "event_id",
        F.when(first, kind).alias("base"),
        F.when(first, at).alias("fetched_at"),
        F.when(second, kind).alias("base_code"),
        F.when(second, at).alias("time_last_update_utc"),
        F.from_json("props", "map<string,double>").alias("rates"),
    )
    return explode_rates(documents)


_ORDERS_TYPED = """
, typed AS (
SELECT order_id, customer_id, LOWER(TRIM(order_status)) AS order_status,
    TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
    TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
    TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
    TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
    TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date,
    _loaded_at, _source_file, _batch_id
FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL)"""
_ORDER_COLUMNS = (
    "order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
    "order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date"
)


@query(
    "silver_orders",
    with_sql("raw_orders")
    + _ORDERS_TYPED
    + f"""
SELECT order_id, customer_id, order_status,
    CAST(order_purchase_timestamp AS VARCHAR) AS order_purchase_timestamp,
    CAST(order_approved_at AS VARCHAR) AS order_approved_at,
    CAST(order_delivered_carrier_date AS VARCHAR) AS order_delivered_carrier_date,
    CAST(order_delivered_customer_date AS VARCHAR) AS order_delivered_customer_date,
    CAST(order_estimated_delivery_date AS VARCHAR) AS order_estimated_delivery_date, {_LINEAGE}
FROM ({_latest("typed", "order_id", _ORDER_COLUMNS)})""",
)
def silver_orders(spark: SparkSession, d: str) -> DataFrame:
    return plain(silver.silver_orders(entity(spark, d, "raw_orders")))


@query(
    "silver_customers",
    with_sql("raw_customers")
    + """
, typed AS (
SELECT customer_id, customer_unique_id, TRIM(customer_zip_code_prefix) AS customer_zip_code_prefix,
    LOWER(TRIM(customer_city)) AS customer_city, UPPER(TRIM(customer_state)) AS customer_state,
    _loaded_at, _source_file, _batch_id
FROM raw_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL)"""
    + _latest(
        "typed",
        "customer_id",
        "customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state",
    ),
)
def silver_customers(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_customers(entity(spark, d, "raw_customers"))


@query(
    "silver_order_items",
    with_sql("raw_order_items")
    + f"""
SELECT order_id, CAST(TRY_CAST(order_item_id AS INTEGER) AS BIGINT) AS order_item_id, product_id, seller_id,
    CAST(TRY_CAST(shipping_limit_date AS TIMESTAMP) AS VARCHAR) AS shipping_limit_date,
    TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(freight_value AS DOUBLE) AS freight_value,
    TRY_CAST(price AS DOUBLE) + TRY_CAST(freight_value AS DOUBLE) AS total_item_value, {_LINEAGE}
FROM raw_order_items
WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL
    AND TRY_CAST(price AS DOUBLE) > 0""",
)
def silver_order_items(spark: SparkSession, d: str) -> DataFrame:
    return plain(silver.silver_order_items(entity(spark, d, "raw_order_items")))


@query(
    "silver_payments",
    with_sql("raw_payments")
    + f"""
SELECT order_id, CAST(TRY_CAST(payment_sequential AS INTEGER) AS BIGINT) AS payment_sequential,
    LOWER(TRIM(payment_type)) AS payment_type,
    CAST(TRY_CAST(payment_installments AS INTEGER) AS BIGINT) AS payment_installments,
    TRY_CAST(payment_value AS DOUBLE) AS payment_value, {_LINEAGE}
FROM raw_payments
WHERE order_id IS NOT NULL AND payment_type IS NOT NULL AND TRY_CAST(payment_value AS DOUBLE) >= 0""",
)
def silver_payments(spark: SparkSession, d: str) -> DataFrame:
    return plain(silver.silver_payments(entity(spark, d, "raw_payments")))


_PRODUCT_COLUMNS = (
    "product_id, product_category_name, product_category_name_english, product_name_length, "
    "product_description_length, product_photos_qty, product_weight_g, product_length_cm, "
    "product_height_cm, product_width_cm"
)


@query(
    "silver_products",
    with_sql("raw_products", "raw_category_translation")
    + """
, english AS (
SELECT product_category_name, product_category_name_english FROM (
    SELECT *, row_number() OVER (PARTITION BY product_category_name ORDER BY _loaded_at DESC) AS rn
    FROM raw_category_translation) WHERE rn = 1)
, typed AS (
SELECT p.product_id, TRIM(p.product_category_name) AS product_category_name,
    COALESCE(e.product_category_name_english, p.product_category_name) AS product_category_name_english,
    CAST(TRY_CAST(p.product_name_lenght AS INTEGER) AS BIGINT) AS product_name_length,
    CAST(TRY_CAST(p.product_description_lenght AS INTEGER) AS BIGINT) AS product_description_length,
    CAST(TRY_CAST(p.product_photos_qty AS INTEGER) AS BIGINT) AS product_photos_qty,
    TRY_CAST(p.product_weight_g AS DOUBLE) AS product_weight_g,
    TRY_CAST(p.product_length_cm AS DOUBLE) AS product_length_cm,
    TRY_CAST(p.product_height_cm AS DOUBLE) AS product_height_cm,
    TRY_CAST(p.product_width_cm AS DOUBLE) AS product_width_cm,
    p._loaded_at, p._source_file, p._batch_id
FROM raw_products AS p LEFT JOIN english AS e USING (product_category_name)
WHERE p.product_id IS NOT NULL)"""
    + _latest("typed", "product_id", _PRODUCT_COLUMNS),
)
def silver_products(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        silver.silver_products(
            entity(spark, d, "raw_products"), entity(spark, d, "raw_category_translation")
        )
    )


@query(
    "silver_reviews",
    with_sql("raw_reviews")
    + """
, typed AS (
SELECT review_id, order_id, CAST(TRY_CAST(review_score AS INTEGER) AS BIGINT) AS review_score,
    NULLIF(TRIM(review_comment_title), '') AS review_comment_title,
    NULLIF(TRIM(review_comment_message), '') AS review_comment_message,
    CAST(TRY_CAST(review_creation_date AS TIMESTAMP) AS VARCHAR) AS review_creation_date,
    CAST(TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS VARCHAR) AS review_answer_timestamp,
    _loaded_at, _source_file, _batch_id
FROM raw_reviews
WHERE review_id IS NOT NULL AND order_id IS NOT NULL
    AND TRY_CAST(review_score AS INTEGER) BETWEEN 1 AND 5)"""
    + _latest(
        "typed",
        "review_id",
        "review_id, order_id, review_score, review_comment_title, review_comment_message, "
        "review_creation_date, review_answer_timestamp",
    ),
)
def silver_reviews(spark: SparkSession, d: str) -> DataFrame:
    return plain(silver.silver_reviews(entity(spark, d, "raw_reviews")))


@query(
    "silver_sellers",
    with_sql("raw_sellers")
    + """
, typed AS (
SELECT seller_id, TRIM(seller_zip_code_prefix) AS seller_zip_code_prefix,
    LOWER(TRIM(seller_city)) AS seller_city, UPPER(TRIM(seller_state)) AS seller_state,
    _loaded_at, _source_file, _batch_id
FROM raw_sellers WHERE seller_id IS NOT NULL)"""
    + _latest("typed", "seller_id", "seller_id, seller_zip_code_prefix, seller_city, seller_state"),
)
def silver_sellers(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_sellers(entity(spark, d, "raw_sellers"))


@query(
    "dedup_latest",
    """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
        l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
WHERE rn = 1""",
)
def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    return plain(
        latest_per_key(
            items,
            ["l_orderkey", "l_linenumber"],
            [F.col("l_shipdate").desc_nulls_last()],
            [F.col(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")],
        )
    )


@query(
    "order_items_deduped",
    with_sql("raw_order_items")
    + """
, typed AS (
SELECT order_id, CAST(TRY_CAST(order_item_id AS INTEGER) AS BIGINT) AS order_item_id, product_id, seller_id,
    CAST(TRY_CAST(shipping_limit_date AS TIMESTAMP) AS VARCHAR) AS shipping_limit_date,
    TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(freight_value AS DOUBLE) AS freight_value,
    TRY_CAST(price AS DOUBLE) + TRY_CAST(freight_value AS DOUBLE) AS total_item_value,
    _loaded_at, _source_file, _batch_id
FROM raw_order_items
WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL
    AND TRY_CAST(price AS DOUBLE) > 0)
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY _loaded_at DESC,
        _batch_id DESC, product_id, seller_id, shipping_limit_date NULLS LAST, price,
        freight_value NULLS LAST, total_item_value NULLS LAST, _source_file) AS rn
    FROM typed) WHERE rn = 1""",
)
def order_items_deduped(spark: SparkSession, d: str) -> DataFrame:
    raw = entity(spark, d, "raw_order_items")
    return plain(silver.silver_order_items(raw, dedup_keys=("order_id", "order_item_id")))


@query(
    "top_payment_per_order",
    with_sql("shop_payments")
    + """
SELECT order_id, payment_type FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC NULLS LAST,
        payment_sequential, payment_type) AS rn FROM shop_payments) WHERE rn = 1""",
)
def top_payment_per_order(spark: SparkSession, d: str) -> DataFrame:
    return gold.top_payment(entity(spark, d, "shop_payments"))


@query(
    "latest_location_distinct_on",
    with_sql("shop_orders", "shop_customers")
    + """
SELECT DISTINCT ON (customer_unique_id) customer_unique_id, customer_city, customer_state
FROM shop_customers JOIN shop_orders USING (customer_id)
ORDER BY customer_unique_id, order_purchase_timestamp DESC NULLS LAST, order_id DESC""",
)
def latest_location_distinct_on(spark: SparkSession, d: str) -> DataFrame:
    return gold.latest_location(entity(spark, d, "shop_orders"), entity(spark, d, "shop_customers"))




@query(
    "consistent_sample",
    with_sql(
        "shop_orders_with_delivery", "shop_customers", "shop_items", "shop_payments", "shop_reviews",
        "shop_products", "shop_sellers",
    )
    + """
, picked AS (
SELECT DISTINCT o.order_id, o.customer_id
FROM shop_orders_with_delivery AS o JOIN shop_items AS i USING (order_id)
    JOIN shop_payments AS p USING (order_id) JOIN shop_reviews AS r USING (order_id)
    JOIN shop_customers AS c ON c.customer_id = o.customer_id
WHERE o.order_status = 'delivered' AND o.order_delivered_customer_date IS NOT NULL
    AND o.order_estimated_delivery_date IS NOT NULL
ORDER BY o.order_id LIMIT 100)
, items AS (SELECT * FROM shop_items WHERE order_id IN (SELECT order_id FROM picked))
SELECT 'orders' AS table_name, CAST(order_id AS VARCHAR) AS id, CAST(1 AS BIGINT) AS n_rows FROM picked
UNION ALL SELECT 'customers', CAST(customer_id AS VARCHAR), count(*) FROM shop_customers
    WHERE customer_id IN (SELECT customer_id FROM picked) GROUP BY ALL
UNION ALL SELECT 'order_items', CAST(order_id AS VARCHAR), count(*) FROM items GROUP BY ALL
UNION ALL SELECT 'payments', CAST(order_id AS VARCHAR), count(*) FROM shop_payments
    WHERE order_id IN (SELECT order_id FROM picked) GROUP BY ALL
UNION ALL SELECT 'reviews', CAST(review_id AS VARCHAR), count(*) FROM shop_reviews
    WHERE order_id IN (SELECT order_id FROM picked) GROUP BY ALL
UNION ALL SELECT 'products', CAST(product_id AS VARCHAR), count(*) FROM shop_products
    WHERE product_id IN (SELECT product_id FROM items) GROUP BY ALL
UNION ALL SELECT 'sellers', CAST(seller_id AS VARCHAR), count(*) FROM shop_sellers
    WHERE seller_id IN (SELECT seller_id FROM items) GROUP BY ALL""",
)
def sample(spark: SparkSession, d: str) -> DataFrame:
    sources = {
        "orders": ("shop_orders_with_delivery", "order_id"),
        "customers": ("shop_customers", "customer_id"),
        "order_items": ("shop_items", "order_id"),
        "payments": ("shop_payments", "order_id"),
        "reviews": ("shop_reviews", "review_id"),
        "products": ("shop_products", "product_id"),
        "sellers": ("shop_sellers", "seller_id"),
    }
    drawn = consistent_sample({n: entity(spark, d, e) for n, (e, _) in sources.items()}, 100)
    report = None
    for name, (_, key) in sources.items():
        part = (
            drawn[name]
            .groupBy(F.col(key).cast("string").alias("id"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("table_name"), "id", "n_rows")
        )
        report = part if report is None else report.unionByName(part)
    return report
