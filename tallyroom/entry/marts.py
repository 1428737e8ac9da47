"""Registered queries: marts, rankings and the feature table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.entry.adapters import entity, table, with_sql
from tallyroom.entry.book import plain, query
from tallyroom.operators.ranking import Axis, global_dense_rank, global_ntile
from tallyroom.plans import gold
from tallyroom.sources.durable import durable

AS_OF = dt.date(2002, 1, 1)


def _money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def _money_avg(column: str) -> str:
    return f"{_money(column)} / nullif(count({column}), 0)"


@query(
    "orders_summary",
    with_sql("shop_orders", "shop_customers", "shop_items")
    + f"""
, totals AS (
SELECT order_id, count(*) AS n_items, {_money("price")} AS product_value,
    {_money("freight_value")} AS freight_value, {_money("total_item_value")} AS order_value
FROM shop_items GROUP BY order_id)
SELECT customer_unique_id, customer_city, customer_state,
    CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month,
    count(DISTINCT order_id) AS total_orders, CAST(sum(n_items) AS BIGINT) AS total_items,
    {_money("order_value")} AS total_revenue, {_money_avg("order_value")} AS avg_order_value,
    {_money("product_value")} AS total_product_revenue, {_money("freight_value")} AS total_freight_revenue,
    count(DISTINCT CASE WHEN order_status = 'delivered' THEN order_id END) AS delivered_orders,
    count(DISTINCT CASE WHEN order_status = 'canceled' THEN order_id END) AS canceled_orders
FROM shop_orders JOIN shop_customers USING (customer_id) JOIN totals USING (order_id)
WHERE order_purchase_timestamp IS NOT NULL
GROUP BY 1, 2, 3, 4""",
)
def orders_summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.orders_summary(
        entity(spark, d, "shop_orders"),
        entity(spark, d, "shop_customers"),
        entity(spark, d, "shop_items"),
    )


@query(
    "customer_rfm",
    with_sql("shop_orders", "shop_customers", "shop_items")
    + f"""
, delivered AS (
SELECT * FROM shop_orders WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL)
, totals AS (SELECT order_id, {_money("total_item_value")} AS order_value FROM shop_items GROUP BY order_id)
, base AS (
SELECT customer_unique_id, CAST(max(order_purchase_timestamp) AS DATE) AS last_order_date,
    count(DISTINCT order_id) AS frequency, {_money("order_value")} AS monetary_value,
    {_money_avg("order_value")} AS avg_order_value
FROM delivered JOIN shop_customers USING (customer_id) JOIN totals USING (order_id) GROUP BY 1)
, place AS (
SELECT DISTINCT ON (customer_unique_id) customer_unique_id, customer_city, customer_state
FROM shop_customers JOIN delivered USING (customer_id)
ORDER BY customer_unique_id, order_purchase_timestamp DESC NULLS LAST, order_id DESC)
SELECT customer_unique_id, customer_city, customer_state, last_order_date,
    datediff('day', last_order_date, DATE '2002-01-01') AS recency_days, frequency, monetary_value, avg_order_value,
    ntile(5) OVER (ORDER BY datediff('day', last_order_date, DATE '2002-01-01') DESC, customer_unique_id) AS r_score,
    ntile(5) OVER (ORDER BY frequency, customer_unique_id) AS f_score,
    ntile(5) OVER (ORDER BY monetary_value, customer_unique_id) AS m_score
FROM base JOIN place USING (customer_unique_id)""",
)
def customer_rfm(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        gold.customer_rfm(
            entity(spark, d, "shop_orders"),
            entity(spark, d, "shop_customers"),
            entity(spark, d, "shop_items"),
            as_of=AS_OF,
        )
    )


_SCORES = """
, scores AS (SELECT order_id, avg(review_score) AS avg_score FROM shop_reviews GROUP BY order_id)"""


@query(
    "product_performance",
    with_sql("shop_orders", "shop_products", "shop_items", "shop_reviews")
    + _SCORES
    + f"""
, sold AS (
SELECT i.* FROM shop_items AS i JOIN shop_orders AS o USING (order_id) WHERE order_status = 'delivered')
SELECT p.product_id, p.product_category_name_english AS category, count(DISTINCT s.order_id) AS total_orders,
    count(*) AS total_items_sold, {_money("s.price")} AS total_revenue, {_money_avg("s.price")} AS avg_unit_price,
    {_money("s.freight_value")} AS total_freight, {_money("s.total_item_value")} AS total_gmv,
    avg(r.avg_score) AS avg_review_score, count(r.order_id) AS total_reviewed_orders
FROM shop_products AS p LEFT JOIN sold AS s ON s.product_id = p.product_id
    LEFT JOIN scores AS r ON r.order_id = s.order_id
GROUP BY 1, 2""",
)
def product_performance(spark: SparkSession, d: str) -> DataFrame:
    return gold.product_performance(
        entity(spark, d, "shop_products"),
        entity(spark, d, "shop_items"),
        entity(spark, d, "shop_orders"),
        entity(spark, d, "shop_reviews"),
    )


@query(
    "seller_ranking",
    with_sql("shop_orders_with_delivery", "shop_sellers", "shop_items", "shop_reviews")
    + _SCORES
    + f"""
, sold AS (
SELECT i.*, order_purchase_timestamp, order_delivered_customer_date
FROM shop_items AS i JOIN shop_orders_with_delivery AS o USING (order_id) WHERE order_status = 'delivered')
SELECT p.seller_id, p.seller_city, p.seller_state, count(DISTINCT s.order_id) AS total_orders,
    count(*) AS total_items_sold, {_money("s.price")} AS total_revenue, {_money_avg("s.price")} AS avg_item_price,
    {_money("s.total_item_value")} AS total_gmv, round(avg(r.avg_score), 2) AS avg_review_score,
    count(r.order_id) AS total_reviewed_orders,
    round(avg(datediff('day', CAST(s.order_purchase_timestamp AS DATE),
        CAST(s.order_delivered_customer_date AS DATE))), 1) AS avg_delivery_days,
    dense_rank() OVER (ORDER BY {_money("s.price")} DESC) AS revenue_rank
FROM shop_sellers AS p LEFT JOIN sold AS s ON s.seller_id = p.seller_id
    LEFT JOIN scores AS r ON r.order_id = s.order_id
GROUP BY 1, 2, 3""",
)
def seller_ranking(spark: SparkSession, d: str) -> DataFrame:
    return gold.seller_ranking(
        entity(spark, d, "shop_sellers"),
        entity(spark, d, "shop_items"),
        entity(spark, d, "shop_orders_with_delivery"),
        entity(spark, d, "shop_reviews"),
    )


@query(
    "reviews_features",
    with_sql("shop_orders_with_delivery", "shop_payments", "shop_reviews")
    + """
, top AS (
SELECT order_id, lower(trim(payment_type)) AS kind FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC NULLS LAST,
        payment_sequential, payment_type) AS rn FROM shop_payments) WHERE rn = 1)
SELECT review_id, r.order_id, CAST(review_score AS BIGINT) AS review_score,
    CAST(CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS BIGINT) AS satisfied,
    coalesce(review_comment_message, '') AS review_comment_message,
    length(coalesce(review_comment_message, '')) AS review_comment_length,
    review_comment_message IS NOT NULL AND length(trim(review_comment_message)) > 0 AS has_comment,
    datediff('day', CAST(order_estimated_delivery_date AS DATE), CAST(order_delivered_customer_date AS DATE))
        AS delivery_delay_days,
    CASE WHEN kind IN ('credit_card', 'boleto', 'voucher', 'debit_card') THEN kind ELSE 'not_defined' END
        AS payment_type,
    CAST(CASE kind WHEN 'credit_card' THEN 0 WHEN 'boleto' THEN 1 WHEN 'voucher' THEN 2 WHEN 'debit_card' THEN 3
        ELSE 4 END AS BIGINT) AS payment_type_encoded,
    order_status, customer_id, CAST(order_purchase_timestamp AS VARCHAR) AS order_purchase_timestamp
FROM shop_reviews AS r LEFT JOIN shop_orders_with_delivery AS o ON o.order_id = r.order_id
    LEFT JOIN top ON top.order_id = r.order_id""",
)
def reviews_features(spark: SparkSession, d: str) -> DataFrame:
    reviews = entity(spark, d, "shop_reviews").withColumn(
        "review_creation_date", F.lit(None).cast("timestamp_ntz")
    )
    features = gold.reviews_features(
        reviews, entity(spark, d, "shop_orders_with_delivery"), entity(spark, d, "shop_payments")
    )
    return plain(features.drop("review_creation_date"))


@query(
    "global_ntile",
    """
SELECT o_orderkey, ntile(7) OVER (ORDER BY o_totalprice, o_orderkey) AS price_bucket,
    ntile(7) OVER (ORDER BY o_custkey DESC, o_orderkey) AS customer_bucket,
    ntile(7) OVER (ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 1 END, o_orderkey) AS status_bucket
FROM orders""",
)
def ntile(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        "o_totalprice",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", 1).alias("known"),
    )
    orders = durable(orders.repartition("o_orderkey"), "ntile-input")  # the file may be a single task
    axes = {
        "price_bucket": Axis("o_totalprice"),
        "customer_bucket": Axis("o_custkey", descending=True),
        "status_bucket": Axis("known"),
    }
    return global_ntile(orders, 7, axes, "o_orderkey").select("o_orderkey", *axes)


@query(
    "ntile_of_big_keys",
    """
SELECT o_orderkey, ntile(9) OVER (ORDER BY 9007199254740993 + o_custkey, o_orderkey) AS up,
    ntile(9) OVER (ORDER BY 9007199254740993 + o_custkey DESC, o_orderkey) AS down,
    ntile(9) OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS day
FROM orders""",
)
def ntile_of_big_keys(spark: SparkSession, d: str) -> DataFrame:
    """Neighbouring BIGINTs that are one DOUBLE, and dates."""
    orders = table(spark, d, "orders").select(
        "o_orderkey", (F.lit(9007199254740993) + F.col("o_custkey")).alias("big"), F.col("o_orderdate").cast("date").alias("on")
    )
    orders = durable(orders.repartition("o_orderkey"), "ntile-input")  # the file may be a single task
    axes = {"up": Axis("big"), "down": Axis("big", descending=True), "day": Axis("on")}
    return global_ntile(orders, 9, axes, "o_orderkey").select("o_orderkey", *axes)


@query(
    "global_dense_rank",
    """
SELECT l_orderkey, l_partkey, l_extendedprice, value, dense_rank() OVER (ORDER BY value DESC) AS place
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity * l_discount END AS value FROM lineitem)""",
)
def dense_rank(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_extendedprice",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity") * F.col("l_discount")).alias("value"),
    )
    return global_dense_rank(durable(items, "rank-input"), "value", "place", descending=True)
