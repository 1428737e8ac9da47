"""The data contract: which checks each layer must pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.operators.quality import (
    Check,
    accepted_values,
    between,
    custom,
    not_null,
    relationships,
    unique,
)
from tallyroom.plans.gold import OTHER_PAYMENT, PAYMENT_TYPES

# Fixed values.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "invoiced", "processing", "created", "approved",
    "unavailable",
)
PAYMENT_GROUPS = (*PAYMENT_TYPES, OTHER_PAYMENT)


def items_without_order(tables: dict[str, DataFrame]) -> DataFrame:
    """Order ids of items whose order is missing, with their number of items.

    A NULL order id counts as missing. Items are counted per order before
    the join, so a much repeated id is one row there.
    """
    known = tables["orders"].select("order_id").distinct()
    per_order = tables["order_items"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return per_order.join(known, "order_id", "left_anti")


def items_without_price(tables: dict[str, DataFrame]) -> DataFrame:
    return tables["order_items"].where(F.col("price") <= 0).select("order_id", "product_id", "price")


def scores_out_of_range(tables: dict[str, DataFrame]) -> DataFrame:
    return (
        tables["reviews"].where(~F.col("review_score").between(1, 5)).select("review_id", "review_score")
    )


BRONZE_CHECKS: tuple[Check, ...] = tuple(
    not_null(table, column)
    for table, column in (
        ("orders", "order_id"),
        ("customers", "customer_id"),
        ("order_items", "order_id"),
        ("products", "product_id"),
        ("reviews", "review_id"),
        ("payments", "order_id"),
        ("sellers", "seller_id"),
        ("exchange_rates", "currency_code"),
        ("category_translation", "product_category_name"),
    )
)

SILVER_CHECKS: tuple[Check, ...] = (
    not_null("orders", "order_id"),
    unique("orders", "order_id"),
    not_null("orders", "customer_id"),
    relationships("orders", "customer_id", "customers", "customer_id"),
    accepted_values("orders", "order_status", ORDER_STATUSES),
    not_null("orders", "order_purchase_timestamp"),
    not_null("customers", "customer_id"),
    unique("customers", "customer_id"),
    not_null("customers", "customer_unique_id"),
    not_null("products", "product_id"),
    unique("products", "product_id"),
    not_null("reviews", "review_id"),
    unique("reviews", "review_id"),
    not_null("reviews", "order_id"),
    relationships("reviews", "order_id", "orders", "order_id"),
    not_null("reviews", "review_score"),
    between("reviews", "review_score", 1, 5),
    not_null("payments", "order_id"),
    relationships("payments", "order_id", "orders", "order_id"),
    accepted_values("payments", "payment_type", PAYMENT_GROUPS),
    not_null("sellers", "seller_id"),
    unique("sellers", "seller_id"),
    not_null("order_items", "order_id"),
    relationships("order_items", "order_id", "orders", "order_id"),
    not_null("order_items", "product_id"),
    relationships("order_items", "product_id", "products", "product_id"),
    between("order_items", "price", 0, strict=True),
    custom("items_without_order", "order_items", "order_id", items_without_order, "orders", "order_id"),
    custom("items_without_price", "order_items", "price", items_without_price),
    custom("scores_out_of_range", "reviews", "review_score", scores_out_of_range),
)

GOLD_CHECKS: tuple[Check, ...] = (
    not_null("orders_summary", "customer_unique_id"),
    relationships("orders_summary", "customer_unique_id", "customers", "customer_unique_id"),
    not_null("orders_summary", "order_month"),
    not_null("customer_rfm", "customer_unique_id"),
    unique("customer_rfm", "customer_unique_id"),
    relationships("customer_rfm", "customer_unique_id", "customers", "customer_unique_id"),
    not_null("product_performance", "product_id"),
    unique("product_performance", "product_id"),
    relationships("product_performance", "product_id", "products", "product_id"),
    not_null("seller_ranking", "seller_id"),
    unique("seller_ranking", "seller_id"),
    relationships("seller_ranking", "seller_id", "sellers", "seller_id"),
    not_null("reviews_features", "review_id"),
    unique("reviews_features", "review_id"),
    relationships("reviews_features", "review_id", "reviews", "review_id"),
    not_null("reviews_features", "satisfied"),
    accepted_values("reviews_features", "satisfied", (0, 1)),
    not_null("reviews_features", "review_score"),
    between("reviews_features", "review_score", 1, 5),
    accepted_values("reviews_features", "has_comment", (True, False)),
    between("reviews_features", "review_comment_length", 0),
    not_null("reviews_features", "payment_type"),
    accepted_values("reviews_features", "payment_type", PAYMENT_GROUPS),
)
