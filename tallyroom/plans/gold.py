"""Business marts and the feature table.

Inputs are silver entities: ``order_id`` is unique in orders, ``customer_id``
in customers, ``product_id`` in products, ``seller_id`` in sellers and
``review_id`` in reviews.

Shape of the plans: items, orders, payments and reviews meet on ``order_id``,
each shuffled once; what follows is a partial aggregate per task, so a seller
or product with a large share of the rows sends one partial row per task.
Dimensions are joined after the aggregation, so rows of unsold products and
sellers never meet under a NULL join key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions import exprs as X
from tallyroom.operators.dedup import top_per_key
from tallyroom.operators.ranking import Axis, global_dense_rank, global_ntile
from tallyroom.sources.durable import durable, together

# Payment types in the order of their codes; any other type is
# "not_defined" with the next code.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
OTHER_PAYMENT = "not_defined"


def _count() -> Column:
    return F.count(F.lit(1))


def _order_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        _count().alias("n_items"),
        X.exact_sum("price").alias("product_value"),
        X.exact_sum("freight_value").alias("freight_value"),
        X.exact_sum("total_item_value").alias("order_value"),
    )


def orders_summary(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue and order counts per person, place and month, all statuses."""
    people = customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    placed = orders.where(F.col("order_purchase_timestamp").isNotNull()).select(
        "order_id",
        "customer_id",
        "order_status",
        X.month_start("order_purchase_timestamp").alias("order_month"),
    )
    return (
        placed.join(_order_totals(items), "order_id")
        .join(people, "customer_id")
        .groupBy("customer_unique_id", "customer_city", "customer_state", "order_month")
        .agg(
            _count().alias("total_orders"),
            F.sum("n_items").alias("total_items"),
            X.exact_sum("order_value").alias("total_revenue"),
            X.exact_avg("order_value").alias("avg_order_value"),
            X.exact_sum("product_value").alias("total_product_revenue"),
            X.exact_sum("freight_value").alias("total_freight_revenue"),
            F.count(F.when(F.col("order_status") == "delivered", 1)).alias("delivered_orders"),
            F.count(F.when(F.col("order_status") == "canceled", 1)).alias("canceled_orders"),
        )
    )


def latest_location(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """City and state of each person's most recent order."""
    joined = customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state"
    ).join(orders.select("customer_id", "order_id", "order_purchase_timestamp"), "customer_id")
    newest = [F.col("order_purchase_timestamp").desc_nulls_last(), F.col("order_id").desc()]
    return top_per_key(joined, ["customer_unique_id"], newest).select(
        "customer_unique_id", "customer_city", "customer_state"
    )


def customer_rfm(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    *,
    as_of: dt.date | None = None,
    buckets: int = 5,
) -> DataFrame:
    """Recency, frequency and monetary scores per person, delivered orders only.

    The highest score is the best on all three axes. One pass over the joined
    orders gives both the sums (orders that have items) and the latest place
    (any delivered order). ``as_of`` defaults to today.
    """
    delivered = orders.where(
        (F.col("order_status") == "delivered") & F.col("order_purchase_timestamp").isNotNull()
    ).select("order_id", "customer_id", "order_purchase_timestamp")
    order_values = items.groupBy("order_id").agg(
        X.exact_sum("total_item_value").alias("order_value"), _count().alias("n_items")
    )
    people = customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    has_items = F.col("n_items").isNotNull()
    today = F.lit(as_of) if as_of is not None else F.current_date()
    per_person = (
        delivered.join(order_values, "order_id", "left")
        .join(people, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.max_by(
                F.struct("customer_city", "customer_state"),
                F.struct("order_purchase_timestamp", "order_id"),
            ).alias("place"),
            F.max(F.when(has_items, F.col("order_purchase_timestamp"))).alias("last_order"),
            F.count(F.when(has_items, 1)).alias("frequency"),
            X.exact_sum("order_value").alias("monetary_value"),
            X.exact_avg("order_value").alias("avg_order_value"),
        )
        .where(F.col("frequency") > 0)
        .select(
            "customer_unique_id",
            "place.customer_city",
            "place.customer_state",
            F.col("last_order").cast("date").alias("last_order_date"),
            X.days_between("last_order", today).alias("recency_days"),
            "frequency",
            "monetary_value",
            "avg_order_value",
        )
    )
    return global_ntile(
        durable(per_person, "rfm"),
        buckets,
        {
            "r_score": Axis("recency_days", descending=True),
            "f_score": Axis("frequency"),
            "m_score": Axis("monetary_value"),
        },
        "customer_unique_id",
    )


def _review_scores(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("avg_score"), F.lit(True).alias("reviewed")
    )


def _delivered(orders: DataFrame, *columns: str) -> DataFrame:
    return orders.where(F.col("order_status") == "delivered").select("order_id", *columns)


def product_performance(
    products: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Sales and review scores per product, unsold products included.

    An unsold product counts one item row, and reviewed orders are counted
    per item row; both follow from counting rows after an outer join.
    """
    sold = (
        items.select("order_id", "product_id", "price", "freight_value", "total_item_value")
        .join(_delivered(orders), "order_id")
        .join(_review_scores(reviews), "order_id", "left")
        .groupBy("product_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            _count().alias("total_items_sold"),
            X.exact_sum("price").alias("total_revenue"),
            X.exact_avg("price").alias("avg_unit_price"),
            X.exact_sum("freight_value").alias("total_freight"),
            X.exact_sum("total_item_value").alias("total_gmv"),
            F.avg("avg_score").alias("avg_review_score"),
            F.count("reviewed").alias("total_reviewed_orders"),
        )
    )
    return products.select(
        "product_id", F.col("product_category_name_english").alias("category")
    ).join(sold, "product_id", "left").fillna({"total_orders": 0, "total_items_sold": 1, "total_reviewed_orders": 0})


def seller_ranking(
    sellers: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Sales, delivery time and review scores per seller, ranked by revenue."""
    delivery = X.days_between("order_purchase_timestamp", "order_delivered_customer_date")
    sold = (
        items.select("order_id", "seller_id", "price", "total_item_value")
        .join(
            _delivered(orders, "order_purchase_timestamp", "order_delivered_customer_date"),
            "order_id",
        )
        .join(_review_scores(reviews), "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            _count().alias("total_items_sold"),
            X.exact_sum("price").alias("total_revenue"),
            X.exact_avg("price").alias("avg_item_price"),
            X.exact_sum("total_item_value").alias("total_gmv"),
            X.round_half_away(F.avg("avg_score"), 2).alias("avg_review_score"),
            F.count("reviewed").alias("total_reviewed_orders"),
            X.round_half_away(F.avg(delivery), 1).alias("avg_delivery_days"),
        )
    )
    all_sellers = (
        sellers.select("seller_id", "seller_city", "seller_state")
        .join(sold, "seller_id", "left")
        .fillna({"total_orders": 0, "total_items_sold": 1, "total_reviewed_orders": 0})
    )
    return global_dense_rank(
        durable(all_sellers, "sellers"), "total_revenue", "revenue_rank", descending=True
    )


def top_payment(payments: DataFrame) -> DataFrame:
    """The payment of highest value per order."""
    order = [
        F.col("payment_value").desc_nulls_last(),
        F.col("payment_sequential").asc_nulls_last(),
        F.col("payment_type").asc_nulls_last(),
    ]
    kept = payments.select("order_id", "payment_type", "payment_value", "payment_sequential")
    return top_per_key(kept, ["order_id"], order).select("order_id", "payment_type")


def payment_group(c: Column) -> Column:
    kind = X.clean_lower(F.coalesce(c, F.lit("")))
    return F.when(kind.isin(*PAYMENT_TYPES), kind).otherwise(OTHER_PAYMENT)


def payment_code(c: Column) -> Column:
    """Position in :data:`PAYMENT_TYPES`; the next number for any other type."""
    kind = X.clean_lower(F.coalesce(c, F.lit("")))
    at = F.array_position(F.array(*[F.lit(t) for t in PAYMENT_TYPES]), kind)
    return F.when(at > 0, at - 1).otherwise(len(PAYMENT_TYPES)).cast("int")


def reviews_features(reviews: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per review with the target and the model's features."""
    message = F.coalesce("review_comment_message", F.lit(""))
    return (
        reviews.where(F.col("review_score").isNotNull())
        .join(
            orders.select(
                "order_id",
                "customer_id",
                "order_status",
                "order_purchase_timestamp",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
            "order_id",
            "left",
        )
        .join(top_payment(payments), "order_id", "left")
        .select(
            "review_id",
            "order_id",
            "review_score",
            (F.col("review_score") >= 4).cast("int").alias("satisfied"),
            message.alias("review_comment_message"),
            F.length(message).alias("review_comment_length"),
            (F.length(X.trimmed(message)) > 0).alias("has_comment"),
            X.days_between(
                "order_estimated_delivery_date", "order_delivered_customer_date"
            ).alias("delivery_delay_days"),
            payment_group(F.col("payment_type")).alias("payment_type"),
            payment_code(F.col("payment_type")).alias("payment_type_encoded"),
            "order_status",
            "customer_id",
            "review_creation_date",
            "order_purchase_timestamp",
        )
    )


def build_gold(silver: dict[str, DataFrame], *, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """All five marts from the silver entities; the two that run jobs for their ranks run them side by side."""
    s = silver
    rfm, ranked = together(
        lambda: customer_rfm(s["orders"], s["customers"], s["order_items"], as_of=as_of),
        lambda: seller_ranking(s["sellers"], s["order_items"], s["orders"], s["reviews"]),
    )
    return {
        "orders_summary": orders_summary(s["orders"], s["customers"], s["order_items"]),
        "customer_rfm": rfm,
        "product_performance": product_performance(
            s["products"], s["order_items"], s["orders"], s["reviews"]
        ),
        "seller_ranking": ranked,
        "reviews_features": reviews_features(s["reviews"], s["orders"], s["payments"]),
    }
