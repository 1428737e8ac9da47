"""Raw text tables to clean entities.

Each function takes bronze frames (all text, with lineage columns) and
returns the typed entity. Rows without their key are dropped; a cell that
cannot be read becomes NULL; entities with a key keep their latest row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.functions import exprs as X
from tallyroom.operators.dedup import latest_per_key
from tallyroom.operators.quality import LINEAGE

# Raw column to clean column; the raw spelling "lenght" is what the files hold.
PRODUCT_COUNTS = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
    "product_photos_qty": "product_photos_qty",
}
PRODUCT_MEASURES = (
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)
ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def _keyed(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows where a required key is NULL; empty text passes."""
    return df.dropna(subset=list(columns))


def silver_orders(bronze: DataFrame) -> DataFrame:
    typed = _keyed(bronze, "order_id", "customer_id").select(
        "order_id",
        "customer_id",
        X.clean_lower("order_status").alias("order_status"),
        *[X.safe_timestamp(c).alias(c) for c in ORDER_TIMES],
        *LINEAGE,
    )
    return latest_per_key(typed, ["order_id"])


def silver_customers(bronze: DataFrame) -> DataFrame:
    typed = _keyed(bronze, "customer_id", "customer_unique_id").select(
        "customer_id",
        "customer_unique_id",
        X.trimmed("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        X.clean_lower("customer_city").alias("customer_city"),
        X.clean_upper("customer_state").alias("customer_state"),
        *LINEAGE,
    )
    return latest_per_key(typed, ["customer_id"])


def silver_order_items(bronze: DataFrame, dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """Item rows. Reloaded files repeat them unless ``dedup_keys`` is given,
    for example ``("order_id", "order_item_id")``."""
    typed = (
        _keyed(bronze, "order_id", "product_id", "seller_id")
        .select(
            "order_id",
            X.safe_int("order_item_id").alias("order_item_id"),
            "product_id",
            "seller_id",
            X.safe_timestamp("shipping_limit_date").alias("shipping_limit_date"),
            X.safe_double("price").alias("price"),
            X.safe_double("freight_value").alias("freight_value"),
            *LINEAGE,
        )
        .where(F.col("price") > 0)
        .select(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "shipping_limit_date",
            "price",
            "freight_value",
            (F.col("price") + F.col("freight_value")).alias("total_item_value"),
            *LINEAGE,
        )
    )
    return latest_per_key(typed, dedup_keys) if dedup_keys else typed


def silver_payments(bronze: DataFrame, dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """Payment rows; ``dedup_keys`` as for items, for example
    ``("order_id", "payment_sequential")``."""
    typed = (
        _keyed(bronze, "order_id", "payment_type")
        .select(
            "order_id",
            X.safe_int("payment_sequential").alias("payment_sequential"),
            X.clean_lower("payment_type").alias("payment_type"),
            X.safe_int("payment_installments").alias("payment_installments"),
            X.safe_double("payment_value").alias("payment_value"),
            *LINEAGE,
        )
        .where(F.col("payment_value") >= 0)
    )
    return latest_per_key(typed, dedup_keys) if dedup_keys else typed


def silver_products(bronze: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with an English category.

    Translations loaded several times are reduced to the latest per category
    first, so the join adds no rows. The match is on the raw category text.
    """
    english = latest_per_key(translation, ["product_category_name"]).select(
        "product_category_name", "product_category_name_english"
    )
    named = _keyed(bronze, "product_id").join(english, "product_category_name", "left")
    typed = named.select(
        "product_id",
        X.trimmed("product_category_name").alias("product_category_name"),
        F.coalesce("product_category_name_english", "product_category_name").alias(
            "product_category_name_english"
        ),
        *[X.safe_int(raw).alias(clean) for raw, clean in PRODUCT_COUNTS.items()],
        *[X.safe_double(c).alias(c) for c in PRODUCT_MEASURES],
        *LINEAGE,
    )
    return latest_per_key(typed, ["product_id"])


def silver_reviews(bronze: DataFrame) -> DataFrame:
    typed = (
        _keyed(bronze, "review_id", "order_id")
        .select(
            "review_id",
            "order_id",
            X.safe_int("review_score").alias("review_score"),
            X.blank_to_null("review_comment_title").alias("review_comment_title"),
            X.blank_to_null("review_comment_message").alias("review_comment_message"),
            X.safe_timestamp("review_creation_date").alias("review_creation_date"),
            X.safe_timestamp("review_answer_timestamp").alias("review_answer_timestamp"),
            *LINEAGE,
        )
        .where(F.col("review_score").between(1, 5))
    )
    return latest_per_key(typed, ["review_id"])


def silver_sellers(bronze: DataFrame) -> DataFrame:
    typed = _keyed(bronze, "seller_id").select(
        "seller_id",
        X.trimmed("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        X.clean_lower("seller_city").alias("seller_city"),
        X.clean_upper("seller_state").alias("seller_state"),
        *LINEAGE,
    )
    return latest_per_key(typed, ["seller_id"])


def build_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All seven entities from the bronze tables of the same names."""
    return {
        "orders": silver_orders(bronze["orders"]),
        "customers": silver_customers(bronze["customers"]),
        "order_items": silver_order_items(bronze["order_items"]),
        "payments": silver_payments(bronze["payments"]),
        "products": silver_products(bronze["products"], bronze["category_translation"]),
        "reviews": silver_reviews(bronze["reviews"]),
        "sellers": silver_sellers(bronze["sellers"]),
    }
