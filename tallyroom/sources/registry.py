"""What can be loaded: one entry per raw entity."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Entity:
    name: str
    folder: str  # below the data root
    files: str  # file name or glob
    format: str  # csv, json or rates
    columns: tuple[str, ...] = ()
    key: tuple[str, ...] = ()  # natural key; a hint, loads only append

    @property
    def table(self) -> str:
        return f"raw_{self.name}"


# File names (without the data set's own prefix) and columns.
_ENTITIES = (
    Entity(
        "customers", "csv", "*_customers_dataset.csv", "csv",
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
         "customer_state"),
        ("customer_id",),
    ),
    Entity(
        "orders", "csv", "*_orders_dataset.csv", "csv",
        ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
         "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
         "order_estimated_delivery_date"),
        ("order_id",),
    ),
    Entity(
        "order_items", "csv", "*_order_items_dataset.csv", "csv",
        ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
         "freight_value"),
    ),
    Entity(
        "payments", "csv", "*_order_payments_dataset.csv", "csv",
        ("order_id", "payment_sequential", "payment_type", "payment_installments",
         "payment_value"),
    ),
    Entity(
        "reviews", "csv", "*_order_reviews_dataset.csv", "csv",
        ("review_id", "order_id", "review_score", "review_comment_title",
         "review_comment_message", "review_creation_date", "review_answer_timestamp"),
        ("review_id",),
    ),
    Entity(
        "products", "csv", "*_products_dataset.csv", "csv",
        ("product_id", "product_category_name", "product_name_lenght",
         "product_description_lenght", "product_photos_qty", "product_weight_g",
         "product_length_cm", "product_height_cm", "product_width_cm"),
        ("product_id",),
    ),
    Entity(
        "sellers", "csv", "*_sellers_dataset.csv", "csv",
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        ("seller_id",),
    ),
    Entity(
        "geolocation", "csv", "*_geolocation_dataset.csv", "csv",
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
         "geolocation_city", "geolocation_state"),
    ),
    Entity(
        "category_translation", "csv", "product_category_name_translation.csv", "csv",
        ("product_category_name", "product_category_name_english"),
        ("product_category_name",),
    ),
    Entity("products_json", "json", "products_sample.json", "json", (), ("product_id",)),
    Entity("exchange_rates", "api", "exchange_rates*.json", "rates"),
)

ENTITIES: dict[str, Entity] = {e.name: e for e in _ENTITIES}
