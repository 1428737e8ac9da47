"""Pick one row per key, and draw a sample that stays joined up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.sources.durable import durable

_RN = "_rn"


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order``.

    Spark trims every map task's output to one row per key before the shuffle
    (``WindowGroupLimit``), so a key with very many rows is no hot spot.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) == 1).drop(_RN)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """Most recently loaded row of each key.

    Rows loaded at the same instant are told apart by batch id and then by
    every other column, so a rerun keeps the same row.
    """
    if order is None:
        order = [F.col("_loaded_at").desc_nulls_last()]
    if tiebreak is None:
        rest = [c for c in df.columns if c not in (*keys, "_loaded_at", "_batch_id")]
        tiebreak = [F.col("_batch_id").desc_nulls_last()] if "_batch_id" in df.columns else []
        tiebreak += [F.col(c).asc_nulls_last() for c in rest]
    return top_per_key(df, keys, [*order, *tiebreak])


def key_set(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Distinct non-null values of a column; duplicates go before the shuffle."""
    return df.select(F.col(column).alias(name or column)).where(
        F.col(name or column).isNotNull()
    ).distinct()


def consistent_sample(tables: dict[str, DataFrame], n: int = 100) -> dict[str, DataFrame]:
    """Sample ``n`` delivered orders and everything that belongs to them.

    ``tables`` holds orders, customers, order_items, payments, reviews,
    products and sellers. An order qualifies when it is delivered, has both
    delivery dates and has items, payments, a review and its customer. The
    lowest order ids are taken. The key frame has at most ``n`` rows.
    """
    orders = tables["orders"].where(
        (F.col("order_status") == "delivered")
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )
    for child in ("order_items", "payments", "reviews"):
        orders = orders.join(key_set(tables[child], "order_id"), "order_id", "left_semi")
    orders = orders.join(key_set(tables["customers"], "customer_id"), "customer_id", "left_semi")
    keys = orders.select("order_id").distinct().orderBy("order_id").limit(n)
    picked = F.broadcast(durable(keys, "sample"))  # at most n rows, found once

    sample = {
        name: tables[name].join(picked, "order_id", "left_semi")
        for name in ("orders", "order_items", "payments", "reviews")
    }
    # Parents: the sampled children name only a few of them.
    for parent, child, key in (
        ("customers", "orders", "customer_id"),
        ("products", "order_items", "product_id"),
        ("sellers", "order_items", "seller_id"),
    ):
        sample[parent] = tables[parent].join(key_set(sample[child], key), key, "left_semi")
    sample["customers"] = sample["customers"].distinct()
    return sample
