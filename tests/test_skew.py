"""One key with a third of all rows: split joins give the same marts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyroom.operators.dedup import latest_per_key
from tallyroom.plans import gold

# Split every partition above a few hundred bytes and never broadcast.
FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500b",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1kb",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def forced_splits(spark):
    before = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shop(spark):
    n = F.col("id")
    hot = n % 3 == 0
    when = F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz")
    items = spark.range(3000).select(
        F.when(hot, 0).otherwise(n).alias("order_id"),
        F.when(hot, n % 50).otherwise(0).alias("product_id"),
        F.when(hot, 0).otherwise(n % 40).alias("seller_id"),
        (n % 97 + 0.25).alias("price"),
        F.lit(1.5).alias("freight_value"),
        (n % 97 + 1.75).alias("total_item_value"),
    )
    orders = spark.range(3000).select(
        n.alias("order_id"),
        F.when(hot, 0).otherwise(n).alias("customer_id"),
        F.when(n % 5 == 1, "canceled").otherwise("delivered").alias("order_status"),
        (when + F.make_dt_interval(days=(n % 300).cast("int"))).alias("order_purchase_timestamp"),
        (when + F.make_dt_interval(days=(n % 310).cast("int"))).alias("order_delivered_customer_date"),
        when.alias("order_estimated_delivery_date"),
    )
    customers = spark.range(3000).select(
        n.alias("customer_id"),
        F.when(hot, 0).otherwise(n).alias("customer_unique_id"),
        F.concat(F.lit("city"), n).alias("customer_city"),
        F.lit("S").alias("customer_state"),
    )
    products = spark.range(60).select(n.alias("product_id"), F.lit("c").alias("product_category_name_english"))
    sellers = spark.range(60).select(n.alias("seller_id"), F.lit("x").alias("seller_city"), F.lit("y").alias("seller_state"))
    reviews = spark.range(3000).select(
        n.alias("review_id"),
        F.when(hot, 0).otherwise(n).alias("order_id"),
        (n % 5 + 1).cast("int").alias("review_score"),
        F.lit("text").alias("review_comment_message"),
        when.alias("review_creation_date"),
    )
    payments = spark.range(3000).select(
        F.when(hot, 0).otherwise(n).alias("order_id"),
        n.cast("int").alias("payment_sequential"),
        F.element_at(F.array(*[F.lit(t) for t in gold.PAYMENT_TYPES]), (n % 4 + 1).cast("int")).alias("payment_type"),
        (n % 7).cast("double").alias("payment_value"),
    )
    return {
        "orders": orders, "customers": customers, "order_items": items, "products": products,
        "sellers": sellers, "reviews": reviews, "payments": payments,
    }


def rows_of(marts):
    return {name: sorted(map(str, df.collect())) for name, df in marts.items()}


def test_split_joins_change_nothing(spark, forced_splits):
    as_of = dt.date(2021, 1, 1)
    split = rows_of(gold.build_gold(shop(spark), as_of=as_of))
    for k in FORCED:
        spark.conf.unset(k)
    assert rows_of(gold.build_gold(shop(spark), as_of=as_of)) == split


def test_totals_of_the_hot_keys(spark, forced_splits):
    s = shop(spark)
    sold = gold.product_performance(s["products"], s["order_items"], s["orders"], s["reviews"])
    hot = {r.product_id: r for r in sold.collect()}[0]
    assert "skew=true" in sold._jdf.queryExecution().executedPlan().toString()
    delivered = [i for i in range(3000) if i % 3 and i % 5 != 1] + [i for i in range(0, 3000, 3) if i % 50 == 0]
    assert hot.total_items_sold == len(delivered)
    assert hot.total_revenue == sum(i % 97 + 0.25 for i in delivered)
    assert hot.total_orders == len([i for i in delivered if i % 3]) + 1


def test_latest_row_of_a_hot_key(spark, forced_splits):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("_loaded_at"),
        F.lit("b").alias("_batch_id"),
    )
    plan = latest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert latest_per_key(df, ["k"]).where("k = ''").first()._loaded_at == "999"
    assert latest_per_key(df, ["k"]).count() == 4001
