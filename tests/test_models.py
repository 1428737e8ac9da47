"""Silver and gold models on small hand-made lakes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyroom.operators.dedup import consistent_sample, latest_per_key
from tallyroom.plans import gold, silver

STAMP = "_loaded_at string, _source_file string, _batch_id string"


def frame(spark, columns, rows):
    return spark.createDataFrame(rows, columns)


def raw_orders(spark, rows):
    names = [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ]
    return frame(spark, ", ".join(f"{n} string" for n in names) + ", " + STAMP, rows)


def order(oid, status, batch, cid="c1"):
    return (oid, cid, status, "2018-01-02 03:04:05", "", "", "x", None, f"2024-0{batch}-01", "f.csv", f"b{batch}")


def test_later_batch_wins_whatever_the_order(spark):
    rows = [order("o1", " Created", 1), order("o1", "DELIVERED ", 2), order(None, "x", 2), order("", "y", 1)]
    for given in (rows, rows[::-1]):
        got = {r.order_id: r.order_status for r in silver.silver_orders(raw_orders(spark, given)).collect()}
        assert got == {"o1": "delivered", "": "y"}


def test_dedup_is_idempotent_and_ties_are_stable(spark):
    rows = [("k", "2024", "b", v) for v in ("z", "a", "m")]
    df = frame(spark, "k string, _loaded_at string, _batch_id string, v string", rows)
    once = latest_per_key(df, ["k"])
    assert [r.v for r in once.collect()] == ["a"]
    assert once.collect() == latest_per_key(once, ["k"]).collect()


def test_items_price_rules_and_optional_dedup(spark):
    def item(n, price, freight="1.25", batch=1):
        return ("o", n, "p", "s", "2018-01-01", price, freight, f"2024-0{batch}-01", "f", f"b{batch}")

    rows = [item("1", "10.5"), item("1", "10.5", batch=2), item("2", "0"), item("3", "-1"), item("4", "abc"), item("5", "2", "")]
    raw = frame(
        spark,
        "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string, "
        "price string, freight_value string, " + STAMP,
        rows,
    )
    faithful = silver.silver_order_items(raw).collect()
    assert sorted((r.order_item_id, r.total_item_value) for r in faithful if r.order_item_id == 1) == [(1, 11.75)] * 2
    assert [r.total_item_value for r in faithful if r.order_item_id == 5] == [None]
    assert silver.silver_order_items(raw, dedup_keys=("order_id", "order_item_id")).count() == 2


def test_products_without_translation_and_repeated_translations(spark):
    names = list(silver.PRODUCT_COUNTS) + list(silver.PRODUCT_MEASURES)
    schema = "product_id string, product_category_name string, " + ", ".join(f"{n} string" for n in names) + ", " + STAMP
    tail = ("40", "1.5", "x", "100", "", "2.5", "nan?", "2024-01-01", "f", "b1")
    raw = frame(spark, schema, [("p1", "toys", *tail), ("p2", "rare ", *tail), ("p3", None, *tail)])
    translation = frame(
        spark,
        "product_category_name string, product_category_name_english string, " + STAMP,
        [("toys", "old toys", "2024-01-01", "f", "b1"), ("toys", "playthings", "2024-02-01", "f", "b2")],
    )
    got = {r.product_id: r for r in silver.silver_products(raw, translation).collect()}
    assert len(got) == 3
    assert got["p1"].product_category_name_english == "playthings"
    assert (got["p2"].product_category_name, got["p2"].product_category_name_english) == ("rare", "rare ")
    assert got["p3"].product_category_name_english is None
    assert got["p1"].product_description_length == 2 and got["p1"].product_photos_qty is None


def test_review_scores(spark):
    schema = (
        "review_id string, order_id string, review_score string, review_comment_title string, "
        "review_comment_message string, review_creation_date string, review_answer_timestamp string, " + STAMP
    )
    rows = [(f"r{s}", "o", s, " ", " ", "2018-01-01", "never", "2024", "f", "b") for s in ("0", "1", "4.6", "6", "", "x")]
    got = {r.review_id: r for r in silver.silver_reviews(frame(spark, schema, rows)).collect()}
    assert {k: v.review_score for k, v in got.items()} == {"r1": 1, "r4.6": 5}
    assert got["r1"].review_comment_message is None and got["r1"].review_answer_timestamp is None


@pytest.fixture(scope="module")
def shop(spark):
    t = dt.datetime
    orders = frame(
        spark,
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
        [
            ("o1", "c1", "delivered", t(2018, 1, 31, 23), t(2018, 2, 2, 1), t(2018, 2, 5)),
            ("o2", "c2", "delivered", t(2018, 3, 1), t(2018, 3, 9), t(2018, 3, 5)),
            ("o3", "c3", "canceled", t(2018, 3, 2), None, t(2018, 3, 20)),
            ("o4", "c3", "delivered", t(2018, 4, 1), t(2018, 4, 2), t(2018, 4, 3)),  # no items
            ("o5", "c3", "delivered", None, None, None),
        ],
    )
    customers = frame(
        spark,
        "customer_id string, customer_unique_id string, customer_city string, customer_state string",
        [("c1", "u1", "rio", "RJ"), ("c2", "u1", "sao", "SP"), ("c3", "u2", "lima", "LI")],
    )
    items = frame(
        spark,
        "order_id string, product_id string, seller_id string, price double, freight_value double, total_item_value double",
        [
            ("o1", "p1", "s1", 10.0, 1.0, 11.0),
            ("o1", "p1", "s1", 10.0, 1.0, 11.0),
            ("o2", "p2", "s1", 30.0, None, None),
            ("o3", "p1", "s2", 7.0, 1.0, 8.0),
        ],
    )
    products = frame(spark, "product_id string, product_category_name_english string", [("p1", "toys"), ("p2", None), ("p9", "unsold")])
    sellers = frame(spark, "seller_id string, seller_city string, seller_state string", [("s1", "a", "A"), ("s2", "b", "B"), ("s9", "c", "C")])
    reviews = frame(
        spark,
        "review_id string, order_id string, review_score int, review_comment_message string, review_creation_date timestamp_ntz",
        [("r1", "o1", 5, "good", None), ("r2", "o1", 2, None, None), ("r3", "o2", 4, "  ", None), ("r4", "gone", 3, "", None)],
    )
    payments = frame(
        spark,
        "order_id string, payment_sequential int, payment_type string, payment_value double",
        [("o1", 2, "voucher", 11.0), ("o1", 1, " Boleto ", 11.0), ("o2", 1, "crypto", 1.0)],
    )
    return {
        "orders": orders, "customers": customers, "order_items": items, "products": products,
        "sellers": sellers, "reviews": reviews, "payments": payments,
    }


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_orders_summary(shop):
    rows = gold.orders_summary(shop["orders"], shop["customers"], shop["order_items"]).collect()
    got = {(r.customer_unique_id, str(r.order_month)): r for r in rows}
    assert set(got) == {("u1", "2018-01-01"), ("u1", "2018-03-01"), ("u2", "2018-03-01")}
    first = got["u1", "2018-01-01"]
    assert (first.total_items, first.total_revenue, first.avg_order_value, first.delivered_orders) == (2, 22.0, 22.0, 1)
    assert got["u1", "2018-03-01"].total_revenue is None
    assert got["u2", "2018-03-01"].canceled_orders == 1


def test_customer_rfm(shop):
    got = by(gold.customer_rfm(shop["orders"], shop["customers"], shop["order_items"], as_of=dt.date(2018, 3, 11)), "customer_unique_id")
    assert set(got) == {"u1"}  # u2 has no delivered order with items
    row = got["u1"]
    assert (row.frequency, row.recency_days, row.customer_city, row.monetary_value) == (2, 10, "sao", 22.0)
    assert (row.r_score, row.f_score, row.m_score) == (1, 1, 1)


def test_rfm_place_comes_from_any_delivered_order(spark, shop):
    more = shop["order_items"].union(spark.createDataFrame([("o4", "p1", "s1", 1.0, 1.0, 2.0)], shop["order_items"].schema))
    later = shop["orders"].withColumn("customer_id", F.when(F.col("order_id") == "o4", "c1").otherwise(F.col("customer_id")))
    with_items = by(gold.customer_rfm(later, shop["customers"], more), "customer_unique_id")
    without = by(gold.customer_rfm(later, shop["customers"], shop["order_items"]), "customer_unique_id")
    assert with_items["u1"].customer_city == without["u1"].customer_city == "rio"
    assert (with_items["u1"].frequency, without["u1"].frequency) == (3, 2)


def test_product_performance_keeps_unsold(shop):
    got = by(gold.product_performance(shop["products"], shop["order_items"], shop["orders"], shop["reviews"]), "product_id")
    assert (got["p1"].total_orders, got["p1"].total_items_sold, got["p1"].total_revenue) == (1, 2, 20.0)
    assert (got["p1"].avg_review_score, got["p1"].total_reviewed_orders) == (3.5, 2)
    assert (got["p9"].total_orders, got["p9"].total_items_sold, got["p9"].total_revenue) == (0, 1, None)
    assert got["p9"].total_reviewed_orders == 0


def test_seller_ranking(shop):
    got = by(gold.seller_ranking(shop["sellers"], shop["order_items"], shop["orders"], shop["reviews"]), "seller_id")
    assert (got["s1"].revenue_rank, got["s2"].revenue_rank, got["s9"].revenue_rank) == (1, 2, 2)
    assert (got["s1"].total_orders, got["s1"].total_items_sold, got["s1"].avg_delivery_days) == (2, 3, 4.0)
    assert got["s2"].total_items_sold == 1 and got["s2"].total_revenue is None


def test_reviews_features(shop):
    got = by(gold.reviews_features(shop["reviews"], shop["orders"], shop["payments"]), "review_id")
    assert (got["r1"].satisfied, got["r2"].satisfied) == (1, 0)
    assert (got["r1"].payment_type, got["r1"].payment_type_encoded) == ("boleto", 1)  # tie: lower sequence
    assert (got["r3"].payment_type, got["r3"].payment_type_encoded) == ("not_defined", 4)
    assert (got["r4"].payment_type_encoded, got["r4"].delivery_delay_days) == (4, None)
    assert (got["r1"].delivery_delay_days, got["r3"].delivery_delay_days) == (-3, 4)
    assert (got["r3"].has_comment, got["r3"].review_comment_length) == (False, 2)
    assert (got["r2"].review_comment_message, got["r2"].has_comment) == ("", False)


def test_gold_sums_equal_silver_sums(shop):
    summary = gold.orders_summary(shop["orders"], shop["customers"], shop["order_items"])
    assert summary.agg(F.sum("total_product_revenue")).first()[0] == 57.0
    assert summary.agg(F.sum("total_items")).first()[0] == 4


def test_models_take_empty_input(spark, shop):
    empty = {n: df.limit(0) for n, df in shop.items()}
    for name, df in gold.build_gold(empty).items():
        assert df.count() == 0, name


def test_consistent_sample(shop):
    drawn = consistent_sample(shop, n=1)
    assert [r.order_id for r in drawn["orders"].collect()] == ["o1"]
    assert {n: df.count() for n, df in drawn.items()} == {
        "orders": 1, "order_items": 2, "payments": 2, "reviews": 2, "customers": 1, "products": 1, "sellers": 1,
    }
