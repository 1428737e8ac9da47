"""Registered queries: data-quality checks and layer reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.entry.adapters import entity, with_sql
from tallyroom.entry.book import query
from tallyroom.operators import quality as Q
from tallyroom.plans import contract, gold, layers, silver
from tallyroom.sources.durable import durable, shared_root
from tallyroom.sources.readers import new_batch_id

RAW = (
    "orders", "customers", "order_items", "payments", "products", "reviews", "sellers",
    "exchange_rates", "category_translation",
)


def _raw(spark: SparkSession, d: str, *names: str) -> dict[str, DataFrame]:
    return {n: entity(spark, d, f"raw_{n}") for n in names or RAW}


@query(
    "check_not_null",
    with_sql("raw_order_items")
    + " SELECT order_id, seller_id, price FROM raw_order_items WHERE product_id IS NULL",
)
def check_not_null(spark: SparkSession, d: str) -> DataFrame:
    tables = _raw(spark, d, "order_items")
    return Q.failing_rows(Q.not_null("order_items", "product_id"), tables).select(
        "order_id", "seller_id", "price"
    )


@query(
    "check_unique",
    with_sql("raw_order_items")
    + """ SELECT order_id, count(*) AS n_rows FROM raw_order_items WHERE order_id IS NOT NULL
GROUP BY order_id HAVING count(*) > 1""",
)
def check_unique(spark: SparkSession, d: str) -> DataFrame:
    return Q.failing_rows(Q.unique("order_items", "order_id"), _raw(spark, d, "order_items"))


@query(
    "check_accepted_values",
    with_sql("raw_payments")
    + """ SELECT order_id, payment_type, payment_value FROM raw_payments
WHERE payment_type NOT IN ('credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined')""",
)
def check_accepted_values(spark: SparkSession, d: str) -> DataFrame:
    check = Q.accepted_values("payments", "payment_type", contract.PAYMENT_GROUPS)
    return Q.failing_rows(check, _raw(spark, d, "payments")).select(
        "order_id", "payment_type", "payment_value"
    )


@query(
    "check_relationships",
    with_sql("raw_payments", "raw_orders")
    + """ SELECT order_id, count(*) AS n_rows FROM raw_payments WHERE order_id IS NOT NULL
AND order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_id IS NOT NULL) GROUP BY order_id""",
)
def check_relationships(spark: SparkSession, d: str) -> DataFrame:
    check = Q.relationships("payments", "order_id", "orders", "order_id")
    return Q.failing_rows(check, _raw(spark, d, "payments", "orders"))


@query(
    "check_between",
    with_sql("shop_items")
    + """ SELECT order_id, product_id, price, freight_value FROM shop_items
WHERE freight_value <= 10 OR freight_value >= 8000""",
)
def check_between(spark: SparkSession, d: str) -> DataFrame:
    check = Q.between("items", "freight_value", 10, 8000, strict=True)
    return Q.failing_rows(check, {"items": entity(spark, d, "shop_items")}).select(
        "order_id", "product_id", "price", "freight_value"
    )


@query(
    "check_orphans",
    with_sql("raw_order_items", "raw_orders")
    + """ SELECT i.order_id, count(*) AS n_rows FROM raw_order_items AS i
LEFT JOIN (SELECT DISTINCT order_id FROM raw_orders) AS o ON i.order_id = o.order_id
WHERE o.order_id IS NULL GROUP BY i.order_id""",
)
def check_orphans(spark: SparkSession, d: str) -> DataFrame:
    return contract.items_without_order(_raw(spark, d, "order_items", "orders"))


@query(
    "layer_row_counts",
    with_sql(*[f"raw_{n}" for n in RAW])
    + " UNION ALL ".join(
        f" SELECT '{n}' AS table_name, count(*) AS n_rows FROM raw_{n}" for n in RAW
    ),
)
def layer_row_counts(spark: SparkSession, d: str) -> DataFrame:
    return Q.row_counts(_raw(spark, d))


_RAW_WIDTHS = {
    "orders": 11, "customers": 8, "order_items": 10, "payments": 8, "products": 12, "reviews": 10,
    "sellers": 7, "exchange_rates": 7, "category_translation": 5,
}


@query(
    "verify_bronze_layer",
    with_sql(*[f"raw_{n}" for n in RAW])
    + " UNION ALL ".join(
        f" SELECT '{n}' AS table_name, CAST({w} AS BIGINT) AS n_columns, count(*) AS n_rows,"
        f" '' AS missing_columns, true AS ok FROM raw_{n}"
        for n, w in _RAW_WIDTHS.items()
    )
    + """ UNION ALL SELECT 'untraced', CAST(4 AS BIGINT), count(*), '_batch_id, _loaded_at, _source_file', false
FROM raw_sellers""",
)
def verify_bronze_layer(spark: SparkSession, d: str) -> DataFrame:
    tables = _raw(spark, d)
    tables["untraced"] = tables["sellers"].drop(*Q.LINEAGE)
    return Q.verify_layer(tables)


@query(
    "rates_by_file",
    with_sql("raw_exchange_rates")
    + """ SELECT _source_file, base_currency, count(*) AS n_currencies FROM raw_exchange_rates
GROUP BY _source_file, base_currency""",
)
def rates_by_file(spark: SparkSession, d: str) -> DataFrame:
    return Q.rates_by_file(entity(spark, d, "raw_exchange_rates"))


def _first(source: str, key: str) -> str:
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _loaded_at DESC) AS rn FROM {source}) WHERE rn = 1"


_SILVER_SQL = f"""
, orders_v AS ({_first("(SELECT *, LOWER(TRIM(order_status)) AS st, TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS bought FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL)", "order_id")})
, customers_v AS ({_first("(SELECT * FROM raw_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL)", "customer_id")})
, products_v AS ({_first("(SELECT * FROM raw_products WHERE product_id IS NOT NULL)", "product_id")})
, sellers_v AS ({_first("(SELECT * FROM raw_sellers WHERE seller_id IS NOT NULL)", "seller_id")})
, reviews_v AS ({_first("(SELECT *, TRY_CAST(review_score AS INTEGER) AS sc FROM raw_reviews WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND TRY_CAST(review_score AS INTEGER) BETWEEN 1 AND 5)", "review_id")})
, items_v AS (SELECT *, TRY_CAST(price AS DOUBLE) AS amount FROM raw_order_items WHERE order_id IS NOT NULL
    AND product_id IS NOT NULL AND seller_id IS NOT NULL AND TRY_CAST(price AS DOUBLE) > 0)
, payments_v AS (SELECT *, LOWER(TRIM(payment_type)) AS kind FROM raw_payments WHERE order_id IS NOT NULL
    AND payment_type IS NOT NULL AND TRY_CAST(payment_value AS DOUBLE) >= 0)
, summary_v AS (SELECT DISTINCT customer_unique_id, customer_city, customer_state, date_trunc('month', bought) AS order_month
    FROM orders_v JOIN customers_v USING (customer_id)
    WHERE bought IS NOT NULL AND order_id IN (SELECT order_id FROM items_v))
, rfm_v AS (SELECT DISTINCT customer_unique_id FROM orders_v JOIN customers_v USING (customer_id)
    WHERE bought IS NOT NULL AND st = 'delivered' AND order_id IN (SELECT order_id FROM items_v))
, top_v AS (SELECT order_id, kind FROM (SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY TRY_CAST(payment_value AS DOUBLE) DESC NULLS LAST, TRY_CAST(payment_sequential AS INTEGER) NULLS LAST, kind NULLS LAST) AS rn
    FROM payments_v) WHERE rn = 1)
, features_v AS (SELECT review_id, CASE WHEN sc >= 4 THEN 1 ELSE 0 END AS satisfied,
    length(coalesce(review_comment_message, '')) AS review_comment_length,
    length(trim(coalesce(review_comment_message, ''))) > 0 AS has_comment,
    CASE WHEN kind IN ('credit_card', 'boleto', 'voucher', 'debit_card') THEN kind ELSE 'not_defined' END AS payment_type
    FROM reviews_v LEFT JOIN top_v USING (order_id))
"""


def _line(check: str, table: str, column: str, failing: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,"
        f" CAST(({failing}) AS BIGINT) AS failing_rows"
    )


def _nn(table: str, column: str, source: str, expression: str | None = None) -> str:
    return _line("not_null", table, column, f"SELECT count(*) FROM {source} WHERE {expression or column} IS NULL")


def _un(table: str, column: str, source: str) -> str:
    return _line(
        "unique", table, column,
        f"SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)",
    )


def _rel(table: str, column: str, source: str, parent: str) -> str:
    return _line(
        "relationships", table, column,
        f"SELECT count(*) FROM {source} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent} WHERE {column} IS NOT NULL)",
    )


_STATUSES = ", ".join(f"'{s}'" for s in contract.ORDER_STATUSES)
_REPORT_SQL = " UNION ALL ".join(
    [
        _nn("orders", "order_id", "orders_v"), _un("orders", "order_id", "orders_v"),
        _nn("orders", "customer_id", "orders_v"), _rel("orders", "customer_id", "orders_v", "customers_v"),
        _line("accepted_values", "orders", "order_status", f"SELECT count(*) FROM orders_v WHERE st NOT IN ({_STATUSES})"),
        _nn("orders", "order_purchase_timestamp", "orders_v", "bought"),
        _nn("customers", "customer_id", "customers_v"), _un("customers", "customer_id", "customers_v"),
        _nn("customers", "customer_unique_id", "customers_v"),
        _nn("products", "product_id", "products_v"), _un("products", "product_id", "products_v"),
        _nn("reviews", "review_id", "reviews_v"), _un("reviews", "review_id", "reviews_v"),
        _nn("reviews", "order_id", "reviews_v"), _rel("reviews", "order_id", "reviews_v", "orders_v"),
        _nn("reviews", "review_score", "reviews_v", "sc"),
        _line("between", "reviews", "review_score", "SELECT count(*) FROM reviews_v WHERE sc NOT BETWEEN 1 AND 5"),
        _nn("payments", "order_id", "payments_v"), _rel("payments", "order_id", "payments_v", "orders_v"),
        _line("accepted_values", "payments", "payment_type",
              "SELECT count(*) FROM payments_v WHERE kind NOT IN ('credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined')"),
        _nn("sellers", "seller_id", "sellers_v"), _un("sellers", "seller_id", "sellers_v"),
        _nn("order_items", "order_id", "items_v"), _rel("order_items", "order_id", "items_v", "orders_v"),
        _nn("order_items", "product_id", "items_v"), _rel("order_items", "product_id", "items_v", "products_v"),
        _line("between", "order_items", "price", "SELECT count(*) FROM items_v WHERE amount <= 0"),
        _line("items_without_order", "order_items", "order_id",
              "SELECT count(*) FROM items_v AS i LEFT JOIN orders_v AS o ON i.order_id = o.order_id WHERE o.order_id IS NULL"),
        _line("items_without_price", "order_items", "price", "SELECT count(*) FROM items_v WHERE amount <= 0"),
        _line("scores_out_of_range", "reviews", "review_score", "SELECT count(*) FROM reviews_v WHERE sc NOT BETWEEN 1 AND 5"),
        _nn("orders_summary", "customer_unique_id", "summary_v"),
        _rel("orders_summary", "customer_unique_id", "summary_v", "customers_v"),
        _nn("orders_summary", "order_month", "summary_v"),
        _nn("customer_rfm", "customer_unique_id", "rfm_v"), _un("customer_rfm", "customer_unique_id", "rfm_v"),
        _rel("customer_rfm", "customer_unique_id", "rfm_v", "customers_v"),
        _nn("product_performance", "product_id", "products_v"), _un("product_performance", "product_id", "products_v"),
        _rel("product_performance", "product_id", "products_v", "products_v"),
        _nn("seller_ranking", "seller_id", "sellers_v"), _un("seller_ranking", "seller_id", "sellers_v"),
        _rel("seller_ranking", "seller_id", "sellers_v", "sellers_v"),
        _nn("reviews_features", "review_id", "reviews_v"), _un("reviews_features", "review_id", "reviews_v"),
        _rel("reviews_features", "review_id", "features_v", "reviews_v"), _nn("reviews_features", "satisfied", "features_v"),
        _line("accepted_values", "reviews_features", "satisfied", "SELECT count(*) FROM features_v WHERE satisfied NOT IN (0, 1)"),
        _nn("reviews_features", "review_score", "reviews_v", "sc"),
        _line("between", "reviews_features", "review_score", "SELECT count(*) FROM reviews_v WHERE sc NOT BETWEEN 1 AND 5"),
        _line("accepted_values", "reviews_features", "has_comment", "SELECT count(*) FROM features_v WHERE has_comment NOT IN (true, false)"),
        _line("between", "reviews_features", "review_comment_length", "SELECT count(*) FROM features_v WHERE review_comment_length < 0"),
        _nn("reviews_features", "payment_type", "features_v"),
        _line("accepted_values", "reviews_features", "payment_type",
              "SELECT count(*) FROM features_v WHERE payment_type NOT IN ('credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined')"),
    ]
)
_BRONZE_REPORT_SQL = " UNION ALL ".join(
    _nn(c.table, c.column, f"raw_{c.table}") for c in contract.BRONZE_CHECKS
)


@query(
    "quality_report",
    with_sql(*[f"raw_{n}" for n in RAW])
    + _SILVER_SQL
    + f"SELECT *, failing_rows = 0 AS passed FROM ({_REPORT_SQL})",
)
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    """All three layers built from the flawed raw tables, and every check on
    silver and gold: those of single rows while the tables are written."""
    write = lambda name, df: durable(df, f"layer-{name}")
    written, report = Q.checked_writes(silver.build_silver(_raw(spark, d)), contract.SILVER_CHECKS, write)
    _, gold_report = Q.checked_writes(gold.build_gold(written), contract.GOLD_CHECKS, write, written)
    return report.unionByName(gold_report)


@query(
    "bronze_quality_report",
    with_sql(*[f"raw_{n}" for n in RAW])
    + f" SELECT *, failing_rows = 0 AS passed FROM ({_BRONZE_REPORT_SQL})",
)
def bronze_quality_report(spark: SparkSession, d: str) -> DataFrame:
    return Q.run_checks(_raw(spark, d), contract.BRONZE_CHECKS)


@query(
    "gated_build",
    with_sql("raw_sellers", "raw_customers")
    + f"""
, sellers_v AS ({_first("(SELECT * FROM raw_sellers WHERE seller_id IS NOT NULL)", "seller_id")})
, customers_v AS ({_first("(SELECT * FROM raw_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL)", "customer_id")})
SELECT 'customers' AS table_name, count(*) AS n_rows, true AS refused FROM customers_v
UNION ALL SELECT 'sellers', count(*), true FROM sellers_v""",
)
def gated_build(spark: SparkSession, d: str) -> DataFrame:
    """A layer whose next generation breaks the contract: readers keep the one before."""
    root = f"{shared_root(spark)}/gated-{new_batch_id()}"
    checks = [c for c in contract.SILVER_CHECKS if c.table in ("sellers", "customers") and not c.parent]
    raw = _raw(spark, d, "sellers", "customers")
    good = {"sellers": silver.silver_sellers(raw["sellers"]), "customers": silver.silver_customers(raw["customers"])}
    layers.build_layer(spark, good, checks, root)
    twice = {**good, "sellers": good["sellers"].unionByName(good["sellers"])}
    refused = False
    try:
        layers.build_layer(spark, twice, checks, root)
    except Q.QualityError:
        refused = True
    counts = Q.row_counts(layers.current_layer(spark, root))
    return counts.withColumn("refused", F.lit(refused))
