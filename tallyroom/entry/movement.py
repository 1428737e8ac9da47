"""Registered queries: files in, files out, streams."""

from __future__ import annotations

from functools import partial

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.entry.adapters import entity, table, with_sql
from tallyroom.entry.book import plain, query
from tallyroom.operators import quality as Q
from tallyroom.plans.learning import TrainConfig
from tallyroom.sources import sinks
from tallyroom.sources.durable import shared_root, together
from tallyroom.sources.loads import LakePaths, load_all
from tallyroom.sources.readers import new_batch_id, read_csv_entity, read_exchange_rates, read_json_records, text_schema
from tallyroom.sources.registry import ENTITIES
from tallyroom.sources.upsert import KeyedTable, read_keyed, upsert
from tallyroom.streaming.ingest import ingest_stream, quarantine
from tallyroom.streaming.score import score_stream


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{new_batch_id()}"


def _files(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A raw entity with just the columns a delivered file has."""
    return entity(spark, d, f"raw_{name}").select(*ENTITIES[name].columns)


def _as_text(name: str) -> str:
    return ", ".join(f"coalesce({c}, '') AS {c}" for c in ENTITIES[name].columns)


@query("csv_round_trip", with_sql("raw_reviews") + f" SELECT {_as_text('reviews')} FROM raw_reviews")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Export as CSV (texts hold quotes, commas and line ends) and read again."""
    path = _folder(spark, "csv")
    sinks.write_csv(_files(spark, d, "reviews"), path)
    back = read_csv_entity(spark, "reviews", path, batch_id="b", loaded_at="now")
    return back.select(*ENTITIES["reviews"].columns)


@query(
    "bronze_append",
    with_sql("raw_orders")
    + """ SELECT _batch_id, _loaded_at, count(*) AS n_rows, count(order_id) AS n_keys,
    count(CASE WHEN _batch_id = 'second' THEN 1 END) AS n_with_note FROM raw_orders GROUP BY _batch_id, _loaded_at""",
)
def bronze_append(spark: SparkSession, d: str) -> DataFrame:
    """Append two batches, the second with one more column, and read them as one."""
    raw, path = entity(spark, d, "raw_orders"), _folder(spark, "bronze")
    sinks.append_bronze(raw.where(F.col("_batch_id") == "first"), path)
    second = raw.where(F.col("_batch_id") == "second").withColumn("note", F.lit("new"))
    sinks.append_bronze(second, path)
    return (
        sinks.read_bronze(spark, path)
        .groupBy("_batch_id", "_loaded_at")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("order_id").alias("n_keys"),
            F.count("note").alias("n_with_note"),
        )
    )


_LOADED = ("customers", "orders", "order_items", "payments", "reviews", "products", "sellers", "category_translation")
_FILE_NAMES = {
    "customers": "shop_customers_dataset.csv", "orders": "shop_orders_dataset.csv",
    "order_items": "shop_order_items_dataset.csv", "payments": "shop_order_payments_dataset.csv",
    "reviews": "shop_order_reviews_dataset.csv", "products": "shop_products_dataset.csv",
    "sellers": "shop_sellers_dataset.csv", "category_translation": "product_category_name_translation.csv",
}


@query(
    "load_all_report",
    with_sql(*[f"raw_{n}" for n in _LOADED])
    + " UNION ALL ".join(
        f" SELECT '{n}' AS name, 'raw_{n}' AS table_name, true AS success, count(*) AS n_rows, false AS has_error"
        f" FROM raw_{n}"
        for n in _LOADED
    )
    + " UNION ALL SELECT 'geolocation', 'raw_geolocation', false, 0, true"
    + " UNION ALL SELECT 'products_json', 'raw_products_json', false, 0, true",
)
def load_all_report(spark: SparkSession, d: str) -> DataFrame:
    """Deliver the raw tables as files and load them; two sources are absent."""
    root = _folder(spark, "lake")
    files = {f"{root}/data/csv/{file}": _files(spark, d, name) for name, file in _FILE_NAMES.items()}
    together(*[partial(sinks.write_csv, df, path, gzip=True) for path, df in files.items()])
    paths = LakePaths(f"{root}/data", f"{root}/bronze")
    report = load_all(spark, paths, names=(*_LOADED, "geolocation", "products_json"))
    return report.select("name", "table_name", "success", "n_rows", (F.col("error") != "").alias("has_error"))


@query(
    "incremental_bronze",
    with_sql("raw_payments") + f" SELECT {_as_text('payments')} FROM raw_payments",
)
def incremental_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Stream delivered files into bronze in two rounds; each file lands once."""
    root, raw = _folder(spark, "stream"), entity(spark, d, "raw_payments")
    columns = ENTITIES["payments"].columns
    early = F.coalesce(F.col("order_id").try_cast("bigint") < 5000, F.lit(False))
    for part in (raw.where(early), raw.where(~early)):
        sinks.write_csv(part.select(*columns), f"{root}/src", mode="append")
        ingest_stream(spark, "payments", f"{root}/src", f"{root}/bronze", f"{root}/state").awaitTermination()
    return sinks.read_bronze(spark, f"{root}/bronze").select(*columns)


def _documents(df: DataFrame, path: str) -> None:
    """One file per row of text."""
    df.write.option("maxRecordsPerFile", 1).text(path)


@query(
    "read_json_records",
    """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_brand AS brand, CAST(p_retailprice AS VARCHAR) AS unit_price,
    '2024-05-01' AS _loaded_at, 'b1' AS _batch_id, true AS from_file
FROM part""",
)
def read_json_records_query(spark: SparkSession, d: str) -> DataFrame:
    """JSON arrays of a hundred products a file, read with their lineage."""
    root, fields = _folder(spark, "json"), ["product_id", "product_name", "brand", "unit_price"]
    parts = table(spark, d, "part").select(
        F.floor(F.col("p_partkey") / 100).alias("file"),
        F.struct(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").cast("string").alias("unit_price"),
        ).alias("record"),
    )
    _documents(parts.groupBy("file").agg(F.to_json(F.collect_list("record"), {"pretty": "true"}).alias("value")).select("value"), root)
    read = read_json_records(spark, root, batch_id="b1", loaded_at="2024-05-01", schema=text_schema(fields))
    return read.select(*fields, "_loaded_at", "_batch_id", F.col("_source_file").startswith("part-").alias("from_file"))


@query(
    "read_rates_files",
    """
WITH r AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, max(user_id) AS rate FROM events GROUP BY ALL)
SELECT event_type AS currency_code, CAST(rate AS DOUBLE) + 0.25::DOUBLE AS rate,
    CASE WHEN right(day, 1) = '5' THEN 'BRL' ELSE 'USD' END AS base_currency, day AS fetched_at, 'b2' AS _batch_id
FROM r""",
)
def read_rates_files(spark: SparkSession, d: str) -> DataFrame:
    """Rate documents of both shapes, one file a day."""
    root = _folder(spark, "rates")
    rates = (
        table(spark, d, "events")
        .groupBy(F.col("ts").cast("date").cast("string").alias("day"), "event_type")
        .agg((F.max("user_id").cast("double") + 0.25).alias("rate"))
        .groupBy("day")
        .agg(F.map_from_entries(F.collect_list(F.struct("event_type", "rate"))).alias("rates"))  # a handful of types
    )
    first = F.to_json(F.struct(F.lit("USD").alias("base"), F.col("day").alias("fetched_at"), "rates"))
    second = F.to_json(F.struct(F.lit("BRL").alias("base_code"), F.col("day").alias("time_last_update_utc"), "rates"))
    _documents(rates.select(F.when(F.col("day").endswith("5"), second).otherwise(first).alias("value")), root)
    return read_exchange_rates(spark, f"{root}/part-*", batch_id="b2").drop("_loaded_at", "_source_file")


@query(
    "layer_files",
    with_sql("raw_sellers")
    + """
SELECT seller_id, lower(seller_city) AS seller_city, left(repeat(seller_city, 20), 80) AS preview, _batch_id FROM raw_sellers
WHERE CAST(seller_id AS BIGINT) <= 3""",
)
def layer_files(spark: SparkSession, d: str) -> DataFrame:
    """A bronze view, a refreshed table, a JSON export read back and a preview of it."""
    root, raw = _folder(spark, "files"), entity(spark, d, "raw_sellers")
    sinks.append_bronze(raw, f"{root}/raw_sellers")
    view = sinks.bronze_views(spark, root, ["sellers"])["sellers"]
    cleaned = view.select("seller_id", F.lower("seller_city").alias("seller_city"), F.repeat("seller_city", 20).alias("preview"), "_batch_id")
    stale = cleaned.withColumn("seller_city", F.lit("stale"))
    sinks.write_tables({"sellers": stale}, f"{root}/silver")
    silver = sinks.write_tables({"sellers": cleaned}, f"{root}/silver")["sellers"]
    sinks.write_json(silver, f"{root}/json")
    back = spark.read.schema(silver.schema).json(f"{root}/json")
    return Q.preview(back.where(F.col("seller_id").cast("bigint") <= 3), back.columns, text="preview", n=10)


_CELLS = [f"coalesce({c}, '')" for c in ENTITIES["payments"].columns]
_QUOTED = [f"'\"' || replace({c}, '\"', '\"\"') || '\"'" for c in _CELLS]
#: A line with a cell too many, one that is cut off, and good ones.
_LINE = f"""CASE WHEN CAST(order_id AS BIGINT) % 50 = 0 THEN {" || ',' || ".join([*_QUOTED, "'surplus'"])}
    WHEN CAST(order_id AS BIGINT) % 50 = 1 THEN {" || ',' || ".join(_QUOTED[:3])}
    ELSE {" || ',' || ".join(_QUOTED)} END"""


@query(
    "stream_quarantine",
    with_sql("raw_payments")
    + f"""
, lines AS (SELECT *, {_LINE} AS line, CAST(order_id AS BIGINT) % 50 < 2 AS refused FROM raw_payments)
SELECT CASE WHEN refused THEN '' ELSE order_id END AS order_id, CASE WHEN refused THEN '' ELSE payment_sequential END AS payment_sequential,
    CASE WHEN refused THEN '' ELSE coalesce(payment_value, '') END AS payment_value,
    CASE WHEN refused THEN 'cells do not match the header' ELSE '' END AS reason, CASE WHEN refused THEN line ELSE '' END AS text
FROM lines""",
)
def stream_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Files with malformed lines among good ones, then files with their columns in another order."""
    root, columns = _folder(spark, "quarantine"), list(ENTITIES["payments"].columns)
    raw = entity(spark, d, "raw_payments").withColumns({"line": F.expr(_LINE), "odd": F.expr("CAST(order_id AS BIGINT) % 100 < 50")})
    # One column that is named like the header and holds whole lines.
    whole = {"header": "true", "sep": "\u0001", "quote": "", "escapeQuotes": "false"}
    raw.where("odd").select(F.col("line").alias(",".join(columns))).write.options(**whole).csv(f"{root}/src")
    bad = F.expr("CAST(order_id AS BIGINT) % 50 < 2")
    raw.where(~F.col("odd") & bad).select(F.col("line").alias(",".join(columns))).write.mode("append").options(**whole).csv(f"{root}/src")
    turned = raw.where(~F.col("odd") & ~bad).select(*columns[::-1], F.lit("new").alias("note"))
    run = lambda: ingest_stream(spark, "payments", f"{root}/src", f"{root}/bronze", f"{root}/state").awaitTermination()
    run()
    sinks.write_csv(turned, f"{root}/src", mode="append")
    run()
    empty = F.lit("")
    good = sinks.read_bronze(spark, f"{root}/bronze").select("order_id", "payment_sequential", "payment_value", empty.alias("reason"), empty.alias("text"))
    refused = sinks.read_bronze(spark, quarantine(f"{root}/bronze"))
    return good.unionByName(refused.select(*[empty.alias(c) for c in good.columns[:3]], "reason", "text"))


@query(
    "upsert_redelivery",
    with_sql("raw_order_items")
    + """
, second AS (SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
    CASE WHEN CAST(order_id AS BIGINT) % 7 = 0 THEN '1.25' ELSE price END AS price, freight_value,
    '2024-03-01T00:00:00+00:00' AS _loaded_at, 'again.csv' AS _source_file, 'third' AS _batch_id
    FROM raw_order_items WHERE CAST(order_id AS BIGINT) % 5 <> 0)
, deliveries AS (SELECT * FROM raw_order_items UNION ALL SELECT * FROM second)
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value, _batch_id FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY _loaded_at DESC NULLS LAST, _batch_id DESC NULLS LAST,
        product_id NULLS LAST, seller_id NULLS LAST, shipping_limit_date NULLS LAST, price NULLS LAST, freight_value NULLS LAST,
        _source_file NULLS LAST) AS rn FROM deliveries)
WHERE rn = 1""",
)
def upsert_redelivery(spark: SparkSession, d: str) -> DataFrame:
    """Deliver items, deliver most of them again with new prices, and once more: every key has its latest row once."""
    items = entity(spark, d, "raw_order_items")
    kept = KeyedTable(_folder(spark, "keyed"), ("order_id", "order_item_id"), buckets=8)
    again = items.where(F.expr("CAST(order_id AS BIGINT) % 5 <> 0")).withColumns(
        {
            "price": F.expr("CASE WHEN CAST(order_id AS BIGINT) % 7 = 0 THEN '1.25' ELSE price END"),
            "_loaded_at": F.lit("2024-03-01T00:00:00+00:00"),
            "_source_file": F.lit("again.csv"),
            "_batch_id": F.lit("third"),
        }
    )
    for delivery in (items, again, items, again):
        upsert(kept, delivery)
    return read_keyed(spark, kept).drop("_loaded_at", "_source_file")


@query(
    "stream_score",
    """
SELECT value - 60 AS delivery_delay_days, CAST(user_id AS BIGINT) AS review_comment_length, event_type = 'view' AS has_comment,
    CAST(event_id % 5 AS BIGINT) AS payment_type_encoded, value < 60 AS satisfied,
    CASE WHEN value < 60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS probability
FROM events""",
)
def stream_score(spark: SparkSession, d: str) -> DataFrame:
    """Score requests that arrive as JSON lines; the audit rows."""
    root = _folder(spark, "requests")
    table(spark, d, "events").select(
        F.col("props").alias("review_comment_message"),
        (F.col("value") - 60).alias("delivery_delay_days"),
        F.col("user_id").cast("int").alias("review_comment_length"),
        (F.col("event_type") == "view").alias("has_comment"),
        (F.col("event_id") % 5).cast("int").alias("payment_type_encoded"),
    ).write.json(f"{root}/src")
    rule = SQLTransformer(
        statement="SELECT *, CASE WHEN delivery_delay_days < 0 THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__"
    )
    score_stream(
        spark, rule, f"{root}/src", f"{root}/out", f"{root}/state", cfg=TrainConfig(use_text=False)
    ).awaitTermination()
    return plain(sinks.read_bronze(spark, f"{root}/out/audit").drop("_batch_id", "at"))
