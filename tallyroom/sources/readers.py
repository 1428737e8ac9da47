"""Raw files to bronze frames.

Every cell is text, a blank cell stays ``''``, and each row carries the
instant of the load, the name of its file and the id of its batch.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.sources.registry import ENTITIES

CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",  # check each file's header instead of trusting positions
    "multiLine": "true",
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "FAILFAST",  # a row with more or fewer cells than the header fails the load
}
LINEAGE = ("_loaded_at", "_source_file", "_batch_id")

# The two known shapes of a rates document, as one schema.
RATES_SCHEMA = T.StructType(
    [
        T.StructField("base", T.StringType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("base_code", T.StringType()),
        T.StructField("time_last_update_utc", T.StringType()),
        T.StructField("rates", T.MapType(T.StringType(), T.StringType())),
    ]
)


def utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def new_batch_id() -> str:
    return str(uuid.uuid4())


def text_schema(columns: list[str] | tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def blank_cells_kept(columns: list[str] | tuple[str, ...]) -> list[Column]:
    """The reader turns an empty cell into NULL; put the empty text back."""
    return [F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns]


def stamped(df: DataFrame, columns: list[Column], batch_id: str, loaded_at: str) -> DataFrame:
    """Add the lineage columns. The instant is a literal: one per load."""
    return df.select(
        *columns,
        F.lit(loaded_at).alias("_loaded_at"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
    )


def read_csv_entity(
    spark: SparkSession,
    name: str,
    path: str,
    *,
    batch_id: str | None = None,
    loaded_at: str | None = None,
) -> DataFrame:
    """Read a CSV entity as text. Columns are matched by header; columns the
    registry does not know are kept. Quoted cells may span lines, so one file
    is one task: split large deliveries into several files."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns  # header only, no inference
    raw = spark.read.options(**CSV_OPTIONS).schema(text_schema(header)).csv(path)
    missing = set(ENTITIES[name].columns) - set(header) if name in ENTITIES else set()
    if missing:
        raise ValueError(f"{name}: file lacks {sorted(missing)}")
    columns = [c for c in header if c not in LINEAGE]  # re-read exports get a new stamp
    return stamped(raw, blank_cells_kept(columns), batch_id or new_batch_id(), loaded_at or utc_now())


def read_json_records(
    spark: SparkSession,
    path: str,
    *,
    batch_id: str | None = None,
    loaded_at: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read a JSON array of records, or one record. A malformed file fails the read."""
    reader = spark.read.option("multiLine", "true").option("mode", "FAILFAST")
    raw = reader.schema(schema).json(path) if schema is not None else reader.json(path)
    columns = [F.col(c) for c in raw.columns if c not in LINEAGE]
    return stamped(raw, columns, batch_id or new_batch_id(), loaded_at or utc_now())


def rates_columns() -> list[Column]:
    """Base currency and snapshot time for either document shape."""
    first = F.col("base").isNotNull() & F.col("fetched_at").isNotNull()
    second = F.col("base_code").isNotNull()
    base = (
        F.when(first, F.col("base"))
        .when(second, F.col("base_code"))
        .otherwise(F.coalesce("base", F.lit("UNKNOWN")))
    )
    fetched = (
        F.when(first, F.col("fetched_at"))
        .when(second, F.coalesce("time_last_update_utc", F.lit("")))
        .otherwise(F.coalesce("fetched_at", "time_last_update_utc", F.lit("")))
    )
    return [base.alias("base_currency"), fetched.alias("fetched_at")]


def explode_rates(df: DataFrame) -> DataFrame:
    """One row per currency of a frame with the rates document's columns.

    A rate that is no number is an error, not a missing rate.
    """
    kept = [c for c in df.columns if c not in RATES_SCHEMA.names]
    exploded = df.select(*kept, *rates_columns(), F.explode("rates").alias("currency_code", "rate"))
    number = F.col("rate").try_cast("double")
    unreadable = F.raise_error(F.concat(F.lit("unreadable rate: "), F.col("currency_code"), F.lit(" = "), F.col("rate").cast("string")))
    exploded = exploded.withColumn("rate", F.when(F.col("rate").isNull() | number.isNotNull(), number).otherwise(unreadable.cast("double")))
    return exploded.select("currency_code", "rate", "base_currency", "fetched_at", *kept)


def read_exchange_rates(
    spark: SparkSession, glob: str, *, batch_id: str | None = None, loaded_at: str | None = None
) -> DataFrame:
    """One row per currency and rates file; no rows when no file matches."""
    batch_id, loaded_at = batch_id or new_batch_id(), loaded_at or utc_now()
    folder, _, pattern = glob.rpartition("/")
    raw = (
        spark.read.option("multiLine", "true")
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", pattern)
        .schema(RATES_SCHEMA)
        .json(folder or ".")
    )
    return explode_rates(stamped(raw, [F.col(c) for c in RATES_SCHEMA.names], batch_id, loaded_at))


def read_entity(
    spark: SparkSession,
    name: str,
    root: str,
    *,
    batch_id: str | None = None,
    loaded_at: str | None = None,
) -> DataFrame:
    """Read any registered entity from below a data root."""
    entity = ENTITIES[name]
    path = f"{root.rstrip('/')}/{entity.folder}/{entity.files}"
    stamp = {"batch_id": batch_id, "loaded_at": loaded_at}
    if entity.format == "csv":
        return read_csv_entity(spark, name, path, **stamp)
    if entity.format == "json":
        return read_json_records(spark, path, **stamp)
    return read_exchange_rates(spark, path, **stamp)
