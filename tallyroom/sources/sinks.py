"""Writes: append-only bronze, full-refresh tables, JSON and CSV exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_bronze(df: DataFrame, path: str) -> None:
    """Append a batch; rows of earlier batches stay, keys are not compared.

    One directory per batch id lets readers prune to a batch. Raw tables are
    kept for good and all text, which zstd halves.
    """
    df.write.mode("append").option("compression", "zstd").partitionBy("_batch_id").parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """All batches; columns that only some batches have are NULL in the others."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df.withColumn("_batch_id", F.col("_batch_id").cast("string"))


def bronze_views(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Register ``bronze_<name>`` views over the raw tables, without copying."""
    views = {}
    for name in names:
        views[name] = read_bronze(spark, f"{root.rstrip('/')}/raw_{name}")
        views[name].createOrReplaceTempView(f"bronze_{name}")
    return views


def overwrite(df: DataFrame, path: str) -> None:
    """Full refresh of a table. The frame must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_tables(tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Refresh a whole layer and hand back its written tables."""
    written = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        overwrite(df, path)
        written[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return written


def overwrite_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append_json(df: DataFrame, path: str) -> None:
    """Add documents to a history, one line each."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


# Doubled quotes, and white space at the ends of a cell is part of it.
CSV_EXPORT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# Higher levels save little more disk for their time.
CSV_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", *, gzip: bool = False) -> None:
    """Export with a header; every cell reads back as it was.

    Files that are read with line ends in cells are one task each anyway, so
    they lose no parallelism as ``gzip``; readers know them by their names.
    """
    df.write.mode(mode).options(**CSV_EXPORT, **(CSV_GZIP if gzip else {})).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
