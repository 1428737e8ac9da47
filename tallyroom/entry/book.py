"""Register a query together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query; ``sql`` is left out where SQL cannot express it."""

    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return add


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT and timestamps as text, for the comparison."""
    columns = []
    for name, kind in df.dtypes:
        if kind in ("int", "smallint", "tinyint"):
            columns.append(F.col(name).cast("bigint").alias(name))
        elif kind.startswith("timestamp"):
            columns.append(F.col(name).cast("string").alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*columns)
