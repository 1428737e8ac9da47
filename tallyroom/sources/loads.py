"""Load raw files into bronze tables."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import astuple, dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tallyroom.sources.durable import small_frame, together
from tallyroom.sources.readers import new_batch_id, read_entity, utc_now
from tallyroom.sources.registry import ENTITIES
from tallyroom.sources.sinks import append_bronze

REPORT_SCHEMA = (
    "name string, table_name string, success boolean, n_rows bigint, elapsed_s double, error string"
)


@dataclass
class LoadResult:
    name: str
    table: str
    success: bool = False
    rows: int = 0
    elapsed_s: float = 0.0
    error: str = ""


@dataclass(frozen=True)
class LakePaths:
    data_root: str  # holds csv/, json/ and api/
    bronze_root: str


def load_entity(spark: SparkSession, name: str, paths: LakePaths, batch_id: str | None = None) -> None:
    """Append one entity's files to its raw table."""
    df = read_entity(
        spark, name, paths.data_root, batch_id=batch_id or new_batch_id(), loaded_at=utc_now()
    )
    append_bronze(df, f"{paths.bronze_root.rstrip('/')}/{ENTITIES[name].table}")


def load_products(spark: SparkSession, paths: LakePaths, batch_id: str | None = None) -> None:
    """Products arrive as CSV and as JSON; both share a batch."""
    batch_id = batch_id or new_batch_id()
    load_entity(spark, "products", paths, batch_id)
    load_entity(spark, "products_json", paths, batch_id)


def load_all(
    spark: SparkSession,
    paths: LakePaths,
    *,
    names: Sequence[str] = tuple(ENTITIES),
    dry_run: bool = False,
) -> DataFrame:
    """Load every entity under one batch id and report on each.

    Tables are loaded side by side, entities of one table in their order. A
    failing entity is reported and the others still load. ``n_rows`` is the
    size of the whole raw table afterwards. A dry run loads and reports nothing.
    """
    batch_id = new_batch_id()
    results = [LoadResult(name, ENTITIES[name].table) for name in (() if dry_run else names)]

    def load(result: LoadResult) -> None:
        started = time.perf_counter()
        try:
            load_entity(spark, result.name, paths, batch_id)
            result.success = True
        except Exception as failure:  # reported, so that the other entities still load
            result.error = str(failure)
        result.elapsed_s = round(time.perf_counter() - started, 2)
        if result.success:
            try:
                table = f"{paths.bronze_root.rstrip('/')}/{result.table}"
                result.rows = spark.read.parquet(table).count()  # from the file footers
            except Exception:  # the load itself went through
                result.rows = -1

    def load_table(table: str) -> None:
        for result in results:
            if result.table == table:
                load(result)

    together(*[partial(load_table, table) for table in dict.fromkeys(r.table for r in results)])
    return small_frame(spark, [astuple(r) for r in results], REPORT_SCHEMA)
