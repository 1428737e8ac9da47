"""A table that keeps the latest row of each key, delivery by delivery.

Rows are dealt to buckets by a hash of their key. A delivery is reduced to the
latest row of each key, the buckets it touches are read, merged and written as
a new generation, and an event names the generation that each bucket now has.
Untouched buckets are neither read nor written, so a delivery costs what it
touches, and delivering the same rows again changes nothing. However large a
bucket or a delivery is, a task holds a bounded part of its keys. Readers see the
table as of the last event; a merge that breaks off leaves it as it was.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.operators.dedup import latest_per_key
from tallyroom.sources.durable import durable, owned
from tallyroom.sources.events import append_events, newest, read_events
from tallyroom.sources.readers import utc_now

_BUCKET, _PART = "_bucket", "_part"
PART_ROWS = 1 << 18  # rows that a task should hold; a bucket of more is merged by several tasks


@dataclass(frozen=True)
class KeyedTable:
    """Where the table is, its key, and the number of buckets (fixed for its life).

    A bucket should hold some hundred megabytes: tens of thousands of buckets
    for a table of terabytes.
    """

    root: str
    keys: tuple[str, ...]
    buckets: int = 64

    @property
    def data(self) -> str:
        return f"{self.root.rstrip('/')}/data"

    @property
    def events(self) -> str:
        return f"{self.root.rstrip('/')}/events"


def _bucket(table: KeyedTable) -> Column:
    return F.pmod(F.xxhash64(*table.keys), F.lit(table.buckets)).cast("int")


def generations(spark: SparkSession, table: KeyedTable) -> dict[int, str]:
    """The generation that each bucket has now; one entry per bucket."""
    rows = newest(read_events(spark, table.events), "generation").collect()
    return {int(r.model): r.value for r in rows}


def _read(spark: SparkSession, table: KeyedTable, of: dict[int, str]) -> DataFrame | None:
    paths = [f"{table.data}/generation={g}/{_BUCKET}={b}" for b, g in sorted(of.items())]
    if not paths:
        return None
    reader = spark.read.option("basePath", table.data).option("mergeSchema", "true")
    return reader.parquet(*paths).drop("generation", _BUCKET)


def read_keyed(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """The latest row of each key; rows without any part of the key are one key."""
    found = _read(spark, table, generations(spark, table))
    if found is None:
        raise LookupError(f"nothing was delivered to {table.root}")
    return found


def upsert(table: KeyedTable, delivery: DataFrame, order: Sequence[Column] | None = None) -> list[int]:
    """Merge a delivery; returns the buckets it touched.

    Of equal keys the row loaded last stays (see ``latest_per_key``), whether
    it is in the table or in the delivery. Columns that only some deliveries
    have are NULL in the other rows.
    """
    with owned(delivery.sparkSession):
        return _upsert(table, delivery, order)


def _dealt(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """Dealt by columns, over more partitions than usual where rows are many."""
    n = math.ceil(rows / PART_ROWS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns) if n > usual else df.repartition(*columns)


def _upsert(table: KeyedTable, delivery: DataFrame, order: Sequence[Column] | None) -> list[int]:
    spark = delivery.sparkSession
    rows = delivery.count()
    if rows > PART_ROWS:  # by whole rows: a task trims a bounded part, also of a key repeated very often
        delivery = delivery.repartition(math.ceil(rows / PART_ROWS), *delivery.columns)
    # Trimmed to a row per key before anything else, so a key repeated very often is no hot bucket.
    latest = durable(latest_per_key(delivery, table.keys, order).withColumn(_BUCKET, _bucket(table)), "upsert")
    touched = sorted(r[0] for r in latest.select(_BUCKET).distinct().collect())  # at most the number of buckets
    if not touched:
        return []
    known = generations(spark, table)
    stored = _read(spark, table, {b: g for b, g in known.items() if b in set(touched)})
    rows = latest.count() + (stored.count() if stored is not None else 0)  # from the file footers
    parts = math.ceil(rows / len(touched) / PART_ROWS)
    part = F.pmod(F.xxhash64(F.lit(_PART), *table.keys), F.lit(parts)).cast("int")
    # The bucket first: rows are dealt by it once, for the merge and for the write.
    merged = latest.withColumn(_PART, part)
    if stored is not None:
        both = stored.withColumn(_BUCKET, _bucket(table)).withColumn(_PART, part).unionByName(merged, allowMissingColumns=True)
        merged = latest_per_key(_dealt(both, rows, _BUCKET, _PART), (_BUCKET, _PART, *table.keys), order)
    generation = uuid.uuid4().hex
    _dealt(merged, rows, _BUCKET, _PART).drop(_PART).write.partitionBy(_BUCKET).parquet(f"{table.data}/generation={generation}")
    at = utc_now()
    append_events(spark, table.events, [(str(b), None, "generation", generation, at, None, None) for b in touched])
    return touched
