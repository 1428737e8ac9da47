"""Build a layer, check it, and only then let readers see it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyroom.operators.quality import Check, checked_writes, enforce
from tallyroom.sources.events import append_events, newest, read_events
from tallyroom.sources.readers import utc_now


def _at(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def build_layer(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    checks: Sequence[Check],
    root: str,
    parents: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Write the tables as a new generation of the layer, enforce the checks, publish it.

    Rows are counted and single-row checks are taken while the tables are
    written. A failed check raises :class:`QualityError`; the generation before
    stays the current one. ``parents`` are tables of other layers that checks
    refer to.
    """
    generation = uuid.uuid4().hex

    def write(name: str, df: DataFrame) -> DataFrame:
        path = _at(root, generation, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    written, report = checked_writes(tables, checks, write, parents or {})
    enforce(report)
    at = utc_now()
    append_events(spark, _at(root, "events"), [(name, None, "generation", generation, at, None, None) for name in tables])
    return written


def current_layer(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the newest published generation of each; empty before the first."""
    rows = newest(read_events(spark, _at(root, "events")), "generation").collect()  # one row per table
    return {r.model: spark.read.parquet(_at(root, r.value, r.model)) for r in sorted(rows, key=lambda r: r.model)}
