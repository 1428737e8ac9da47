"""Small state as a list of events that only grows.

What holds now is the newest event of each kind: nothing is rewritten, and a
change counts from the moment its event is appended. What an event points to
is written before it, so a run that breaks off in between leaves the former
state readable. All events of one change are one file, hence one change.
One writer at a time is assumed; readers need no lock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "model string, version int, kind string, value string, at string, run_id string, fingerprint string"
)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not exist yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, EVENT_SCHEMA)


def append_events(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """Add the events of one change, as one file."""
    spark.createDataFrame(list(rows), EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def newest(events: DataFrame, kind: str) -> DataFrame:
    """``model, value``: the newest value of each subject for one kind of event."""
    mine = events.where(F.col("kind") == kind)
    return mine.groupBy("model").agg(F.max_by("value", F.struct("at", "value")).alias("value"))
