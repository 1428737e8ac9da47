"""Small helpers on frames that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows up to which a narrow key table (some ten bytes a row) is broadcast.
BROADCAST_ROWS = 500_000

#: Characters that part words, as a Java and DuckDB character class.
WORD = r"[^\x20\x09-\x0D]+"


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df``, a narrow written table, if its counted rows allow; else leave the join to Spark."""
    return F.broadcast(df) if df.count() <= rows else df


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``."""
    return F.crc32(key.cast("string")) % n
