"""Ranks over a whole table without gathering it in one partition.

The rows are range-partitioned and sorted; ``monotonically_increasing_id``
then holds the partition number in its upper bits and the position inside
the partition in its lower 33 bits. The frame is written out, because range
bounds come from a sample and must not be drawn again. A global rank is the
position plus the sizes of the partitions before it. Only those sizes (one
row per partition and group) reach the driver.

Every order ends in a key that makes it total, so a value shared by very
many rows still spreads over several partitions. Where only a few ranks are
wanted (ntile), nothing is sorted: see :mod:`tallyroom.operators.selection`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.operators.selection import extents, nth_of_ties, order_key, spots
from tallyroom.sources.durable import durable, small_frame

_POSITION_BITS = 33  # fixed by monotonically_increasing_id
_AT = "_at"


def _run() -> Column:
    """Number of the partition a row was sorted in."""
    return F.shiftright(F.col(_AT), _POSITION_BITS)


def _index() -> Column:
    """Position inside that partition, from 0."""
    return F.col(_AT).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def sorted_runs(df: DataFrame, order: Sequence[Column | str], label: str) -> DataFrame:
    """The rows range-partitioned and sorted, written with their place."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return durable(ranged.withColumn(_AT, F.monotonically_increasing_id()), label)


def _offsets(runs: DataFrame) -> tuple[list[tuple[int, int]], int]:
    """Rows before each partition, and rows in all; one entry per partition."""
    sizes = runs.groupBy(_run().alias("run")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = 0, []
    for run, n in sorted((r.run, r.n) for r in sizes):
        offsets.append((run, before))
        before += n
    return offsets, before


def with_rank(runs: DataFrame, out: str, offsets: list[tuple[int, int]] | None = None) -> DataFrame:
    """Sorted runs with the global 1-based rank instead of the place."""
    offsets = _offsets(runs)[0] if offsets is None else offsets
    shift = small_frame(runs.sparkSession, offsets, "_run bigint, _before bigint")
    return (
        runs.withColumn("_run", _run())
        .join(F.broadcast(shift), "_run")  # one row per partition
        .withColumn(out, F.col("_before") + _index() + 1)
        .drop("_run", "_before", _AT)
    )


def global_row_number(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Add the 1-based rank of each row in ``order`` as a BIGINT."""
    return with_rank(sorted_runs(df, order, "row-number"), out)


def global_dense_rank(
    df: DataFrame, value: str, out: str, *, descending: bool = False
) -> DataFrame:
    """Add the dense rank of ``value``; NULL shares the rank after the last.

    Only the distinct values are ranked; they are joined back by value. Rows
    without a value skip that join, so they cannot pile up on one task.
    ``df`` is read twice: pass a table or a written frame.
    """
    distinct = df.where(F.col(value).isNotNull()).select(value).distinct()
    order = F.col(value).desc() if descending else F.col(value).asc()
    runs = sorted_runs(distinct, [order], "dense-rank")
    offsets, values = _offsets(runs)
    ranked, after_last = with_rank(runs, out, offsets), values + 1
    present = df.where(F.col(value).isNotNull()).join(ranked, value)
    absent = df.where(F.col(value).isNull()).withColumn(out, F.lit(after_last).cast("bigint"))
    return present.select(*df.columns, out).unionByName(absent)


@dataclass(frozen=True)
class Axis:
    """A column to cut into equal buckets; NaN ranks after all numbers and NULL last.

    Whole numbers, dates, timestamps and decimals keep all their digits.
    """

    column: str
    descending: bool = False

    def place(self, kind: T.DataType) -> Column:
        """A number in the order of the axis; NULL for NaN and NULL."""
        key = order_key(F.col(self.column), kind)
        if not self.descending:
            return key
        # Complement, as the smallest BIGINT has no opposite.
        return F.lit(0.0) - key if _is_double(kind) else F.bitwise_not(key)

    def rest(self, kind: T.DataType) -> Column:
        """0 for a number, 1 for NaN, 2 for NULL; a descending axis begins with NaN."""
        nan = F.isnan(F.col(self.column).cast("double")) if _is_double(kind) else F.lit(False)
        return F.when(F.col(self.column).isNull(), 2).when(nan, -1 if self.descending else 1).otherwise(0)


def _is_double(kind: T.DataType) -> bool:
    exact = isinstance(kind, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType))
    return not (exact or isinstance(kind, T.DecimalType) and kind.precision <= 18)


def _bucket_ends(n: int, k: int) -> list[int]:
    """Last rank of the buckets 1..k-1 of an n-row ntile(k)."""
    size, extra = divmod(n, k)
    ends = [b * size + min(b, extra) for b in range(1, k)]
    return [e for e in ends if 0 < e < n]


def global_ntile(df: DataFrame, k: int, axes: dict[str, Axis], key: str) -> DataFrame:
    """Add ``ntile(k)`` over the whole table for several axes at once.

    The value at the end of each bucket is selected by counting, k-1 per axis;
    where a bucket ends between rows of one value, the ``key`` of its last row
    is selected in the same way among those rows alone. Every row is then
    compared with the ends: nothing is sorted, shuffled, written or joined
    back. ``key`` is unique and breaks ties. ``df`` is read several times:
    pass a table or a written frame.
    """
    if not axes:
        return df
    kinds = {name: df.schema[axis.column].dataType for name, axis in axes.items()}
    place = {name: axis.place(kinds[name]) for name, axis in axes.items()}
    rest = {name: axis.rest(kinds[name]) for name, axis in axes.items()}
    sizes = [F.count(F.when(r == v, 1)).alias(f"{i}:{v}") for i, r in enumerate(rest.values()) for v in (-1, 1, 2)]
    known, row = extents(df, place, dict.fromkeys(axes, [b / k for b in range(1, k)]), *sizes, F.count(F.lit(1)).alias("rows"))
    last = [e - 1 for e in _bucket_ends(row.rows, k)]
    first = {name: row[f"{i}:-1"] for i, name in enumerate(axes)}  # rows before the numbers
    at = spots(df, place, known, {name: [r - first[name] for r in last] for name in axes})

    # Where each bucket ends: in the numbers (0) or in the rest, the numbers after it, and the rows of its last value.
    ends: dict[tuple[str, int], tuple[int, Column, Column]] = {}
    inside: dict[tuple, tuple[Column, list[int], int]] = {}  # (axis, rows below): a value in which buckets end
    places: dict[tuple[str, int], tuple] = {}
    for i, name in enumerate(axes):
        groups = [(-1, 0), (1, first[name] + known[name].n), (2, first[name] + known[name].n + row[f"{i}:1"])]
        for r in last:
            # A place is NULL for all that is no number, and so is a comparison with it.
            if spot := at[name].get(r - first[name]):
                value, same = 0, place[name] == F.lit(spot.key)
                below, rows = first[name] + spot.below, spot.equal
                after = place[name] > F.lit(spot.key)
            else:
                value, below = next((v, b) for v, b in groups if b <= r < b + row[f"{i}:{v}"])
                same, rows = rest[name] == value, row[f"{i}:{value}"]
                after = F.lit(False)
            ends[name, r] = (value, after, same)
            if r + 1 < below + rows:
                inside.setdefault((name, below), (same, [], rows))[1].append(r - below)
                places[name, r] = ((name, below), r - below)
    kind = df.schema[key].dataType
    nth = nth_of_ties(df, inside, key)
    bounds = {end: nth[at] for end, at in places.items()}

    def bucket_of(name: str, ranks: list[int], number: int) -> Column:
        """Bucket of a row, halving the ends that are left: few comparisons for each row."""
        if not ranks:
            return F.lit(number)
        half = len(ranks) // 2
        r = ranks[half]
        value, after, same = ends[name, r]
        if (name, r) in bounds:
            after = after | (same & (F.col(key) > F.lit(bounds[name, r]).cast(kind)))
        return F.when((rest[name] > value) | after, bucket_of(name, ranks[half + 1 :], number + half + 1)).otherwise(
            bucket_of(name, ranks[:half], number)
        )

    return df.withColumns({name: bucket_of(name, last, 1).cast("bigint") for name in axes})
