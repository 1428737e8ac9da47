"""Declarative checks over a set of tables.

A check finds failing rows; none means it passed. NULL fails only
``not_null``. Checks that look at single rows of one table share one scan,
and checks on the values of one key column share one aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyroom.operators.dedup import key_set
from tallyroom.sources.durable import small_frame, together

LINEAGE = ("_loaded_at", "_source_file", "_batch_id")
REPORT = "check_name string, table_name string, column_name string, failing_rows bigint, passed boolean"


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""
    low: float | None = None
    high: float | None = None
    strict: bool = False
    failing: Callable[[dict[str, DataFrame]], DataFrame] | None = field(default=None, compare=False)

    def row_failure(self) -> Column | None:
        """Condition a single row fails on, for the kinds that have one."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            return ~c.isin(*self.values)
        if self.kind == "between":
            bad = F.lit(False)
            if self.low is not None:
                bad = bad | ((c <= self.low) if self.strict else (c < self.low))
            if self.high is not None:
                bad = bad | ((c >= self.high) if self.strict else (c > self.high))
            return bad
        return None


def not_null(table: str, column: str) -> Check:
    return Check("not_null", table, column)


def unique(table: str, column: str) -> Check:
    return Check("unique", table, column)


def accepted_values(table: str, column: str, values: Sequence) -> Check:
    return Check("accepted_values", table, column, values=tuple(values))


def relationships(table: str, column: str, parent: str, parent_column: str) -> Check:
    return Check("relationships", table, column, parent=parent, parent_column=parent_column)


def between(
    table: str, column: str, low: float | None = None, high: float | None = None, strict: bool = False
) -> Check:
    return Check("between", table, column, low=low, high=high, strict=strict)


def custom(
    name: str,
    table: str,
    column: str,
    failing: Callable[[dict[str, DataFrame]], DataFrame],
    parent: str = "",
    parent_column: str = "",
) -> Check:
    """A check with its own rows. With a parent, these are the values that
    ``relationships`` lists and NULL: a report then counts both together."""
    return Check(name, table, column, parent=parent, parent_column=parent_column, failing=failing)


def failing_rows(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows that break one check.

    ``unique`` lists each repeated value with its number of rows;
    ``relationships`` lists each missing value with its number of rows, in a
    column ``n_rows``, and a custom check may do the same.
    """
    df = tables[check.table]
    if check.failing is not None:
        return check.failing(tables)
    condition = check.row_failure()
    if condition is not None:
        return df.where(condition)
    counted = (
        df.where(F.col(check.column).isNotNull())
        .groupBy(check.column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    if check.kind == "unique":
        return counted.where(F.col("n_rows") > 1)
    parents = key_set(tables[check.parent], check.parent_column, check.column)
    return counted.join(parents, check.column, "left_anti")


def _report_row(check: Check, failing: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.coalesce(failing, F.lit(0)).cast("bigint").alias("failing_rows"),
    )


def _key_of(check: Check, tables: dict[str, DataFrame]) -> tuple[str, str] | None:
    """The key column whose values decide a check, where they are of the child's type."""
    if check.kind == "unique":
        return check.table, check.column
    if not check.parent:
        return None
    kinds = [
        tables[t].select(c).schema[0].dataType
        for t, c in ((check.table, check.column), (check.parent, check.parent_column))
    ]
    return (check.parent, check.parent_column) if kinds[0] == kinds[1] else None


def _key_report(key: tuple[str, str], checks: Sequence[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """Report rows of all checks on one key column: its values and those of the
    columns that refer to it are counted side by side, in one aggregation."""
    children = list(dict.fromkeys((c.table, c.column) for c in checks if c.kind != "unique"))
    value = F.col("value")
    rows = []
    for at, (table, column) in enumerate([key, *children]):
        one = [F.lit(int(i == at)).cast("bigint").alias(f"n{i}") for i in range(len(children) + 1)]
        side = tables[table].select(F.col(column).alias("value"), *one)
        # NULL is no parent; among children only checks that count NULL need it
        null_counts = at > 0 and any(c.failing is not None and (c.table, c.column) == (table, column) for c in checks)
        rows.append(side if null_counts else side.where(value.isNotNull()))
    names = [f"n{i}" for i in range(len(children) + 1)]
    counted = reduce(DataFrame.unionAll, rows).groupBy("value").agg(*[F.sum(n).alias(n) for n in names])
    failing = []
    for c in checks:
        if c.kind == "unique":
            failing.append(F.count(F.when(F.col("n0") > 1, 1)))
            continue
        missing = F.col("n0") == 0
        if c.failing is None:
            missing = missing & value.isNotNull()
        failing.append(F.sum(F.when(missing, F.col(f"n{1 + children.index((c.table, c.column))}"))))
    totals = counted.agg(*[x.alias(f"f{i}") for i, x in enumerate(failing)])
    return totals.select(F.inline(F.array(*[_report_row(c, F.col(f"f{i}")) for i, c in enumerate(checks)])))


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One report row per check: check_name, table_name, column_name, failing_rows, passed.

    For ``unique`` the count is the number of repeated values, for
    ``relationships`` the number of child rows without a parent. Both are
    counted once per key column (:func:`_key_report`).
    """
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        simple = [c for c in checks if c.table == table and c.row_failure() is not None]
        if simple:
            counts = tables[table].agg(
                *[F.sum(F.when(c.row_failure(), 1)).alias(f"f{i}") for i, c in enumerate(simple)]
            )
            rows = F.array(*[_report_row(c, F.col(f"f{i}")) for i, c in enumerate(simple)])
            parts.append(counts.select(F.inline(rows)))
    by_key: dict[tuple[str, str], list[Check]] = {}
    for check in checks:
        if check.row_failure() is not None:
            continue
        key = _key_of(check, tables)
        if key is not None:
            by_key.setdefault(key, []).append(check)
            continue
        found = failing_rows(check, tables)
        counted = "n_rows" in found.columns and check.kind != "unique"
        total = F.sum("n_rows") if counted else F.count(F.lit(1))
        parts.append(
            found.agg(total.alias("n")).select(F.inline(F.array(_report_row(check, F.col("n")))))
        )
    parts += [_key_report(key, group, tables) for key, group in by_key.items()]
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failing_rows") == 0)


def checked_writes(
    tables: dict[str, DataFrame],
    checks: Sequence[Check],
    write: Callable[[str, DataFrame], DataFrame],
    parents: dict[str, DataFrame] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write tables and check them: ``(written tables, report)``.

    Checks that look at single rows are counted by the write itself
    (``Observation``), so they need no second scan; only repeated keys, missing
    parents and custom checks read the written tables. The counts sit on top
    of the plan, in the task that writes, where a task that runs again counts
    once. ``write(name, frame)`` returns the written table; the tables are
    written side by side, so it is called from several threads.
    """

    def one(name: str, df: DataFrame) -> tuple[DataFrame, list[tuple]]:
        simple = [c for c in checks if c.table == name and c.row_failure() is not None]
        seen = Observation()
        counts = [F.count(F.when(c.row_failure(), 1)).alias(f"f{i}") for i, c in enumerate(simple)]
        table = write(name, df.observe(seen, F.count(F.lit(1)).alias("n"), *counts))
        found = seen.get
        return table, [(c.kind, c.table, c.column, found[f"f{i}"], found[f"f{i}"] == 0) for i, c in enumerate(simple)]

    done = together(*[partial(one, name, df) for name, df in tables.items()])
    written = {name: table for name, (table, _) in zip(tables, done)}
    lines = [line for _, found in done for line in found]
    others = [c for c in checks if c.table in tables and c.row_failure() is None]
    spark = next(iter(tables.values())).sparkSession
    report = small_frame(spark, lines, REPORT)
    if others:
        report = report.unionByName(run_checks({**(parents or {}), **written}, others))
    return written, report


class QualityError(RuntimeError):
    """At least one check found failing rows."""


def enforce(report: DataFrame) -> None:
    """Raise when a check failed; the report has one row per check."""
    failed = report.where(~F.col("passed")).orderBy("table_name", "column_name").collect()
    if failed:
        lines = [f"{r.check_name}({r.table_name}.{r.column_name}): {r.failing_rows}" for r in failed]
        raise QualityError("; ".join(lines))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows`` for every table, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def verify_layer(tables: dict[str, DataFrame], required: Sequence[str] = LINEAGE) -> DataFrame:
    """Columns, rows and missing lineage columns of every raw table."""
    shape = None
    for name, df in tables.items():
        missing = sorted(set(required) - set(df.columns))
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
            "n_rows",
            F.lit(", ".join(missing)).alias("missing_columns"),
        )
        shape = row if shape is None else shape.unionByName(row)
    return shape.withColumn("ok", (F.col("n_rows") > 0) & (F.col("missing_columns") == ""))


def preview(df: DataFrame, columns: Sequence[str], text: str | None = None, n: int = 3) -> DataFrame:
    """A few sample rows; ``text`` must not be empty and is shown shortened."""
    if text is not None:
        df = df.where(F.col(text) != "").withColumn(text, F.left(text, F.lit(80)))
    return df.select(*columns).limit(n)


def rates_by_file(rates: DataFrame) -> DataFrame:
    """How many currencies each rates file and base currency brought."""
    return (
        rates.groupBy("_source_file", "base_currency")
        .agg(F.count(F.lit(1)).alias("n_currencies"))
        .orderBy("_source_file")
    )
