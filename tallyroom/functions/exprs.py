"""Column expressions shared by the models.

Everything here is built from Spark's own functions, so it stays inside
generated code. A value that cannot be read becomes NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number or as a date in a raw text cell.
NUMBER_TEXT = r"(?i)^\s*[-+]?([0-9.]+(e[-+]?[0-9]+)?|inf.*|nan)\s*$"
DATE_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}"
# Fixed value: the space characters (Unicode class Zs).
SPACES = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"

# Fixed value: stands for NULL inside a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: Column | str) -> Column:
    """Text to DOUBLE; Java-only spellings such as ``1.5d`` are refused."""
    c = _col(c)
    return F.when(c.rlike(NUMBER_TEXT), c.try_cast("double"))


def safe_int(c: Column | str) -> Column:
    """Text to INTEGER, rounding fractions half away from zero."""
    return F.round(safe_double(c)).try_cast("int")


def safe_timestamp(c: Column | str) -> Column:
    """Text to TIMESTAMP without zone; an offset is dropped, the wall clock kept."""
    c = _col(c)
    return F.when(c.rlike(DATE_TEXT), c.try_cast("timestamp_ntz"))


def safe_date(c: Column | str, fmt: str | None = None) -> Column:
    """Text to DATE. ``fmt`` is accepted and has no effect."""
    c = _col(c)
    return F.when(c.rlike(DATE_TEXT), c.try_cast("date"))


def trimmed(c: Column | str) -> Column:
    """Strip outer space characters, the no-break space included."""
    return F.btrim(_col(c), F.lit(SPACES))


def clean_lower(c: Column | str) -> Column:
    return F.lower(trimmed(c))


def clean_upper(c: Column | str) -> Column:
    return F.upper(trimmed(c))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def round_half_away(c: Column | str, digits: int = 0) -> Column:
    """Round a DOUBLE on its binary value, halves away from zero."""
    c = _col(c).cast("double")
    unit = float(10**digits)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(unit) + F.lit(0.5)) / F.lit(unit)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from ``start`` to ``end``; NULL when either is missing."""
    return F.datediff(_col(end).cast("date"), _col(start).cast("date"))


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "month")


def surrogate_key(*cols: Column | str, null_marker: str = SURROGATE_NULL) -> Column:
    """MD5 over the dash-joined text of the columns."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(null_marker)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def exact_sum(c: Column | str) -> Column:
    """Sum of a DOUBLE amount that does not depend on the order of the rows.

    Amounts are added as whole ten-thousandths in a BIGINT. A group holding a
    value that is not such a multiple (NaN, infinity, more decimals) or whose
    total does not fit falls back to the floating-point sum.
    """
    c = _col(c).cast("double")
    units = F.rint(c * F.lit(10000.0)).try_cast("bigint")
    off_grid = F.coalesce(
        F.abs(units / F.lit(10000.0) - c) > F.abs(c) * F.lit(1e-14), units.isNull()
    )
    total = F.try_sum(units)
    only_on_grid = F.count(F.when(c.isNotNull() & off_grid, F.lit(1))) == 0
    return F.when(
        only_on_grid & (total.isNotNull() | (F.count(c) == 0)), total / F.lit(10000.0)
    ).otherwise(F.sum(c))


def exact_avg(c: Column | str) -> Column:
    """Mean of an amount: :func:`exact_sum` over the number of values."""
    return exact_sum(c) / F.nullif(F.count(_col(c)), F.lit(0))


def hash_part(row_hash: Column, part: int) -> Column:
    """The ``part``-th 48-bit slice of an MD5 text, as a BIGINT."""
    return F.conv(F.substring(row_hash, 1 + 12 * part, 12), 16, 10).cast("bigint")


def row_md5(*cols: Column | str) -> Column:
    """MD5 of a row; NULL and empty text hash differently."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("\u001e")) for c in cols]
    return F.md5(F.concat_ws("\u001f", *parts))
