"""Values at given ranks of a column, exactly, without sorting or moving its rows.

One aggregation finds, by a quantile sketch, narrow brackets of values in
which the wanted ranks should lie. The next counts the rows before, at the
ends of and inside each bracket; brackets of few rows are counted value by
value. A bracket that still holds many rows is narrowed by a sketch of its own:
each round leaves a thousandth. A bracket that misses its rank costs a round,
nothing else. Every pass is a scan of the needed columns with partial counts;
what reaches the driver is at most some ``FEW`` counts for each bracket,
whatever the number of rows. A value shared by very many rows is one count.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEW = 1 << 11  # rows whose values are counted one by one
ACCURACY = 10_000  # of the sketch: ranks are right to this part of the rows
_SLACK = 2 / ACCURACY
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def order_key(c: Column, kind: T.DataType) -> Column:
    """A BIGINT or DOUBLE in the order of the column, equal where the values are; NULL stays.

    Whole numbers, dates, timestamps and decimals of up to 18 digits are
    BIGINT and keep all digits, all others DOUBLE. NaN becomes NULL.
    """
    if isinstance(kind, _WHOLE):
        return c.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("bigint")
    v = c.cast("double")
    return F.when(~F.isnan(v), v)


@dataclass(frozen=True)
class Extent:
    """Number of keys, and brackets of values in which ranks are wanted."""

    n: int
    brackets: list[tuple] = field(default_factory=list)


@dataclass(frozen=True)
class Spot:
    """What stands at a rank: the key, how many rows have a smaller one and how many the same."""

    key: int | float
    below: int
    equal: int


def _sql(value: int | float) -> str:
    """A BIGINT or DOUBLE literal."""
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"double('{value!r}')"
    return f"{value}L" if value > -(1 << 63) else f"({value + 1}L - 1L)"


def _probes(fractions: Sequence[float]) -> list[float]:
    return [min(1.0, max(0.0, p + s)) for p in fractions for s in (-_SLACK, _SLACK)]


def _pairs(probes: list | None) -> list[tuple]:
    return list(zip(probes[::2], probes[1::2])) if probes else []


def extent_columns(key: Column, fractions: Sequence[float], name: str) -> list[Column]:
    """Aggregates that :func:`extent_of` reads, named by ``name``."""
    return [F.count(key).alias(f"n_{name}"), F.percentile_approx(key, _probes(fractions or [0.5]), ACCURACY).alias(f"probes_{name}")]


def extent_of(row: Row, name: str) -> Extent:
    return Extent(row[f"n_{name}"], _pairs(row[f"probes_{name}"]))


def extents(df: DataFrame, keys: dict, fractions: dict, *more: Column) -> tuple[dict[object, Extent], Row]:
    """Extents of several keys, and the row of ``more`` aggregates taken in the same pass."""
    own = [k.alias(f"_key{i}") for i, k in enumerate(keys.values())]
    narrow = df.select("*", *own) if more else df.select(*own)
    columns = [c for i, name in enumerate(keys) for c in extent_columns(F.col(f"_key{i}"), fractions[name], str(i))]
    row = narrow.agg(*columns, *more).first()
    return {name: extent_of(row, str(i)) for i, name in enumerate(keys)}, row


@dataclass
class _Cell:
    """Keys between two values, these left out (None: no bound); how many lie below and inside, the ranks sought, brackets."""

    low: int | float | None
    high: int | float | None
    below: int
    size: int
    ranks: list[int]
    brackets: list[tuple] = field(default_factory=list)

    def inside(self, name: str) -> Column:
        bounds = [f"{name} {sign} {_sql(v)}" for sign, v in ((">", self.low), ("<", self.high)) if v is not None]
        return F.expr(" AND ".join(bounds) or f"{name} IS NOT NULL")

    @property
    def origin(self) -> int | float:
        """What the sketch counts from: it works in DOUBLE, so far BIGINTs are told apart by their distance from an end."""
        if isinstance(self.low, int):
            return self.low
        return self.high if isinstance(self.high, int) else 0

    def shifted(self, name: str) -> Column:
        if not self.origin:
            return F.col(name)
        return F.expr(f"coalesce(try_subtract({name}, {_sql(self.origin)}), {_sql(_MOST if isinstance(self.low, int) else _LEAST)})")

    def unshifted(self, brackets: list[tuple]) -> list[tuple]:
        if not self.origin:
            return brackets
        back = [tuple(min(_MOST, max(_LEAST, v + self.origin)) for v in pair) for pair in brackets]
        if self.low is not None and self.high is not None and self.high - self.low >= 1 << 53:
            middle = (self.low + self.high) // 2  # distances are rounded, so halve the cell besides
            back.append((middle, middle))
        return back

    def parts(self) -> list[tuple]:
        """Rising parts ``(low, high, by value)``; equal ends stand for one value, all others are not part of it."""
        if self.size <= FEW:
            return [(self.low, self.high, True)]
        merged: list[list] = []
        for a, b in sorted(self.brackets):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        # Inside a bracket lie at most six parts in ACCURACY of the rows, ends apart.
        by_value = self.size * 8 / ACCURACY * len(self.brackets) / max(1, len(merged)) <= FEW
        out, at = [], self.low
        for a, b in merged:
            out += [(at, a, False), (a, a, False)] + ([(a, b, by_value), (b, b, False)] if b != a else [])
            at = b
        return [*out, (at, self.high, False)]


def _counted(df: DataFrame, cells: list[list[_Cell]]) -> dict[tuple[int, int], list[tuple]]:
    """``{(key's number, cell's number): [(low, high, rows)]}``, rising, in one pass over the key columns."""
    live = [i for i, some in enumerate(cells) if some]
    parts = {(i, j): c.parts() for i in live for j, c in enumerate(cells[i])}
    codes: list[tuple] = [(i, j, k) for (i, j), some in parts.items() for k in range(len(some))]
    number = {place: n for n, place in enumerate(codes)}
    coded = []
    for i in live:
        key, branches = f"_key{i}", [f"WHEN _key{i} IS NULL THEN NULL"]
        for j, c in enumerate(cells[i]):  # rising and apart: the first condition that holds decides
            if c.low is not None:
                branches.append(f"WHEN {key} <= {_sql(c.low)} THEN NULL")
            for k, (low, high, _) in enumerate(parts[i, j]):
                sign = "=" if low == high and low is not None else "<"
                branches.append(f"WHEN {key} {sign} {_sql(high)} THEN {number[i, j, k]}" if high is not None else f"ELSE {number[i, j, k]}")
        coded.append(F.expr(f"CASE {' '.join(branches)} END").alias(f"_code{i}"))
    narrow = df.select(*[f"_key{i}" for i in live], *coded)
    kinds = {df.schema[f"_key{i}"].dataType for i in live}
    single = [number[place] for place in codes if parts[place[:2]][place[2]][2]]
    columns = []
    for i in live:
        v = F.when(F.col(f"_code{i}").isin(single), F.col(f"_key{i}"))
        is_double = isinstance(df.schema[f"_key{i}"].dataType, T.DoubleType)
        if len(kinds) == 1:
            values = [v.alias("v")]
        else:  # whole numbers and doubles side by side
            values = [(F.lit(None).cast("bigint") if is_double else v).alias("v"), (v if is_double else F.lit(None).cast("double")).alias("w")]
        columns.append([F.col(f"_code{i}").alias("code"), *values])
    names = ["code", "v"] if len(kinds) == 1 else ["code", "v", "w"]
    long = narrow.select(*columns[0]) if len(live) == 1 else narrow.select(F.inline(F.array(*[F.struct(*c) for c in columns])))
    out: dict[tuple[int, int], list] = {place: [] for place in parts}
    for r in long.where("code IS NOT NULL").groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect():
        i, j, k = codes[r.code]
        low, high, by_value = parts[i, j][k]
        if by_value:
            low = high = r.v if len(kinds) == 1 or r.v is not None else r.w
        out[i, j].append((k, low, high, r.n))
    return {place: [some[1:] for some in sorted(found, key=lambda f: (f[0], f[1] if parts[place][f[0]][2] else 0))] for place, found in out.items()}


def _bracket(df: DataFrame, cells: list[list[_Cell]]) -> None:
    """Find brackets for the cells of many rows, in one pass."""
    wide = [(i, c) for i, some in enumerate(cells) for c in some if c.size > FEW]
    if wide:
        row = df.agg(
            *[
                F.percentile_approx(F.when(c.inside(f"_key{i}"), c.shifted(f"_key{i}")), _probes([(r - c.below) / c.size for r in c.ranks]), ACCURACY).alias(str(k))
                for k, (i, c) in enumerate(wide)
            ]
        ).first()
        for k, (_, c) in enumerate(wide):
            c.brackets = c.unshifted(_pairs(row[k]))


def spots(df: DataFrame, keys: dict, known: dict[object, Extent], ranks: dict) -> dict[object, dict[int, Spot]]:
    """What stands at the wanted ranks (from 0) of each key; ranks past the end are left out.

    Keys are BIGINT or DOUBLE columns without NaN. ``df`` is read several
    times: pass a table or a written frame.
    """
    names = list(keys)
    narrow = df.select(*[k.alias(f"_key{i}") for i, k in enumerate(keys.values())])
    found: dict[object, dict[int, Spot]] = {name: {} for name in names}
    cells: list[list[_Cell]] = []
    for name in names:
        e = known[name]
        sought = sorted({r for r in ranks[name] if 0 <= r < e.n})
        cells.append([_Cell(None, None, 0, e.n, sought, e.brackets)] if sought else [])
    while any(cells):
        counts = _counted(narrow, cells)
        for i, name in enumerate(names):
            following = []
            for j, c in enumerate(cells[i]):
                below = c.below
                for low, high, n in counts[i, j]:
                    mine = [r for r in c.ranks if below <= r < below + n]
                    if mine and low == high and low is not None:
                        found[name] |= dict.fromkeys(mine, Spot(low, below, n))
                    elif mine:
                        following.append(_Cell(low, high, below, n, mine))
                    below += n
            cells[i] = following
        _bracket(narrow, cells)
    return {name: dict(sorted(at.items())) for name, at in found.items()}


def quantiles(df: DataFrame, keys: dict, known: dict[object, Extent], probs: Sequence[float]) -> dict[object, list[float]]:
    """Quantiles of number keys, linear between neighbours; a key without values has no entry."""
    places = {
        name: [(math.floor(at), math.ceil(at), at - math.floor(at)) for at in (p * (e.n - 1) for p in probs)]
        for name, e in known.items()
        if e.n
    }
    wanted = {name: [r for low, high, _ in places.get(name, []) for r in (low, high)] for name in keys}
    at = spots(df, keys, known, wanted)
    out = {}
    for name, found in places.items():
        value = {r: s.key for r, s in at[name].items()}
        out[name] = [float(value[a] + (value[b] - value[a]) * t if t else value[a]) for a, b, t in found]
    return out


def key_parts(c: Column, kind: T.DataType, longest: int) -> Iterator[Column]:
    """Order keys that together order the column as it is: one, or for texts of up to ``longest`` bytes
    seven bytes each, then the length."""
    if not isinstance(kind, T.StringType):
        yield order_key(c, kind)
        return
    raw = F.encode(c, "UTF-8")
    for at in range(0, longest, 7):
        yield F.conv(F.rpad(F.hex(F.substring(raw, at + 1, 7)), 14, "0"), 16, 10).cast("bigint")
    yield F.octet_length(c).cast("bigint")  # texts that are equal but for bytes of zero at the end


def nth_of_ties(df: DataFrame, ties: dict, key: str) -> dict[tuple, object]:
    """For each name ``(condition, ranks, rows)``: the ``key`` at those ranks, by name and rank.

    Among the ``rows`` rows for which the condition holds, ranks (from 0)
    follow the order of the key. Rows for which no condition holds are left
    out first. Long texts are told apart piece by piece, as far as needed.
    """
    if not ties:
        return {}
    kind = df.schema[key].dataType
    df = df.where(reduce(or_, [condition for condition, _, _ in ties.values()]))  # a small part of the rows, as a rule
    longest = (df.agg(F.max(F.octet_length(key))).first()[0] or 0) if isinstance(kind, T.StringType) else 0
    done: dict[tuple, object] = {}
    rows_of: dict[tuple, Column] = {}
    # (name, rows below): condition, rows, wanted ranks; ranks count from the first row of the name
    left = {(name, 0): (condition, rows, list(ranks)) for name, (condition, ranks, rows) in ties.items()}
    for part in key_parts(F.col(key), kind, longest):
        if not left:
            break
        keys = {at: F.when(condition, part) for at, (condition, _, _) in left.items()}
        known = {at: Extent(rows) for at, (_, rows, _) in left.items()}
        inner = {(name, below): [r - below for r in ranks] for (name, below), (_, _, ranks) in left.items()}
        if many := {at: keys[at] for at, e in known.items() if e.n > FEW}:
            known |= extents(df, many, {at: [r / known[at].n for r in inner[at]] for at in many})[0]
        found, following = spots(df, keys, known, inner), {}
        for (name, below), (condition, _, ranks) in left.items():
            for r in ranks:
                spot = found[name, below][r - below]
                if isinstance(kind, T.IntegralType):
                    done[name, r] = spot.key
                    continue
                rows_of[name, r] = condition & (part == F.lit(spot.key))
                if spot.equal > 1:
                    following.setdefault((name, below + spot.below), (rows_of[name, r], spot.equal, []))[2].append(r)
        left = following
    if rows_of:  # other keys than whole numbers are read from the rows found
        row = df.agg(*[F.max(F.when(condition, F.col(key))).alias(str(i)) for i, condition in enumerate(rows_of.values())]).first()
        done |= {at: row[i] for i, at in enumerate(rows_of)}
    return done
