"""Compare a registered query with its SQL, row by row."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads TO 8")
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, sorted(tuple(_cell(r[c]) for c in columns) for r in df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(_cell(r[i]) for i in order) for r in cursor.fetchall())
    return sorted(names), rows


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    columns, ours = spark_rows(df)
    names, theirs = sql_rows(con, sql)
    if columns != names:
        return f"columns {columns} / {names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(c, x[:80], y[:80]) for c, x, y in zip(columns, a, b) if x != y]
        return f"{len(wrong)} rows differ, first {cells}"
    return None
