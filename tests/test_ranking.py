"""Distributed ranks against plain Python."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyroom.operators.ranking import (
    Axis,
    global_dense_rank,
    global_ntile,
    global_row_number,
)
from tallyroom.operators.selection import extents, order_key, quantiles, spots

QUICK = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def ntile(n: int, k: int) -> list[int]:
    size, extra = divmod(n, k)
    return [b + 1 for b in range(k) for _ in range(size + (b < extra))]


def test_row_number_with_one_value_for_a_third(spark):
    rows = [(0 if i % 3 == 0 else i, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "v int, id int").repartition(9)
    got = {r.id: r.g for r in global_row_number(df, ["v", "id"], "g").collect()}
    assert [got[i] for _, i in sorted(rows)] == list(range(1, 5001))


@QUICK
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=0, max_size=40), st.integers(1, 7))
def test_ntile(spark, values, k):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    out = global_ntile(df, k, {"up": Axis("v"), "down": Axis("v", descending=True)}, "id").collect()
    for name, sign in (("up", 1), ("down", -1)):
        order = sorted(range(len(values)), key=lambda i: (values[i] is None, sign * (values[i] or 0), i))
        want = dict(zip(order, ntile(len(values), k)))
        assert {r.id: r[name] for r in out} == want


def test_ntile_with_fewer_rows_than_buckets(spark):
    df = spark.createDataFrame([(i, i) for i in range(3)], "id int, v int")
    out = global_ntile(df, 5, {"b": Axis("v")}, "id").collect()
    assert sorted(r.b for r in out) == [1, 2, 3]


@pytest.mark.parametrize("descending", [False, True])
def test_dense_rank_with_nulls(spark, descending):
    values = [5.0, 5.0, 1.0, None, 9.0, None, 1.0]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = {r.id: r.place for r in global_dense_rank(df, "v", "place", descending=descending).collect()}
    distinct = sorted({v for v in values if v is not None}, reverse=descending)
    want = {i: len(distinct) + 1 if v is None else distinct.index(v) + 1 for i, v in enumerate(values)}
    assert got == want


def test_rows_at_ranks_per_group(spark):
    rows = [("a", i) for i in range(100)] + [("b", i) for i in range(7)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    keys = {g: F.when(F.col("g") == g, F.col("v").cast("bigint")) for g in "ab"}
    known, _ = extents(df, keys, {"a": [0.5], "b": [0.5]})
    found = spots(df, keys, known, {g: [0, known[g].n // 2 - 1, known[g].n - 1] for g in "ab"})
    assert [s.key for s in found["a"].values()] == [0, 49, 99]
    assert [s.key for s in found["b"].values()] == [0, 2, 6]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)] * 3, "value double")
    keys = {"f": order_key(F.col("value"), df.schema["value"].dataType)}
    known, _ = extents(df, keys, {"f": [0.5]})
    assert quantiles(df, keys, known, [0.5]) == {}
