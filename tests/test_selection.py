"""Selection by counting against sorted lists."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.operators import selection as S
from tallyroom.operators.learning import medians, stratified_split
from tallyroom.operators.metrics import roc_auc
from tallyroom.operators.ranking import Axis, global_ntile

def keys_of(spark, values, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return df, S.order_key(F.col("v"), df.schema["v"].dataType)


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("bigint", [-(1 << 63), -1, 0, (1 << 53) + 1, (1 << 53) + 2, (1 << 63) - 1]),
        ("date", [dt.date(1, 1, 1), dt.date(1970, 1, 1), dt.date(2024, 2, 29)]),
        ("timestamp", [dt.datetime(1900, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1)]),
        ("decimal(18,4)", [T.decimal.Decimal(x) for x in ("-99999999999999.9999", "-0.0001", "0", "99999999999999.9999")]),
    ],
)
def test_other_keys_keep_order_and_digits(spark, kind, values):
    df, key = keys_of(spark, values, kind)
    rows = df.select("v", key.alias("k")).collect()
    assert len({r.k for r in rows}) == len(values)
    assert [r.v for r in sorted(rows, key=lambda r: r.k)] == sorted(r.v for r in rows)


@pytest.mark.parametrize("few", [1 << 11, 3])
def test_spots_of_skewed_and_wide_keys(spark, monkeypatch, few):
    """One value with a third of the rows, values from one end of the doubles to the other, brackets that miss."""
    monkeypatch.setattr(S, "FEW", few)
    rng = np.random.default_rng(5)
    wide = np.concatenate([rng.normal(size=3000) * 10.0 ** rng.integers(-300, 300, 3000), np.full(1500, 7.0), [math.inf, -math.inf, 5e-324]])
    df, key = keys_of(spark, [*(float(v) for v in wide), math.nan])
    keys = {"a": key, "b": F.when(F.col("v") > 0, key), "c": F.floor(F.least(F.greatest("v", F.lit(-5.0)), F.lit(5.0)))}
    known, _ = S.extents(df.repartition(5), keys, {"a": [0.1, 0.5, 0.9], "b": [], "c": [0.5]})
    known["b"] = S.Extent(known["b"].n, [(1e-9, 2e-9), (-3.0, -1.0), (1e-9, 3e-9)])
    ranks = {"a": [0, 450, 451, 2250, 4499, 4502, 9999], "b": [0, 17, known["b"].n - 1], "c": [5, 3000]}
    got = S.spots(df, keys, known, ranks)
    whole = np.append(np.floor(np.clip(wide, -5, 5)), 5)  # NaN is the greatest number
    for name, values in (("a", np.sort(wide)), ("b", np.sort(wide[wide > 0])), ("c", np.sort(whole))):
        for r in ranks[name]:
            if r < len(values):
                s = got[name][r]
                assert s.key == values[r]
                assert (s.below, s.equal) == ((values < values[r]).sum(), (values == values[r]).sum())
    assert 9999 not in got["a"]


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.exponential(50, 3000), 1).tolist() + [0.0] * 1500
    df, key = keys_of(spark, values + [None] * 10)
    probs = [i / 10 for i in range(1, 10)]
    known, row = S.extents(df, {"f": key, "none": F.when(F.col("v") < 0, key)}, {"f": probs, "none": probs}, F.count(F.lit(1)).alias("rows"))
    assert row.rows == 4510 and known["none"].n == 0
    found = S.quantiles(df, {"f": key, "none": F.when(F.col("v") < 0, key)}, known, probs)
    assert found["f"] == pytest.approx(np.quantile(values, probs).tolist(), abs=1e-12) and "none" not in found
    assert medians(spark.createDataFrame([(1.0, None), (4.0, None), (9.0, None), (10.0, None)], "a double, b double"), ["a", "b"]) == {"a": 6.5, "b": 0.0}


def ends(n, k):
    size, extra = divmod(n, k)
    return [b + 1 for b in range(k) for _ in range(size + (b < extra))]


def test_ntile_of_neighbouring_bigints_and_text_keys(spark):
    """Values that are one double, NULL beside the largest BIGINT, and keys that share long beginnings."""
    top = (1 << 63) - 1
    values = [(1 << 53) + i for i in range(40)] + [top] * 9 + [None] * 11 + [5] * 30
    names = [f"{'x' * (i % 3 * 8)}{i % 5:09d}" + "\0" * (i % 2) + "ж" * (i % 4) + str(i // 60) for i in range(len(values))]
    assert len(set(names)) == len(names)
    df = spark.createDataFrame(list(zip(names, values)), "name string, v bigint").repartition(4)
    for descending in (False, True):
        got = {r.name: r.b for r in global_ntile(df, 8, {"b": Axis("v", descending)}, "name").collect()}
        order = sorted(range(len(values)), key=lambda i: (values[i] is None, (-1 if descending else 1) * (values[i] or 0), names[i].encode()))
        assert [got[names[i]] for i in order] == ends(len(values), 8)


@pytest.mark.parametrize("descending", [False, True])
def test_ntile_of_nan_and_infinity(spark, descending):
    values = [math.nan] * 5 + [math.inf] * 4 + [None] * 6 + [-math.inf, 0.0, -0.0, 1.5] * 2
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(3)
    rank = {True: -1, False: 1}[descending]

    def place(i):
        v = values[i]
        return (2, 0) if v is None else (rank, 0) if math.isnan(v) else (0, -v if descending else v)

    got = {r.id: r.b for r in global_ntile(df, 6, {"b": Axis("v", descending)}, "id").collect()}
    assert [got[i] for i in sorted(got, key=lambda i: (*place(i), i))] == ends(len(values), 6)


def test_nothing_is_shuffled_but_counts(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("v"))
    plan = global_ntile(df, 5, {"b": Axis("v")}, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("share", [0.2, 0.5, 0.0, 1.0])
def test_split_takes_exact_shares(spark, share):
    rows = [(i, None if i % 50 == 0 else i % 3) for i in range(1000)] + [(7, 1)] * 40
    df = spark.createDataFrame(rows, "id int, c int")
    out = stratified_split(df, "id", "c", share).collect()
    for c in range(3):
        mine = [r.is_test for r in out if r.c == c]
        if c != 1:  # rows with one key go together
            assert sum(mine) == math.floor(len(mine) * share + 0.5)
    assert not any(r.is_test for r in out if r.c is None)


def test_auc_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    for scores in (rng.normal(size=400), rng.integers(0, 3, 400) / 2, np.zeros(50)):
        labels = (rng.random(len(scores)) < 0.4).astype(int)
        df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "score double, label int").repartition(3)
        pos, neg = scores[labels == 1][:, None], scores[labels == 0][None, :]
        assert roc_auc(df).first()[0] == pytest.approx(((pos > neg) + (pos == neg) / 2).mean(), abs=1e-12)
    assert roc_auc(df.where("label = 1")).first()[0] is None
    assert roc_auc(df.limit(0)).first()[0] is None


@pytest.mark.parametrize("value", [(1 << 53) + 1, -(1 << 53) - 1, (1 << 63) - 1, -(1 << 63), (1 << 60) + 3])
def test_many_rows_of_a_big_key_end(spark, monkeypatch, value):
    """Keys that the sketch, which works in DOUBLE, rounds to a neighbour: each round must narrow the search."""
    monkeypatch.setattr(S, "FEW", 3)
    narrow, rounds = S._bracket, []

    def counted(df, cells):
        rounds.append(1)
        assert len(rounds) < 80, "no progress"
        narrow(df, cells)

    monkeypatch.setattr(S, "_bracket", counted)
    near = [value] * 10 + [v for v in (value - 1, value + 1) if -(1 << 63) <= v < 1 << 63] * 5 + [5, -(1 << 63) + 7, (1 << 63) - 9]
    df, key = keys_of(spark, near, "bigint")
    known, _ = S.extents(df, {"a": key}, {"a": [0.5]})
    got = S.spots(df, {"a": key}, known, {"a": list(range(len(near)))})["a"]
    assert [got[r].key for r in range(len(near))] == sorted(near)


def test_ties_read_only_their_own_rows(spark, monkeypatch):
    seen, spots = [], S.spots
    monkeypatch.setattr(S, "spots", lambda df, *more: seen.append(df.count()) or spots(df, *more))
    df = spark.range(10_000).select("id", (F.col("id") % 1000).alias("v")).repartition(3)
    ties = {v: (F.col("v") == v, [0, 9], 10) for v in (3, 500)}
    assert S.nth_of_ties(df, ties, "id") == {(3, 0): 3, (3, 9): 9003, (500, 0): 500, (500, 9): 9500}
    assert seen and max(seen) == 20
