"""Drift profiles against numpy, and the life of a baseline."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroom.operators import drift as D

CFG = D.DriftConfig(numeric=("x",), categorical=("kind", "flag"))
SCHEMA = "x double, kind string, flag boolean"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def skewed(seed, n=800, shift=0.0):
    rng = np.random.default_rng(seed)
    xs = np.round(rng.normal(10 + shift, 3, n), 1)
    return [
        (None if i % 11 == 0 else float(x), None if i % 7 == 0 else "abc"[i % 3], bool(i % 2)) for i, x in enumerate(xs)
    ]


def shares(profile, feature):
    return [r.proportion for r in profile.where(F.col("feature") == feature).orderBy("bin").collect()]


def numpy_shares(xs, cuts):
    clean = np.array([x for x in xs if x is not None])
    counts = np.bincount(np.digitize(clean, cuts, right=True), minlength=len(cuts) + 1) / len(xs)
    return [*counts, 1 - len(clean) / len(xs)]


def test_profile_matches_numpy(spark):
    rows = skewed(1)
    xs = [r[0] for r in rows]
    cuts = sorted(set(np.quantile([x for x in xs if x is not None], np.linspace(0.1, 0.9, 9))))
    found = D.profile(frame(spark, rows), CFG)
    uppers = [r.upper for r in found.where("feature = 'x' AND upper IS NOT NULL").orderBy("bin").collect()]
    assert uppers == pytest.approx(cuts)
    assert shares(found, "x") == pytest.approx(numpy_shares(xs, cuts))
    row = found.where("feature = 'x'").first()
    assert row.null_rate == pytest.approx(xs.count(None) / len(xs)) and row.row_count == len(rows)
    assert row["mean"] == pytest.approx(np.mean([x for x in xs if x is not None]))
    kinds = found.where("feature = 'kind'").orderBy("bin").collect()
    assert [r.category for r in kinds] == ["__NULL__", "a", "b", "c", None]
    for feature in ("x", "kind", "flag"):
        assert sum(shares(found, feature)) == pytest.approx(1, abs=1e-9)


def test_psi_of_itself_is_zero_and_of_others_positive(spark):
    base = D.profile(frame(spark, skewed(1)), CFG)
    same = D.profile_like(frame(spark, skewed(1)), base, CFG)
    assert all(abs(r.psi) < 1e-12 for r in D.psi(base, same).collect())
    other = D.profile_like(frame(spark, skewed(2, shift=4.0)), base, CFG)
    got = {r.feature: r.psi for r in D.psi(base, other).collect()}
    assert all(v >= 0 for v in got.values())
    e, a = np.clip(shares(base, "x"), 1e-6, None), np.clip(shares(other, "x"), 1e-6, None)
    assert got["x"] == pytest.approx(float(np.sum((a - e) * np.log(a / e))))


def test_unseen_categories_are_pooled(spark):
    base = D.profile(frame(spark, [(1.0, "a", True)] * 4), CFG)
    now = D.profile_like(frame(spark, [(1.0, "new", True), (1.0, "a", None), (1.0, "newer", True), (1.0, "a", True)]), base, CFG)
    assert shares(now, "kind") == [0.5, 0.5]
    assert shares(now, "flag") == [0.75, 0.25]


def test_different_bins_are_an_error(spark):
    base = D.profile(frame(spark, skewed(1)), CFG)
    with pytest.raises(Exception, match="different bins"):
        D.psi(base, base.where("bin > 0")).collect()


@pytest.mark.parametrize("rows", [[(None, None, None)] * 3, [(5.0, "a", True)] * 3, []])
def test_constant_missing_and_empty_features(spark, rows):
    base = D.profile(frame(spark, rows), CFG)
    assert base.where("feature = 'x'").count() == (3 if rows and rows[0][0] else 2)
    summary, features = D.drift_report(base, frame(spark, skewed(3)), CFG)
    row = summary.first()
    assert row.baseline_rows == len(rows) and row.current_rows == 800
    assert row.row_count_change_ratio == (pytest.approx(797 / 3, abs=1e-6) if rows else 0.0)
    assert features.count() == 3 and not math.isnan(row.max_psi)


def test_many_categories_take_the_other_way(spark, monkeypatch):
    """Numbered and joined as a table, a profile is the same as from collected counts."""
    key = ["feature", "bin"]
    before, after = frame(spark, skewed(1)), frame(spark, [*skewed(2, shift=2.0), (1.0, "new", None), (None, "ж", True)])
    few = D.profile(before, CFG, created_at="t")
    like = D.profile_like(after, few, CFG, created_at="t")
    monkeypatch.setattr(D, "CATEGORIES", 3)
    for mine, other in ((few, D.profile(before, CFG, created_at="t")), (like, D.profile_like(after, few, CFG, created_at="t"))):
        assert mine.columns == other.columns
        assert [tuple(r) for r in mine.orderBy(*key).collect()] == [tuple(r) for r in other.orderBy(*key).collect()]
    empty = D.profile(before.limit(0), CFG, created_at="t")
    assert [r.proportion for r in empty.collect()] == [0.0] * empty.count()


def test_no_value_is_shuffled(spark):
    """Only features, bins, categories, counts and sums pass an exchange."""
    binned = D._binned(frame(spark, skewed(1)), CFG, {"x": [9.0, 10.0]}, {"kind": ["a"], "flag": []})
    plan = binned._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in plan.splitlines() if "Exchange" in line)
    assert plan.count("Exchange") == 1 and "value" not in exchange


def test_severity_limits(spark):
    df = spark.createDataFrame([(0.0999999,), (0.1,), (0.2499999,), (0.25,)], "v double")
    assert [r[0] for r in df.select(D.severity(F.col("v"))).collect()] == ["stable", "warning", "warning", "high"]


def test_baseline_life(spark, tmp_path):
    store = D.DriftStore(f"{tmp_path}/drift")
    first = D.run_drift(spark, frame(spark, skewed(1)), store, CFG).first()
    assert (first.status, first.severity, first.baseline_rows) == ("baseline_created", "stable", 800)
    again = D.run_drift(spark, frame(spark, skewed(1)), store, CFG).first()
    assert (again.status, again.max_psi, again.drift_detected) == ("checked", 0.0, False)
    with pytest.raises(D.DriftError, match="psi"):
        D.run_drift(spark, frame(spark, skewed(2, shift=9.0)), store, CFG, fail_on_high=True)
    history = D.drift_history(spark, store)
    assert [r.severity for r in history.collect()] == ["high", "stable", "stable"]
    latest = spark.read.json(store.latest)
    metrics = {r.metric: r.value for r in D.drift_metrics(latest).collect()}
    assert metrics["drift_detected"] == 1.0 and metrics["psi_x"] == metrics["max_psi"] > 0.25
    D.refresh_baseline(frame(spark, skewed(2, shift=9.0)), store, CFG)
    assert D.run_drift(spark, frame(spark, skewed(2, shift=9.0)), store, CFG).first().severity == "stable"


def test_corrupt_baseline(spark, tmp_path):
    store = D.DriftStore(f"{tmp_path}/drift")
    (tmp_path / "drift/baseline").mkdir(parents=True)
    (tmp_path / "drift/baseline/part-0.parquet").write_text("not a table")
    with pytest.raises(D.DriftError, match="cannot be read"):
        D.run_drift(spark, frame(spark, skewed(1)), store, CFG)
