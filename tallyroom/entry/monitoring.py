"""Registered queries: drift between two periods of the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroom.entry.adapters import entity, with_sql
from tallyroom.entry.book import plain, query
from tallyroom.functions.exprs import round_half_away
from tallyroom.operators import drift as D
from tallyroom.sources.durable import shared_root
from tallyroom.sources.readers import new_batch_id

CONFIG = D.DriftConfig(numeric=("value",), categorical=("event_type",))
_STAMP = "2024-02-01T00:00:00+00:00"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return plain(df.withColumns({c: round_half_away(c, 6) for c in columns}))


_CUTS = """
, cuts AS (SELECT list_sort(list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS c
    FROM drift_before)"""


def _numeric_shares(source: str, name: str) -> str:
    return f"""
, {name}_bins AS (SELECT CASE WHEN value IS NULL THEN len(c) + 1
    ELSE len(list_filter(c, lambda x: x < value)) END AS bin, value FROM {source}, cuts)
, {name} AS (SELECT s.bin, CAST(count(b.bin) AS DOUBLE) / (SELECT count(*) FROM {source}) AS p
    FROM (SELECT unnest(range(0, len(c) + 2)) AS bin FROM cuts) AS s LEFT JOIN {name}_bins AS b ON b.bin = s.bin
    GROUP BY s.bin)"""


_CATEGORIES = """
, categories AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS bin FROM
    (SELECT DISTINCT coalesce(event_type, '__NULL__') AS category FROM drift_before))
, all_categories AS (SELECT bin, category FROM categories UNION ALL SELECT count(*), NULL FROM categories)"""


def _category_shares(source: str, name: str) -> str:
    return f"""
, {name} AS (SELECT a.bin, CAST(count(e.event_type) AS DOUBLE) / (SELECT count(*) FROM {source}) AS p
    FROM all_categories AS a LEFT JOIN (SELECT event_type, coalesce(k.bin, (SELECT count(*) FROM categories)) AS bin
        FROM {source} LEFT JOIN categories AS k ON k.category = event_type) AS e ON e.bin = a.bin
    GROUP BY a.bin)"""


@query(
    "drift_profile_numeric",
    with_sql("drift_before")
    + _CUTS
    + _numeric_shares("drift_before", "shares")
    + """
SELECT 'value' AS feature, 'numeric' AS kind, CAST(bin AS BIGINT) AS bin,
    CASE WHEN bin BETWEEN 1 AND len(c) THEN round(c[bin], 6) END AS lower,
    CASE WHEN bin < len(c) THEN round(c[bin + 1], 6) END AS upper, round(p, 6) AS proportion,
    round((SELECT CAST(count(*) - count(value) AS DOUBLE) / count(*) FROM drift_before), 6) AS null_rate,
    round((SELECT avg(value) FROM drift_before), 6) AS mean, (SELECT count(*) FROM drift_before) AS row_count
FROM shares, cuts""",
)
def drift_profile_numeric(spark: SparkSession, d: str) -> DataFrame:
    found = D.profile(entity(spark, d, "drift_before"), CONFIG, created_at=_STAMP)
    numeric = found.where(F.col("kind") == "numeric").drop("category", "created_at")
    return _rounded(numeric, "lower", "upper", "proportion", "null_rate", "mean")


@query(
    "drift_profile_categorical",
    with_sql("drift_before")
    + _CATEGORIES
    + _category_shares("drift_before", "shares")
    + """
SELECT 'event_type' AS feature, CAST(bin AS BIGINT) AS bin, category, round(p, 6) AS proportion
FROM shares JOIN all_categories USING (bin)""",
)
def drift_profile_categorical(spark: SparkSession, d: str) -> DataFrame:
    found = D.profile(entity(spark, d, "drift_before"), CONFIG, created_at=_STAMP)
    categorical = found.where(F.col("kind") == "categorical")
    return _rounded(categorical.select("feature", "bin", "category", "proportion"), "proportion")


_TERM = "(greatest(a.p, 1e-6) - greatest(e.p, 1e-6)) * ln(greatest(a.p, 1e-6) / greatest(e.p, 1e-6))"
_BOTH = (
    with_sql("drift_before", "drift_after")
    + _CUTS
    + _numeric_shares("drift_before", "ne")
    + _numeric_shares("drift_after", "na")
    + _CATEGORIES
    + _category_shares("drift_before", "ce")
    + _category_shares("drift_after", "ca")
    + f"""
, scores AS (SELECT 'value' AS feature, 'numeric' AS kind, sum({_TERM}) AS psi FROM ne AS e JOIN na AS a USING (bin)
    UNION ALL SELECT 'event_type', 'categorical', sum({_TERM}) FROM ce AS e JOIN ca AS a USING (bin))"""
)
_SEVERITY = "CASE WHEN {0} >= 0.25 THEN 'high' WHEN {0} >= 0.1 THEN 'warning' ELSE 'stable' END"


@query("drift_psi", _BOTH + " SELECT feature, kind, round(psi, 6) AS psi FROM scores")
def drift_psi(spark: SparkSession, d: str) -> DataFrame:
    baseline = D.profile(entity(spark, d, "drift_before"), CONFIG)
    current = D.profile_like(entity(spark, d, "drift_after"), baseline, CONFIG)
    return _rounded(D.psi(baseline, current), "psi")




@query(
    "drift_report",
    _BOTH
    + f"""
SELECT feature, kind, round(psi, 6) AS psi, {_SEVERITY.format("psi")} AS severity,
    CASE kind WHEN 'numeric' THEN round((SELECT avg(value) FROM drift_before), 6) END AS baseline_mean,
    CASE kind WHEN 'numeric' THEN round((SELECT avg(value) FROM drift_after), 6) END AS current_mean,
    CASE kind WHEN 'numeric' THEN round((SELECT 1 - CAST(count(value) AS DOUBLE) / count(*) FROM drift_before), 6) END
        AS baseline_null_rate,
    CASE kind WHEN 'numeric' THEN round((SELECT 1 - CAST(count(value) AS DOUBLE) / count(*) FROM drift_after), 6) END
        AS current_null_rate
FROM scores""",
)
def drift_report(spark: SparkSession, d: str) -> DataFrame:
    baseline = D.profile(entity(spark, d, "drift_before"), CONFIG)
    _, features = D.drift_report(baseline, entity(spark, d, "drift_after"), CONFIG)
    return _rounded(
        features, "baseline_mean", "current_mean", "baseline_null_rate", "current_null_rate"
    )


@query(
    "drift_summary",
    _BOTH
    + f"""
, worst AS (SELECT max(round(psi, 6)) AS m FROM scores)
, sizes AS (SELECT (SELECT count(*) FROM drift_before) AS b, (SELECT count(*) FROM drift_after) AS c)
SELECT 'checked' AS status, b AS baseline_rows, c AS current_rows,
    round(CAST(c - b AS DOUBLE) / b, 6) AS row_count_change_ratio, CAST(0.1 AS DOUBLE) AS warning_threshold,
    CAST(0.25 AS DOUBLE) AS high_threshold, m AS max_psi, {_SEVERITY.format("m")} AS severity,
    m >= 0.25 AS drift_detected, m >= 0.1 AS warning_detected
FROM worst, sizes""",
)
def drift_summary(spark: SparkSession, d: str) -> DataFrame:
    baseline = D.profile(entity(spark, d, "drift_before"), CONFIG)
    summary, _ = D.drift_report(baseline, entity(spark, d, "drift_after"), CONFIG)
    return summary.drop("baseline_created_at")


@query(
    "drift_lifecycle",
    _BOTH
    + f"""
, worst AS (SELECT max(round(psi, 6)) AS m FROM scores)
, sizes AS (SELECT (SELECT count(*) FROM drift_before) AS b, (SELECT count(*) FROM drift_after) AS c)
, checked AS (SELECT 'checked' AS status, b AS baseline_rows, c AS current_rows, m AS max_psi, {_SEVERITY.format("m")} AS severity FROM worst, sizes)
SELECT CAST(1 AS BIGINT) AS step, 'baseline_created' AS status, b AS baseline_rows, b AS current_rows, CAST(0 AS DOUBLE) AS max_psi, 'stable' AS severity FROM sizes
UNION ALL SELECT 2, * FROM checked
UNION ALL SELECT 3, * FROM checked
UNION ALL SELECT 4, 'checked', c, c, 0, 'stable' FROM sizes""",
)
def drift_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """First run, a check, a refresh that breaks off before it counts, and a refresh."""
    before, after = entity(spark, d, "drift_before"), entity(spark, d, "drift_after")
    store = D.DriftStore(f"{shared_root(spark)}/drift-{new_batch_id()}")
    D.run_drift(spark, before, store, CONFIG)
    D.run_drift(spark, after, store, CONFIG)
    D.write_profile(after, store, CONFIG)
    D.run_drift(spark, after, store, CONFIG)
    D.refresh_baseline(after, store, CONFIG)
    D.run_drift(spark, after, store, CONFIG)
    step = F.row_number().over(Window.orderBy("checked_at"))  # four reports
    reports = spark.read.json(store.history).withColumn("step", step)
    return plain(reports.select("step", "status", "baseline_rows", "current_rows", "max_psi", "severity"))
