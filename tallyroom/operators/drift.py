"""Population stability of features against a stored baseline.

A profile is a long table, one row per feature and bin:

``feature, kind, bin, lower, upper, category, proportion, null_rate, mean,
row_count, created_at``

Numeric bins are right-closed between the baseline's deciles, and the last
bin holds the NULL share. Categorical bins are the baseline's categories in
text order, and the last bin pools values the baseline does not know. All
features of a frame are binned and counted in one pass; only counts per bin
are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.functions.exprs import round_half_away
from tallyroom.operators.ranking import sorted_runs, with_rank
from tallyroom.operators.selection import extents, order_key, quantiles
from tallyroom.sources.durable import durable, small_frame
from tallyroom.sources.events import append_events, newest, read_events, read_table
from tallyroom.sources.readers import utc_now
from tallyroom.sources.sinks import append_json, overwrite_json

# Fixed values.
DECILES = tuple(i / 10 for i in range(1, 10))
NULL_CATEGORY = "__NULL__"
SMALLEST_SHARE = 1e-6
#: Categories of all features together up to which a profile is put together
#: from collected counts; more are numbered and joined as a table.
CATEGORIES = 10_000


@dataclass(frozen=True)
class DriftConfig:
    numeric: Sequence[str] = ("delivery_delay_days", "review_comment_length")
    categorical: Sequence[str] = ("has_comment", "payment_type_encoded", "satisfied")
    warning: float = 0.10
    high: float = 0.25
    eps: float = SMALLEST_SHARE


PROFILE_COLUMNS = (
    "feature", "kind", "bin", "lower", "upper", "category", "proportion", "null_rate", "mean",
    "row_count", "created_at",
)


def _clean_value(c: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(c), c)


def _number(feature: str) -> Column:
    return _clean_value(F.col(feature).try_cast("double"))


def _category(feature: str) -> Column:
    return F.coalesce(F.col(feature).cast("string"), F.lit(NULL_CATEGORY))


def _binned(
    df: DataFrame, cfg: DriftConfig, cuts: dict[str, list[float]], known: dict[str, list[str]] | None = None
) -> DataFrame:
    """``feature, bin, category, n, total``: all features counted in one pass.

    Values are binned where they are read, so only counts and sums per bin
    meet in a shuffle. Numeric bins count the cutpoints below the value, NULL
    follows the last. Categories that are not ``known`` become NULL there;
    without a list all are counted.
    """
    cells = []
    for f in cfg.numeric:
        value = _number(f)
        below = sum(((value > F.lit(c)).cast("int") for c in cuts[f]), F.lit(0))
        at = F.when(value.isNull(), F.lit(len(cuts[f]) + 1)).otherwise(below)
        cells.append((f, at, F.lit(None).cast("string"), value))
    for f in cfg.categorical:
        category = _category(f)
        if known is not None:
            category = F.when(category.isin(known.get(f, [])), category)
        cells.append((f, F.lit(None).cast("int"), category, F.lit(None).cast("double")))
    names = ("feature", "bin", "category", "value")
    rows = F.array(*[F.struct(*[c.alias(n) for n, c in zip(names, (F.lit(f), *rest))]) for f, *rest in cells])
    return (
        df.select(F.inline(rows))
        .groupBy("feature", "bin", "category")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    )


PROFILE = (
    "feature string, kind string, bin int, lower double, upper double, category string, proportion double, "
    "null_rate double, mean double, row_count bigint, created_at string"
)


def _numeric_rows(counts: list, cfg: DriftConfig, cuts: dict[str, list[float]], rows: int, created_at: str) -> list[tuple]:
    """Profile rows of the numeric features, empty bins included: at most eleven per feature."""
    out = []
    for f in cfg.numeric:
        mine = {r.bin: r for r in counts if r.feature == f}
        missing = mine[len(cuts[f]) + 1].n if len(cuts[f]) + 1 in mine else 0
        total = sum(mine[b].total for b in sorted(mine) if b <= len(cuts[f]))
        mean = total / (rows - missing) if rows > missing else None
        edges = [None, *cuts[f], None]
        for b in range(len(cuts[f]) + 2):
            lower, upper = edges[b : b + 2] if b <= len(cuts[f]) else (None, None)
            share = mine[b].n / rows if b in mine else 0.0
            out.append((f, "numeric", b, lower, upper, None, share, missing / rows if rows else 0.0, mean, rows, created_at))
    return out


def _total_rows(counts: list, cfg: DriftConfig, otherwise: DataFrame) -> int:
    """Every row has one value of every feature."""
    for f in (*cfg.numeric, *cfg.categorical):
        if mine := [r.n for r in counts if r.feature == f]:
            return sum(mine)
    return 0 if cfg.numeric or cfg.categorical else otherwise.count()


def _put_together(
    df: DataFrame,
    cfg: DriftConfig,
    cuts: dict[str, list[float]],
    known: dict[str, list[str]] | None,
    created_at: str | None,
) -> DataFrame:
    """The profile of few categories, from collected counts: one row per bin."""
    at = created_at or utc_now()
    counts = _binned(df, cfg, cuts, known).collect()
    rows = _total_rows(counts, cfg, df)
    out = _numeric_rows(counts, cfg, cuts, rows, at)
    for f in cfg.categorical:
        mine = {r.category: r.n for r in counts if r.feature == f}
        names = sorted((c for c in mine if c is not None), key=str.encode) if known is None else known.get(f, [])
        for b, name in enumerate([*names, None]):
            share = mine[name] / rows if name in mine else 0.0
            out.append((f, "categorical", b, None, None, name, share, None, None, rows, at))
    return small_frame(df.sparkSession, out, PROFILE)


def _categorical(shares: DataFrame, rows: int, created_at: str) -> DataFrame:
    """Profile rows of ``feature, bin, category, n``."""
    null = F.lit(None).cast("double")
    return shares.select(
        "feature", F.lit("categorical").alias("kind"), "bin", null.alias("lower"), null.alias("upper"), "category",
        (F.coalesce("n", F.lit(0)) / F.lit(float(rows or 1))).alias("proportion"), null.alias("null_rate"), null.alias("mean"),
        F.lit(rows).cast("bigint").alias("row_count"), F.lit(created_at).alias("created_at"),
    )


def _spread_out(
    df: DataFrame, cfg: DriftConfig, cuts: dict[str, list[float]], known: DataFrame | None, created_at: str | None
) -> DataFrame:
    """The profile of very many categories: they are numbered and joined as a table.

    ``known``: ``feature, bin, category`` of a baseline.
    """
    spark, at = df.sparkSession, created_at or utc_now()
    counts = durable(_binned(df, cfg, cuts), "drift-counts")
    numbers = counts.where(F.col("feature").isin(list(cfg.numeric))).collect()  # a row per bin
    texts = counts.where(F.col("feature").isin(list(cfg.categorical)))
    rows = _total_rows(numbers, cfg, df) if cfg.numeric else df.count()
    if known is None:
        ranked = with_rank(sorted_runs(texts.select("feature", "category", "n"), ["feature", "category"], "categories"), "at")
        ends = ranked.groupBy("feature").agg(F.min("at").alias("first"), F.count(F.lit(1)).cast("int").alias("m"))
        own = ranked.join(F.broadcast(ends), "feature")  # one row per feature
        own = own.select("feature", (F.col("at") - F.col("first")).cast("int").alias("bin"), "category", "n")
        wanted = small_frame(spark, [(f,) for f in cfg.categorical], "feature string").join(ends, "feature", "left")
        others = wanted.select("feature", F.coalesce("m", F.lit(0)).alias("bin"), F.lit(None).cast("string").alias("category"), F.lit(0).cast("bigint").alias("n"))
        shares = own.unionByName(others)
    else:
        places = known.where(F.col("category").isNotNull())
        unknown = known.where(F.col("category").isNull()).select("feature", F.col("bin").alias("last"))  # one row per feature
        placed = (
            texts.select("feature", "category", "n")
            .join(places, ["feature", "category"], "left")
            .join(F.broadcast(unknown), "feature")
            .groupBy("feature", F.coalesce("bin", "last").alias("bin"))
            .agg(F.sum("n").alias("n"))
        )
        shares = known.join(placed, ["feature", "bin"], "left")
    found = small_frame(spark, _numeric_rows(numbers, cfg, cuts, rows, at), PROFILE).unionByName(_categorical(shares, rows, at))
    return durable(found, "drift-profile")


def profile(df: DataFrame, cfg: DriftConfig = DriftConfig(), *, created_at: str | None = None) -> DataFrame:
    """Profile of a frame with its own cutpoints and categories.

    The deciles are selected by counting (two scans, no sort), then all
    features are binned and counted in one more. ``df`` is read several times.
    """
    keys = {f: order_key(_number(f), T.DoubleType()) for f in cfg.numeric}
    kinds = [F.approx_count_distinct(_category(f)).alias(f"kinds{i}") for i, f in enumerate(cfg.categorical)]
    known, row = extents(df, keys, dict.fromkeys(cfg.numeric, DECILES), *kinds, F.count(F.lit(1)).alias("rows"))
    found = quantiles(df, keys, known, DECILES)
    cuts = {f: sorted(set(found.get(f, []))) for f in cfg.numeric}
    if sum(row[f"kinds{i}"] for i in range(len(kinds))) <= CATEGORIES:
        return _put_together(df, cfg, cuts, None, created_at)
    return _spread_out(df, cfg, cuts, None, created_at)


def profile_like(
    df: DataFrame, baseline: DataFrame, cfg: DriftConfig = DriftConfig(), *, created_at: str | None = None
) -> DataFrame:
    """Profile of a frame in the bins of a baseline profile: one scan."""
    bins = baseline.select("feature", "kind", "bin", "upper", "category").limit(CATEGORIES + 1).collect()
    many = len(bins) > CATEGORIES
    if many:
        bins = baseline.where("kind = 'numeric'").select("feature", "kind", "bin", "upper", "category").collect()  # eleven per feature
    edges = [(r.feature, r.upper) for r in bins if r.kind == "numeric" and r.upper is not None]
    cuts = {f: sorted(u for g, u in edges if g == f) for f in cfg.numeric}
    if many:
        return _spread_out(df, cfg, cuts, baseline.where("kind = 'categorical'").select("feature", "bin", "category"), created_at)
    names: dict[str, list[str]] = {f: [] for f in cfg.categorical}
    for r in sorted(bins, key=lambda r: r.bin):
        if r.kind == "categorical" and r.category is not None and r.feature in names:
            names[r.feature].append(r.category)
    return _put_together(df, cfg, cuts, names, created_at)


def _paired(baseline: DataFrame, current: DataFrame, eps: float) -> DataFrame:
    """The bins of both profiles side by side, with each bin's share of the psi."""
    rest = ("mean", "null_rate", "row_count", "created_at")
    sides = [
        df.select(
            "feature", "kind", "bin", F.col("proportion").alias(p), *[F.col(c).alias(f"{side}_{c}") for c in rest]
        )
        for df, side, p in ((baseline, "baseline", "e"), (current, "current", "a"))
    ]
    values = [c for side in sides for c in side.columns if c not in ("feature", "kind", "bin")]
    both = (
        sides[0]
        .unionByName(sides[1], allowMissingColumns=True)
        .groupBy("feature", "kind", "bin")
        .agg(*[F.max(c).alias(c) for c in values])
    )
    mismatch = F.col("e").isNull() | F.col("a").isNull()
    e, a = F.greatest("e", F.lit(eps)), F.greatest("a", F.lit(eps))
    term = F.when(mismatch, F.raise_error(F.lit("the two profiles have different bins"))).otherwise(
        (a - e) * F.log(a / e)
    )
    return both.withColumn("term", term.cast("double"))


def psi(baseline: DataFrame, current: DataFrame, eps: float = SMALLEST_SHARE) -> DataFrame:
    """``feature, kind, psi``: sum of (a - e) * ln(a / e) over the bins.

    Shares below ``eps`` are lifted to it. A bin only one side has is an error.
    """
    return _paired(baseline, current, eps).groupBy("feature", "kind").agg(F.sum("term").alias("psi"))


def severity(value: Column, cfg: DriftConfig = DriftConfig()) -> Column:
    return (
        F.when(value >= cfg.high, "high").when(value >= cfg.warning, "warning").otherwise("stable")
    )


FEATURE_REPORT = (
    "feature", "kind", "psi", "severity", "baseline_mean", "current_mean", "baseline_null_rate",
    "current_null_rate",
)


def feature_facts(baseline: DataFrame, current: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """The feature report plus row counts and the baseline's time, in one aggregation."""
    facts = [f"{side}_{c}" for side in ("baseline", "current") for c in ("mean", "null_rate", "row_count")]
    return (
        _paired(baseline, current, cfg.eps)
        .groupBy("feature", "kind")
        .agg(
            F.sum("term").alias("raw_psi"),
            *[F.max(c).alias(c) for c in (*facts, "baseline_created_at")],
        )
        .withColumn("psi", round_half_away("raw_psi", 6))
        .withColumn("severity", severity(F.col("raw_psi"), cfg))
    )


def feature_report(baseline: DataFrame, current: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """One row per feature: psi (6 digits), severity (of the exact psi), means, null rates."""
    return feature_facts(baseline, current, cfg).select(*FEATURE_REPORT)


def summary_report(facts: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """One row: row counts, largest psi, overall severity and flags."""
    whole = facts.agg(
        F.max("baseline_created_at").alias("baseline_created_at"),
        F.coalesce(F.max("baseline_row_count"), F.lit(0)).alias("baseline_rows"),
        F.coalesce(F.max("current_row_count"), F.lit(0)).alias("current_rows"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
    )
    overall = severity(F.col("max_psi"), cfg)
    change = F.coalesce(
        (F.col("current_rows") - F.col("baseline_rows")) / F.nullif(F.col("baseline_rows"), F.lit(0)),
        F.lit(0.0),
    )
    return whole.select(
        F.lit("checked").alias("status"),
        "baseline_created_at",
        "baseline_rows",
        "current_rows",
        round_half_away(change, 6).alias("row_count_change_ratio"),
        F.lit(cfg.warning).alias("warning_threshold"),
        F.lit(cfg.high).alias("high_threshold"),
        round_half_away("max_psi", 6).alias("max_psi"),
        overall.alias("severity"),
        (overall == "high").alias("drift_detected"),
        overall.isin("warning", "high").alias("warning_detected"),
    )


def drift_report(
    baseline: DataFrame, df: DataFrame, cfg: DriftConfig = DriftConfig()
) -> tuple[DataFrame, DataFrame]:
    """Compare a frame with a baseline profile: (summary row, feature rows)."""
    current = profile_like(df, baseline, cfg)
    facts = feature_facts(baseline, current, cfg)  # of two profiles, a row per bin
    return summary_report(facts, cfg), facts.select(*FEATURE_REPORT)


class DriftError(RuntimeError):
    """The baseline cannot be read, or drift is high and must stop the run."""


@dataclass(frozen=True)
class DriftStore:
    """Where the baselines, the latest report and the history live.

    Which baseline counts is an event; ``log`` and ``subject`` name a list of
    events kept elsewhere, such as a model's registry.
    """

    root: str
    log: str | None = None
    subject: str = "drift"

    @property
    def events(self) -> str:
        return self.log or f"{self.root.rstrip('/')}/events"

    @property
    def baseline(self) -> str:
        return f"{self.root.rstrip('/')}/baseline"

    @property
    def latest(self) -> str:
        return f"{self.root.rstrip('/')}/latest"

    @property
    def history(self) -> str:
        return f"{self.root.rstrip('/')}/history"


def write_profile(df: DataFrame, store: DriftStore, cfg: DriftConfig = DriftConfig()) -> str:
    """Write the frame's profile as a possible baseline; returns its id. It counts once an event names it."""
    name = uuid.uuid4().hex
    profile(df, cfg).coalesce(1).write.parquet(f"{store.baseline}/id={name}")
    return name


def refresh_baseline(df: DataFrame, store: DriftStore, cfg: DriftConfig = DriftConfig()) -> str:
    """Make the frame's profile the baseline; returns its id.

    The profile is written first and named by an event then, so a run that
    breaks off leaves the old baseline in place.
    """
    name = write_profile(df, store, cfg)
    append_events(df.sparkSession, store.events, [(store.subject, None, "baseline", name, utc_now(), None, None)])
    return name


def current_baseline(spark: SparkSession, store: DriftStore) -> str | None:
    """Id of the baseline that counts, if there is one."""
    try:
        mine = read_events(spark, store.events).where(F.col("model") == store.subject)
        row = newest(mine, "baseline").first()
        if row is None:
            # Nothing that counts; but what lies there must at least be readable.
            read_table(spark, store.baseline, PROFILE).limit(1).collect()
    except Exception as broken:
        raise DriftError(f"drift baseline cannot be read: {store.baseline}") from broken
    return None if row is None else row.value


def load_baseline(spark: SparkSession, store: DriftStore) -> DataFrame:
    name = current_baseline(spark, store)
    if name is None:
        raise DriftError(f"there is no drift baseline: {store.baseline}")
    try:
        stored = spark.read.schema(PROFILE).parquet(f"{store.baseline}/id={name}")
        stored.limit(1).collect()
    except Exception as broken:
        raise DriftError(f"drift baseline cannot be read: {store.baseline}") from broken
    return stored


def _document(summary: DataFrame, features: DataFrame | None, store: DriftStore) -> DataFrame:
    """The summary row with its features nested, as one document."""
    if features is None:
        nested = summary.withColumn("features", F.array().cast("array<struct<feature:string>>"))
    else:
        head = summary.select(F.struct(*summary.columns).alias("head"))
        lines = features.select(F.struct(*features.columns).alias("line"))
        nested = (
            head.unionByName(lines, allowMissingColumns=True)
            .agg(
                F.first("head", ignorenulls=True).alias("head"),
                F.array_sort(F.collect_list("line")).alias("features"),  # one entry per feature
            )
            .select("head.*", "features")
        )
    return nested.withColumn("checked_at", F.lit(utc_now())).withColumn(
        "baseline_path", F.lit(store.baseline)
    )


def drift_metrics(report: DataFrame) -> DataFrame:
    """``metric, value`` rows of a report document, ``psi_<feature>`` included."""
    fixed = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in ("max_psi", "drift_detected", "warning_detected", "current_rows")
        ]
    )
    if "psi" in report.schema["features"].dataType.elementType.names:
        per_feature = F.transform(
            "features",
            lambda f: F.struct(
                F.concat(F.lit("psi_"), f["feature"]).alias("metric"), f["psi"].alias("value")
            ),
        )
        fixed = F.concat(fixed, per_feature)
    return report.select(F.inline(fixed))


def run_drift(
    spark: SparkSession,
    df: DataFrame,
    store: DriftStore,
    cfg: DriftConfig = DriftConfig(),
    *,
    fail_on_high: bool = False,
) -> DataFrame:
    """Check a frame against the stored baseline, or make it the baseline.

    The report document replaces ``latest`` and is added to ``history``.
    """
    if current_baseline(spark, store) is None:
        refresh_baseline(df, store, cfg)
        rows = load_baseline(spark, store).agg(F.max("row_count").alias("rows"))
        summary = rows.select(
            F.lit("baseline_created").alias("status"),
            F.coalesce("rows", F.lit(0)).alias("baseline_rows"),
            F.coalesce("rows", F.lit(0)).alias("current_rows"),
            F.lit(0.0).alias("max_psi"),
            F.lit("stable").alias("severity"),
            F.lit(False).alias("drift_detected"),
            F.lit(False).alias("warning_detected"),
        )
        report = durable(_document(summary, None, store), "drift-report")
    else:
        summary, features = drift_report(load_baseline(spark, store), df, cfg)
        report = durable(_document(summary, features, store), "drift-report")
    overwrite_json(report, store.latest)
    append_json(report, store.history)
    if fail_on_high:
        outcome = report.select("drift_detected", "max_psi").first()
        if outcome.drift_detected:
            raise DriftError(f"strong drift, largest psi {outcome.max_psi}")
    return report


def drift_history(spark: SparkSession, store: DriftStore, n: int = 10) -> DataFrame:
    """The latest ``n`` reports, newest first."""
    return spark.read.json(store.history).orderBy(F.col("checked_at").desc()).limit(n)
