"""Satisfaction classifier: training, registry, promotion."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.operators import learning as L
from tallyroom.operators.drift import DriftConfig, DriftStore, write_profile
from tallyroom.operators.metrics import classification_metrics, classification_report, roc_auc
from tallyroom.sources.durable import durable, intermediate_path, owned
from tallyroom.sources.events import EVENT_SCHEMA as EVENT_SCHEMA
from tallyroom.sources.events import append_events, read_events, read_table
from tallyroom.sources.readers import utc_now

# The model's columns, in order.
TEXT_FEATURE = "review_comment_message"
NUMERIC_FEATURES = (
    "delivery_delay_days",
    "review_comment_length",
    "has_comment",
    "payment_type_encoded",
)
FEATURE_ORDER = (TEXT_FEATURE, *NUMERIC_FEATURES)
TARGET = "satisfied"


@dataclass(frozen=True)
class GateConfig:
    min_accuracy: float = 0.85
    min_recall_unsatisfied: float = 0.50
    min_f1_unsatisfied: float = 0.63
    f1_tolerance: float = 0.002
    recall_tolerance: float = 0.01


@dataclass(frozen=True)
class TrainConfig:
    key: str = "review_id"
    model_name: str = "satisfaction"
    use_text: bool = True  # False: the numeric model with balanced class weights
    min_rows: int = 50_000
    max_features: int = 500
    min_df: int = 5
    ngrams: tuple[int, int] = (1, 2)
    c: float = 1.0
    max_iter: int = 1000
    test_share: float = 0.2
    seed: int = 42
    auto_promote: bool = True
    gate: GateConfig = field(default_factory=GateConfig)


def training_frame(features: DataFrame, key: str = "review_id") -> DataFrame:
    """Key, features and target; blank text instead of NULL, flags as numbers."""
    return features.select(
        key,
        F.coalesce(TEXT_FEATURE, F.lit("")).alias(TEXT_FEATURE),
        F.col("delivery_delay_days").cast("double").alias("delivery_delay_days"),
        F.col("review_comment_length").cast("int").alias("review_comment_length"),
        F.coalesce(F.col("has_comment").cast("int"), F.lit(0)).alias("has_comment"),
        F.col("payment_type_encoded").cast("int").alias("payment_type_encoded"),
        F.col(TARGET).cast("int").alias(TARGET),
    )


def fit_logistic(
    df: DataFrame,
    *,
    balanced: bool,
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-6,
    features: str = "features",
    label: str = TARGET,
):
    """L2 logistic regression with inverse strength ``c`` over the summed loss.

    ``balanced`` weighs each class by n / (2 * n_class). The intercept is not
    penalised. Features should be on one scale already.
    """
    classes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(classes.values())
    estimator = LogisticRegression(
        featuresCol=features,
        labelCol=label,
        regParam=1.0 / (c * n),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    )
    if balanced:
        weight = F.lit(0.0)
        for value, size in classes.items():
            weight = F.when(F.col(label) == value, n / (2.0 * size)).otherwise(weight)
        df = df.withColumn("_weight", weight)
        estimator = estimator.setWeightCol("_weight")
    # Written and read back: a model that was just fitted carries its training
    # summary, and with it the session, into every task that scores with it.
    path = intermediate_path(df.sparkSession, "fitted")
    estimator.fit(df).write().save(path)
    return LogisticRegressionModel.load(path)


def optimality(
    pred: DataFrame, coefficients: dict[str, float], *, c: float = 1.0, weight: Column | None = None, label: str = TARGET, probability: str = "p"
) -> DataFrame:
    """``feature, observed, fitted``: both sides of the optimum's condition, in one aggregate.

    At the optimum of the penalised loss the weighted mean of feature times
    label equals that of feature times probability plus the coefficient's
    share of the penalty. The loss is convex, so where all features (and the
    unpenalised ``intercept``) agree, the fit is the one there is.
    """
    w = F.lit(1.0) if weight is None else weight
    sides = {"intercept": (F.lit(1.0), 0.0)} | {f: (F.col(f), b) for f, b in coefficients.items()}
    totals = pred.agg(
        F.sum(w).alias("n"),
        *[F.sum(w * x * F.col(label)).alias(f"y{i}") for i, (x, _) in enumerate(sides.values())],
        *[F.sum(w * x * F.col(probability)).alias(f"p{i}") for i, (x, _) in enumerate(sides.values())],
    )
    n = F.col("n")
    rows = [
        F.struct(F.lit(f).alias("feature"), (F.col(f"y{i}") / n).alias("observed"), ((F.col(f"p{i}") + F.lit(b / c)) / n).alias("fitted"))
        for i, (f, (_, b)) in enumerate(sides.items())
    ]
    return totals.select(F.inline(F.array(*rows)))


def prepare(df: DataFrame, cfg: TrainConfig = TrainConfig()) -> DataFrame:
    """What a saved model expects: the features plus, with text, their terms."""
    if not cfg.use_text:
        return df
    return L.with_terms(df, TEXT_FEATURE, "terms", cfg.ngrams)


def fit_model(train: DataFrame, cfg: TrainConfig = TrainConfig()) -> PipelineModel:
    """Fit on a prepared training frame. The result is a plain PipelineModel.

    With text: TF-IDF terms plus numbers scaled by deviation. Without text:
    centred numbers and balanced class weights.
    """
    scaled = L.fit_scale(train, NUMERIC_FEATURES, center=not cfg.use_text)
    stages: list = [scaled.stage(NUMERIC_FEATURES)]
    inputs = [f"x_{c}" for c in NUMERIC_FEATURES]
    if cfg.use_text:
        weights = L.fit_tfidf(train, "terms", cfg.max_features, cfg.min_df)
        if weights.terms:
            stages += weights.stages()
            inputs = ["tfidf", *inputs]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    assembled = PipelineModel(stages).transform(train).select("features", TARGET)
    # Every iteration reads this frame: the terms must not be made again, and
    # partitions of one size (few, if it is small) keep the tasks even.
    fitted = fit_logistic(
        durable(assembled.hint("rebalance"), "train"),
        balanced=not cfg.use_text,
        c=cfg.c,
        max_iter=cfg.max_iter,
    )
    return PipelineModel([*stages, fitted])


def evaluate(model: PipelineModel, test: DataFrame, key: str) -> DataFrame:
    """``key, label, prediction, score`` of a prepared test frame."""
    return model.transform(test).select(
        key,
        F.col(TARGET).alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def promotion_gate(
    candidates: DataFrame, champions: DataFrame | None, cfg: GateConfig = GateConfig(), on: str = "model"
) -> DataFrame:
    """Add ``promote`` and ``reason`` to candidates with their metrics.

    Candidates and champions carry accuracy, f1, recall_unsatisfied and
    f1_unsatisfied and meet on the model name; a model without a champion only
    has to pass the fixed thresholds.
    """
    if champions is None:
        joined = candidates.withColumns(
            {
                "old_f1": F.lit(None).cast("double"),
                "old_recall": F.lit(None).cast("double"),
                "has_champion": F.lit(False),
            }
        )
    else:
        old = champions.select(
            on,
            F.coalesce("f1", F.lit(0.0)).alias("old_f1"),
            F.coalesce("recall_unsatisfied", F.lit(0.0)).alias("old_recall"),
            F.lit(True).alias("has_champion"),
        )
        joined = candidates.join(old, on, "left")
    keeps_up = (F.col("f1") >= F.col("old_f1") - cfg.f1_tolerance) & (
        F.col("recall_unsatisfied") >= F.col("old_recall") - cfg.recall_tolerance
    )
    reason = (
        F.when(F.col("accuracy") < cfg.min_accuracy, "accuracy too low")
        .when(F.col("recall_unsatisfied") < cfg.min_recall_unsatisfied, "recall of class 0 too low")
        .when(F.col("f1_unsatisfied") < cfg.min_f1_unsatisfied, "f1 of class 0 too low")
        .when(F.col("has_champion").isNull() | ~F.col("has_champion"), "no champion yet")
        .when(keeps_up, "as good as the champion or better")
        .otherwise("worse than the champion")
    )
    accepted = reason.isin("no champion yet", "as good as the champion or better")
    return joined.withColumn("promote", accepted).withColumn("reason", reason).drop(
        "old_f1", "old_recall", "has_champion"
    )


@dataclass(frozen=True)
class ModelStore:
    """Runs, registry events and saved models below one root.

    The registry is a list of events that only grows; the current stage of a
    version and the champion follow from the newest events.
    """

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def model_path(self, model: str, version: int) -> str:
        return self.path("models", model, f"v{version}")


RUN_SCHEMA = (
    "run_id string, at string, params map<string,string>, metrics map<string,double>, "
    "tags map<string,string>, report string"
)


def registry_events(spark: SparkSession, store: ModelStore) -> DataFrame:
    return read_events(spark, store.path("registry"))


def runs(spark: SparkSession, store: ModelStore) -> DataFrame:
    return read_table(spark, store.path("runs"), RUN_SCHEMA)


def current_stages(events: DataFrame) -> DataFrame:
    """``model, version, run_id, fingerprint, stage`` per registered version."""
    is_stage = F.col("kind") == "stage"
    newest = F.max_by(F.when(is_stage, F.col("value")), F.when(is_stage, F.struct("at", "value")))
    return events.groupBy("model", "version").agg(
        F.max("run_id").alias("run_id"),
        F.max("fingerprint").alias("fingerprint"),
        newest.alias("stage"),
    )


def champions(events: DataFrame) -> DataFrame:
    """The champion of every model, as a row of ``current_stages``.

    That is the version under the newest champion alias, else the highest one
    in Production; a model with neither has no row.
    """
    stages = current_stages(events)
    alias = events.where((F.col("kind") == "alias") & (F.col("value") == "champion"))
    named = alias.groupBy("model").agg(F.max_by("version", F.struct("at", "version")).alias("version"), F.lit(1).alias("rank"))
    staged = stages.where(F.col("stage") == "Production").groupBy("model").agg(F.max("version").alias("version"), F.lit(2).alias("rank"))
    picked = named.unionByName(staged).groupBy("model").agg(F.min_by("version", "rank").alias("version"))
    return stages.join(picked, ["model", "version"])


def champion(events: DataFrame, model: str) -> DataFrame:
    """The champion of one model; no row when there is none."""
    return champions(events.where(F.col("model") == model))


def _log_events(spark: SparkSession, store: ModelStore, rows: Sequence[tuple]) -> None:
    append_events(spark, store.path("registry"), rows)


def register(
    spark: SparkSession,
    store: ModelStore,
    model: PipelineModel,
    cfg: TrainConfig,
    run_id: str,
    fingerprint: str,
) -> int:
    """Save a fitted model as the next version and note it in the registry."""
    last = registry_events(spark, store).where(F.col("model") == cfg.model_name).agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    model.write().overwrite().save(store.model_path(cfg.model_name, version))
    _log_events(
        spark, store, [(cfg.model_name, version, "registered", "", utc_now(), run_id, fingerprint)]
    )
    return version


def promote(
    spark: SparkSession, store: ModelStore, model: str, version: int, more: Sequence[tuple[str, str]] = ()
) -> None:
    """Make a version Production and champion; archive what was Production.

    ``more``: further ``(kind, value)`` events of the same change.
    """
    staged = current_stages(registry_events(spark, store).where(F.col("model") == model))
    previous = [r.version for r in staged.where(F.col("stage") == "Production").collect()]
    at = utc_now()
    rows = [(model, v, "stage", "Archived", at, None, None) for v in previous if v != version]
    rows.append((model, version, "stage", "Production", at, None, None))
    rows.append((model, version, "alias", "champion", at, None, None))
    rows += [(model, version, kind, value, at, None, None) for kind, value in more]
    _log_events(spark, store, rows)


def load_champion(spark: SparkSession, store: ModelStore, model: str) -> tuple[PipelineModel, int]:
    """The champion's model and version; an error before any data is read."""
    row = champion(registry_events(spark, store), model).first()
    if row is None:
        raise LookupError(f"no model is registered as champion of {model}")
    return PipelineModel.load(store.model_path(model, row.version)), row.version


def _params(cfg: TrainConfig, train_rows: int, test_rows: int) -> dict[str, str]:
    shared = {
        "model_type": "tfidf + logistic regression" if cfg.use_text else "logistic regression",
        "numeric_features": ",".join(NUMERIC_FEATURES),
        "logistic_c": str(cfg.c),
        "class_weight": "none" if cfg.use_text else "balanced",
        "test_share": str(cfg.test_share),
        "seed": str(cfg.seed),
        "training_rows": str(train_rows),
        "test_rows": str(test_rows),
    }
    if cfg.use_text:
        shared |= {
            "text_feature": TEXT_FEATURE,
            "tfidf_max_features": str(cfg.max_features),
            "tfidf_ngrams": f"{cfg.ngrams[0]},{cfg.ngrams[1]}",
            "tfidf_min_df": str(cfg.min_df),
        }
    return shared


def drift_store(store: ModelStore, cfg: TrainConfig, root: str) -> DriftStore:
    """A drift store whose baseline is named in the model's registry, so that a promotion moves both at once."""
    return DriftStore(root, store.path("registry"), cfg.model_name)


def train_and_register(
    spark: SparkSession,
    features: DataFrame,
    store: ModelStore,
    cfg: TrainConfig = TrainConfig(),
    *,
    drift_root: str | None = None,
    drift: DriftConfig = DriftConfig(),
) -> dict:
    """Train, evaluate, register and, if the gate allows, promote.

    Skips when the data is what the champion was trained on. With a
    ``drift_root`` the profile of the features becomes the drift baseline in
    the same change as the promotion (see :func:`drift_store`). ``features`` is
    read several times: pass a written table. Intermediate tables are removed.
    """
    with owned(spark):
        return _train_and_register(spark, features, store, cfg, drift_root, drift)


def _train_and_register(
    spark: SparkSession, features: DataFrame, store: ModelStore, cfg: TrainConfig, drift_root: str | None, drift: DriftConfig
) -> dict:
    data = training_frame(features, cfg.key)
    n_rows = L.guard(data, TARGET, cfg.min_rows)
    print_of_data = L.fingerprint(data, [cfg.key, *FEATURE_ORDER, TARGET]).first().fingerprint
    events = registry_events(spark, store)
    best = champion(events, cfg.model_name).first()
    old_run = (
        runs(spark, store).where(F.col("run_id") == best.run_id).first() if best is not None else None
    )
    old_metrics = dict(old_run.metrics) if old_run is not None else {}
    if best is not None and best.fingerprint == print_of_data:
        return {
            "status": "skipped",
            "reason": "same data as the champion",
            "rows": n_rows,
            "fingerprint": print_of_data,
            "promoted": False,
            "version": best.version,
            "metrics": old_metrics,
        }

    split = durable(
        prepare(L.stratified_split(data, cfg.key, TARGET, cfg.test_share, cfg.seed), cfg), "split"
    )
    train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    started = time.perf_counter()
    model = fit_model(train, cfg)
    seconds = time.perf_counter() - started

    pred = durable(evaluate(model, test, cfg.key), "predictions")
    scores = classification_metrics(pred)
    metrics = scores.first().asDict()
    metrics["roc_auc"] = roc_auc(pred, key=cfg.key).first().roc_auc
    metrics["training_seconds"] = seconds
    if not cfg.use_text:  # the numeric model keeps its scores to four digits
        metrics = {k: round(v, 4) if v is not None else None for k, v in metrics.items()}
    report = "\n".join(
        f"{r['name']:<12} {r.precision:.4f} {r.recall:.4f} {r.f1:.4f} {r.support}"
        for r in classification_report(pred).collect()
    )

    run_id = uuid.uuid4().hex
    sizes = {r.is_test: r["n"] for r in split.groupBy("is_test").agg(F.count(F.lit(1)).alias("n")).collect()}
    params = _params(cfg, sizes.get(False, 0), sizes.get(True, 0))
    tags = {"training_data_fingerprint": print_of_data, "generation": "text" if cfg.use_text else "numeric"}
    spark.createDataFrame([(run_id, utc_now(), params, metrics, tags, report)], RUN_SCHEMA).coalesce(
        1
    ).write.mode("append").parquet(store.path("runs"))
    version = register(spark, store, model, cfg, run_id, print_of_data)

    candidate = spark.createDataFrame(
        [(cfg.model_name, metrics["accuracy"], metrics["f1"], metrics["recall_unsatisfied"], metrics["f1_unsatisfied"])],
        "model string, accuracy double, f1 double, recall_unsatisfied double, f1_unsatisfied double",
    )
    rival = None
    if old_metrics:
        rival = spark.createDataFrame(
            [(cfg.model_name, old_metrics.get("f1", 0.0), old_metrics.get("recall_unsatisfied", 0.0))],
            "model string, f1 double, recall_unsatisfied double",
        )
    decision = promotion_gate(candidate, rival, cfg.gate).first()
    promoted = cfg.auto_promote and decision.promote
    if promoted:
        # Written before the event that makes it count.
        more = [] if drift_root is None else [("baseline", write_profile(features, drift_store(store, cfg, drift_root), drift))]
        promote(spark, store, cfg.model_name, version, more)
    return {
        "status": "trained",
        "run_id": run_id,
        "version": version,
        "rows": n_rows,
        "fingerprint": print_of_data,
        "metrics": {k: round(v, 4) for k, v in metrics.items() if v is not None},
        "promoted": promoted,
        "promotion_reason": decision.reason,
    }
