"""Batch scoring of requests with a trained model."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions.exprs import round_half_away
from tallyroom.plans.learning import FEATURE_ORDER, TEXT_FEATURE, TrainConfig, prepare

# Fixed value: what counts as white space at the ends of a comment.
OUTER_WHITE = r"^[\s\p{Z}\x0b\x1c-\x1f\x85]+|[\s\p{Z}\x0b\x1c-\x1f\x85]+$"


def _rules() -> list[tuple[Column, str]]:
    delay = F.col("delivery_delay_days").try_cast("double")
    length = F.col("review_comment_length").try_cast("int")
    flag = F.col("has_comment").try_cast("boolean")
    code = F.col("payment_type_encoded").try_cast("int")
    return [
        (delay.isNull(), "delivery_delay_days missing or not a number"),
        (length.isNull(), "review_comment_length missing or not a number"),
        (length < 0, "review_comment_length below 0"),
        (flag.isNull(), "has_comment missing or not a flag"),
        (code.isNull(), "payment_type_encoded missing or not a number"),
        (~code.between(0, 4), "payment_type_encoded outside 0..4"),
    ]


def judged(df: DataFrame) -> DataFrame:
    """Add ``reasons``, the rules a request breaks (empty when valid).

    A field the frame does not have at all is missing in every request; the
    comment alone may be left out and is then blank.
    """
    for c in FEATURE_ORDER:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    broken = F.array(*[F.when(rule, F.lit(reason)) for rule, reason in _rules()])
    return df.withColumn("reasons", F.array_compact(broken))


def validate_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split requests into typed valid ones and rejected ones with ``reason``."""
    checked = judged(df)
    valid = (
        checked.where(F.size("reasons") == 0)
        .withColumns(
            {
                TEXT_FEATURE: F.coalesce(TEXT_FEATURE, F.lit("")),
                "delivery_delay_days": F.col("delivery_delay_days").cast("double"),
                "review_comment_length": F.col("review_comment_length").cast("int"),
                "has_comment": F.col("has_comment").cast("boolean"),
                "payment_type_encoded": F.col("payment_type_encoded").cast("int"),
            }
        )
        .drop("reasons")
    )
    rejected = checked.where(F.size("reasons") > 0).withColumn(
        "reason", F.concat_ws("; ", "reasons")
    ).drop("reasons")
    return valid, rejected


def derive_features(df: DataFrame) -> DataFrame:
    """Features from the trimmed comment; the request's own length and flag
    are kept as ``received_*`` and not used."""
    text = F.regexp_replace(F.coalesce(TEXT_FEATURE, F.lit("")), OUTER_WHITE, "")
    return df.withColumns(
        {
            "received_length": F.col("review_comment_length"),
            "received_has_comment": F.col("has_comment"),
            TEXT_FEATURE: text,
            "review_comment_length": F.length(text),
            "has_comment": (F.length(text) > 0).cast("int"),
        }
    )


def score(model: PipelineModel | Transformer | None, df: DataFrame, cfg: TrainConfig = TrainConfig()) -> DataFrame:
    """Add ``satisfied`` and ``probability`` (4 digits) to derived requests.

    A model without probabilities gives its class as probability. No model is
    an error before any data is read.
    """
    if model is None:
        raise LookupError("no model is loaded")
    kept = [c for c in df.columns if c not in FEATURE_ORDER]
    scored = model.transform(prepare(df.select(*kept, *FEATURE_ORDER), cfg))
    if "probability" in scored.columns:
        chance = vector_to_array("probability")[1]
    else:
        chance = F.col("prediction").cast("double")
    return scored.select(
        *df.columns,
        (F.col("prediction") == 1).alias("satisfied"),
        round_half_away(chance, 4).alias("probability"),
    )


def audit(scored: DataFrame, at: str) -> DataFrame:
    """What is kept of each prediction: time, inputs as received, outcome."""
    return scored.select(
        F.lit(at).alias("at"),
        "delivery_delay_days",
        F.col("received_length").alias("review_comment_length"),
        F.col("received_has_comment").alias("has_comment"),
        "payment_type_encoded",
        "satisfied",
        "probability",
    )


def summarise(scored: DataFrame) -> DataFrame:
    """Add the shown columns: label, clamped probabilities, confidence, preview."""
    chance = F.least(F.greatest("probability", F.lit(0.0)), F.lit(1.0))
    text = F.coalesce(TEXT_FEATURE, F.lit(""))
    return scored.withColumns(
        {
            "label": F.when(F.col("satisfied"), "satisfied").otherwise("unsatisfied"),
            "satisfied_share": chance,
            "unsatisfied_share": 1 - chance,
            "confidence": F.when(F.col("satisfied"), chance).otherwise(1 - chance),
            "comment_preview": F.when(text != "", F.left(text, F.lit(50))).otherwise("no comment"),
        }
    )


def score_requests(
    model: PipelineModel | Transformer | None, requests: DataFrame, cfg: TrainConfig = TrainConfig()
) -> tuple[DataFrame, DataFrame]:
    """Validate, derive and score: (scored, rejected)."""
    if model is None:
        raise LookupError("no model is loaded")
    valid, rejected = validate_requests(requests)
    return score(model, derive_features(valid), cfg), rejected
