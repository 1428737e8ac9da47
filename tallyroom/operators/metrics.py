"""Scores of a binary classifier from a frame of labels and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    """Division where nothing over nothing is 0."""
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n`` for the four pairs, absent pairs with 0."""
    pairs = [(a, b) for a in (0, 1) for b in (0, 1)]
    counts = pred.agg(
        *[
            F.count(F.when((F.col(label) == a) & (F.col(prediction) == b), 1)).alias(f"n{a}{b}")
            for a, b in pairs
        ]
    )
    rows = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"n{a}{b}").alias("n"))
        for a, b in pairs
    ]
    return counts.select(F.inline(F.array(*rows)))


def _counts(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    truth, guess = F.col(label), F.col(prediction)
    return pred.agg(
        F.count(F.when((truth == 1) & (guess == 1), 1)).alias("tp"),
        F.count(F.when((truth == 0) & (guess == 1), 1)).alias("fp"),
        F.count(F.when((truth == 1) & (guess == 0), 1)).alias("fn"),
        F.count(F.when((truth == 0) & (guess == 0), 1)).alias("tn"),
    )


def _cells() -> tuple[Column, Column, Column, Column]:
    return F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")


def classification_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row: accuracy, scores of class 1, of class 0 and macro F1, in one pass."""
    tp, fp, fn, tn = _cells()
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    f1_low = _ratio(2 * tn, 2 * tn + fp + fn)
    return _counts(pred, label, prediction).select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        f1.alias("f1"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tn, tn + fn).alias("precision_unsatisfied"),
        _ratio(tn, tn + fp).alias("recall_unsatisfied"),
        f1_low.alias("f1_unsatisfied"),
        ((f1 + f1_low) / 2).alias("f1_macro"),
    )


def classification_report(
    pred: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``name, precision, recall, f1, support`` per class and averaged."""
    tp, fp, fn, tn = _cells()
    low = (_ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(2 * tn, 2 * tn + fp + fn), tn + fp)
    high = (_ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn), tp + fn)
    rows = low[3] + high[3]
    right = _ratio(tp + tn, rows)

    def line(name: str, values) -> Column:
        parts = [v.cast("double").alias(c) for v, c in zip(values, ("precision", "recall", "f1"))]
        return F.struct(F.lit(name).alias("name"), *parts, values[3].cast("bigint").alias("support"))

    lines = [
        line("0", low),
        line("1", high),
        line("accuracy", (right, right, right, rows)),
        line("macro avg", (*[(a + b) / 2 for a, b in zip(low[:3], high[:3])], rows)),
        line(
            "weighted avg",
            (*[_ratio(a * low[3] + b * high[3], rows) for a, b in zip(low[:3], high[:3])], rows),
        ),
    ]
    return _counts(pred, label, prediction).select(F.inline(F.array(*lines)))


def roc_auc(
    pred: DataFrame, label: str = "label", score: str = "score", key: str | None = None
) -> DataFrame:
    """One row ``roc_auc``: exact area under the ROC curve.

    Rows of equal score are one weighted row: positives and negatives of each
    distinct score are counted first (combined before the shuffle, so ties may
    hold any share of the rows; ``key`` is no longer needed for that). The
    distinct scores are dealt out by range; inside a range a running sum gives
    each positive the negatives below it, and sums per range (one row each) do
    the rest. NULL with a single class; NULL scores come first.
    """
    one = F.col(label).cast("bigint")
    per_score = pred.groupBy(F.col(score).alias("score")).agg(F.sum(one).alias("p"), F.count(F.lit(1)).alias("n"))
    # The number of the partition is fixed by the range it holds, also if a task runs again.
    weighted = per_score.repartitionByRange("score").select(
        "score",
        F.spark_partition_id().alias("stretch"),
        F.coalesce("p", F.lit(0)).alias("p"),
        (F.col("n") - F.coalesce("p", F.lit(0))).alias("m"),
    )
    inside = Window.partitionBy("stretch").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("m").over(inside), F.lit(0))
    # Twice the pairs won, so that ties stay whole numbers.
    stretches = (
        weighted.withColumn("won", F.col("p").cast("decimal(38,0)") * (2 * below + F.col("m")))
        .groupBy("stretch")
        .agg(F.sum("won").alias("won"), F.sum("p").alias("p"), F.sum("m").alias("m"))
    )
    before = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)  # one row per stretch
    totals = stretches.withColumn("below", F.coalesce(F.sum("m").over(before), F.lit(0))).agg(
        F.sum(F.col("won") + F.col("p").cast("decimal(38,0)") * 2 * F.col("below")).cast("double").alias("won"),
        F.sum("p").cast("double").alias("p"),
        F.sum("m").cast("double").alias("m"),
    )
    return totals.select((F.col("won") / F.nullif(2 * F.col("p") * F.col("m"), F.lit(0.0))).alias("roc_auc"))


def summarise_labels(df: DataFrame, label: str = "satisfied") -> DataFrame:
    """One row: rows, positives and their share."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("n_positive"),
        F.avg(F.col(label).cast("double")).alias("positive_share"),
    )
