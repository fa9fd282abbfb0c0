"""Classification quality."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, functions as F


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: the four counts, accuracy in percent and F1 of the positive class, in one pass.

    F1 is 0 when nothing is positive, neither in the labels nor in the predictions.
    """
    y, z = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(y & z).alias("tp"),
        F.count_if(~y & z).alias("fp"),
        F.count_if(y & ~z).alias("fn"),
        F.count_if(~y & ~z).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total, errors = tp + fp + fn + tn, 2 * tp + fp + fn
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        F.when(total > 0, (tp + tn).cast("double") / total * 100).alias("accuracy"),
        F.when(errors > 0, (2 * tp).cast("double") / errors).otherwise(0.0).alias("f1"),
    )


def roc_auc(df: DataFrame, score: str, label: str = "label", bins: int = 0) -> float:
    """Area under the ROC curve; with 0 bins every distinct score is a point, which makes it exact."""
    scored = df.select(F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score"))
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=bins
    )
    return evaluator.evaluate(scored)
