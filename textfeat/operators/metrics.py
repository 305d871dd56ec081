"""Confusion counts and metrics."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textfeat.functions.scores import ratio


def confusion(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, truePos, falsePos, trueNeg, falseNeg`` from ``label, prediction``, one pass."""
    cells = [("truePos", 1, 1), ("falsePos", 0, 1), ("trueNeg", 0, 0), ("falseNeg", 1, 0)]
    return predictions.groupBy(*keys).agg(
        *[
            F.count_if((F.col("label") == label) & (F.col("prediction") == prediction)).alias(name)
            for name, label, prediction in cells
        ]
    )


def metrics(counts: DataFrame) -> DataFrame:
    """Adds ``accuracy, precision, recall, f1score``.

    Precision, recall and F1 are 0.0 where they divide by zero; accuracy is null for an
    empty set.
    """
    tp, fp, tn, fn = (F.col(c) for c in ("truePos", "falsePos", "trueNeg", "falseNeg"))
    scored = counts.withColumns(
        {
            "accuracy": F.try_divide((tp + tn).cast("double"), tp + fp + tn + fn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1score", ratio(2 * p * r, p + r))
