"""Evaluation of binary predictions as DataFrames.

Inputs hold `target` (0/1) and `score` or `prediction`. `by` evaluates many models or actions in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ratio
from .cumulative import running_totals


def confusion_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(tp, fp, tn, fn) from one aggregate; empty quadrants are 0."""

    def quadrant(target: int, prediction: int) -> Column:
        return F.count_if((F.col("target") == target) & (F.col("prediction") == prediction))

    return df.groupBy(*by).agg(
        quadrant(1, 1).alias("tp"), quadrant(0, 1).alias("fp"), quadrant(0, 0).alias("tn"), quadrant(1, 0).alias("fn")
    )


def confusion_quadrant(df: DataFrame, target: int, prediction: int) -> DataFrame:
    """One quadrant as a one-row frame."""
    return df.agg(F.count_if((F.col("target") == target) & (F.col("prediction") == prediction)).alias("n"))


def model_performance(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts with recall, precision, accuracy and F1; a rate without cases is NULL."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return confusion_matrix(df, by).withColumns(
        {
            "recall": ratio(tp, tp + fn),
            "precision": ratio(tp, tp + fp),
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def score_points(df: DataFrame, by: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    """Positives and negatives per distinct score; `bins` rounds scores down to a grid."""
    score = F.col("score") if bins is None else F.floor(F.col("score") * bins) / F.lit(float(bins))
    return df.groupBy(*by, score.alias("score")).agg(
        F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") == 0).alias("neg")
    )


def _running(df: DataFrame, by: Sequence[str], bins: int | None) -> DataFrame:
    return running_totals(score_points(df, by, bins), ["pos", "neg"], by)


def _rate(num: Column, den: Column) -> Column:
    """0 where the class does not occur."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def threshold_curves(df: DataFrame, by: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    """Precision, recall and F1 when predicting 1 from each distinct score upwards.

    Every distinct score is a point; `bins` bounds their number where a plot needs no more.
    """
    tp, fp, positives = F.col("pos_to"), F.col("neg_to"), F.col("pos_all")
    return _running(df, by, bins).select(
        *by,
        F.col("score").alias("threshold"),
        ratio(tp, tp + fp).alias("precision"),
        _rate(tp, positives).alias("recall"),
        _rate(2 * tp, tp + fp + positives).alias("f1"),
    )


def f1_by_threshold(df: DataFrame, by: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    return threshold_curves(df, by, bins).select(*by, "threshold", "f1")


def recall_by_threshold(df: DataFrame, by: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    return threshold_curves(df, by, bins).select(*by, "threshold", "recall")


def precision_by_threshold(df: DataFrame, by: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    return threshold_curves(df, by, bins).select(*by, "threshold", "precision")


def roc_curve(df: DataFrame, by: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, plus the end points (0, 0) and (1, 1) with a NULL threshold."""
    points = _running(df, by, bins).select(
        *by,
        F.col("score").alias("threshold"),
        _rate(F.col("neg_to"), F.col("neg_all")).alias("fpr"),
        _rate(F.col("pos_to"), F.col("pos_all")).alias("tpr"),
    )
    ends = F.array(
        *[F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(v).alias("fpr"), F.lit(v).alias("tpr")) for v in (0.0, 1.0)]
    )
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    return points.unionByName(groups.select(*by, F.inline(ends)))


def auc_roc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve as the normalised rank sum with mid-ranks for tied scores; NULL with one class only."""
    below = F.col("neg_all") - F.col("neg_to")
    wins = F.col("pos").cast("double") * (below + F.col("neg") / 2)
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    return _running(df, by, None).groupBy(*by).agg(F.try_divide(F.sum(wins), pairs).alias("auc"))
