"""Classifier evaluation as aggregates (no RDD metrics objects, no driver-side loops).

All metrics are in label space: class 1 is fraud, whatever index a label indexer might assign.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.prefix import running_totals


def confusion_counts(df: DataFrame, label_col: str = "label", pred_col: str = "label_pred") -> DataFrame:
    """One row ``tn, fp, fn, tp`` (rows = actual, columns = predicted), one pass."""
    a, p = F.col(label_col), F.col(pred_col)
    return df.agg(
        F.count_if((a == 0) & (p == 0)).alias("tn"), F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"), F.count_if((a == 1) & (p == 1)).alias("tp"))


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "label_pred") -> DataFrame:
    """Long form: (actual, predicted, n) for all four cells, zero cells included."""
    return confusion_counts(df, label_col, pred_col).select(F.expr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, n)"))


def metrics_from_counts(counts: DataFrame, keep_counts: bool = False) -> DataFrame:
    """accuracy, precision, recall, f1 of class 1; NULL where a denominator is zero."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    return counts.select(
        *(["tn", "fp", "fn", "tp"] if keep_counts else []),
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(F.lit(2.0) * precision * recall, precision + recall).alias("f1"),
    )


def classification_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "label_pred") -> DataFrame:
    return metrics_from_counts(confusion_counts(df, label_col, pred_col))


def score_groups(df: DataFrame, score_col: str, label_col: str = "label") -> DataFrame:
    """One row per distinct score: positives and negatives at that score (map-side combined)."""
    lab = F.col(label_col).cast("bigint")
    return df.groupBy(F.col(score_col).alias("score")).agg(
        F.sum(lab).alias("pos"), F.sum(F.lit(1) - lab).alias("neg"))


def roc_points(df: DataFrame, score_col: str = "fraud_probability", label_col: str = "label", **limits) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, highest score first in meaning."""
    g = score_groups(df, score_col, label_col)
    cum = running_totals(g, "score", ["pos", "neg"], descending=True, **limits)
    # the last running sums are the totals
    tp, tn = cum.agg(F.max("cum_pos")).scalar(), cum.agg(F.max("cum_neg")).scalar()
    return cum.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), tn).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), tp).alias("tpr"),
    )


def roc_auc(df: DataFrame, score_col: str = "fraud_probability", label_col: str = "label",
            digits: int = 6, **limits) -> DataFrame:
    """Exact area under the ROC curve; tied scores get half credit."""
    return _auc(score_groups(df, score_col, label_col), digits, **limits)


def _auc(g: DataFrame, digits: int = 6, **limits) -> DataFrame:
    cum = running_totals(g, "score", ["pos"], descending=True, **limits)
    return cum.agg(F.round(F.try_divide(
        F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))),
        F.sum("pos").cast("double") * F.sum("neg").cast("double")), digits).alias("auc"))


def report(scored: DataFrame, score_col: str = "fraud_probability", label_col: str = "label", pred_col: str = "label_pred") -> DataFrame:
    """One row: the confusion matrix, its metrics and the exact AUC of a scored set, which is read once.

    The set is reduced to one row per (score, prediction, label) first; all three follow from that."""
    groups = scored.groupBy(F.col(score_col).alias("score"), F.col(pred_col).alias("p"), F.col(label_col).alias("a")).agg(
        F.count(F.lit(1)).alias("n")).checkpoint()
    cell = lambda a, p: F.coalesce(F.sum(F.when((F.col("a") == a) & (F.col("p") == p), F.col("n"))), F.lit(0))
    counts = groups.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))
    by_score = groups.groupBy("score").agg(
        F.sum(F.col("n") * F.col("a").cast("bigint")).alias("pos"), F.sum(F.col("n") * (1 - F.col("a").cast("bigint"))).alias("neg"))
    return metrics_from_counts(counts, keep_counts=True).withColumn("auc", _auc(by_score).select("auc").scalar())
