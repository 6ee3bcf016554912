"""Confusion cells and everything that follows from them.

Each function over predictions is one aggregation with a partial step before the
shuffle, so what moves is a few rows per task, however the keys are spread. The
functions over cells only project.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import decode_label, error_kind, is_correct, ratio

CELLS = ("true_positive", "true_negative", "false_positive", "false_negative")


def cell_counts() -> dict[str, Column]:
    """The four cells, and the rows that fall into none, as aggregates over predictions.

    n_null counts rows without label or answer, n_other those with a code other than 0 and 1; the six add up to n_rows.
    """
    label, answer = F.col("label"), F.col("prediction")
    known = label.isin(0, 1) & answer.isin(0, 1)
    return {
        "true_positive": F.count_if((label == 1) & (answer == 1)),
        "true_negative": F.count_if((label == 0) & (answer == 0)),
        "false_positive": F.count_if((label == 0) & (answer == 1)),
        "false_negative": F.count_if((label == 1) & (answer == 0)),
        "n_null": F.count_if(label.isNull() | answer.isNull()),
        "n_other": F.count_if(label.isNotNull() & answer.isNotNull() & ~known),
        "n_rows": F.count(F.lit(1)),
    }


def confusion_cells(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """The confusion matrix of every model in one pass."""
    return predictions.groupBy(*by).agg(*[count.alias(name) for name, count in cell_counts().items()])


def confusion_long(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """One row per actual and predicted class."""
    return predictions.groupBy(
        *by,
        decode_label(F.col("label")).alias("actual_label"),
        decode_label(F.col("prediction")).alias("predicted_label"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _cells() -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(name) for name in CELLS)


def binary_metrics(cells: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Metrics of the FAKE class; a metric without a denominator is 0."""
    tp, tn, fp, fn = _cells()
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return cells.select(
        *by,
        (tp + tn + fp + fn).alias("n"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision_fake"),
        recall.alias("recall_fake"),
        ratio(tn, tn + fp).alias("specificity"),
        ratio(2 * precision * recall, precision + recall).alias("f1_fake"),
        ratio(fp, tn + fp).alias("false_positive_rate"),
        ratio(fn, tp + fn).alias("false_negative_rate"),
    )


def weighted_metrics(cells: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Precision, recall and F1 of both classes, weighted by how many rows carry the label.

    ``by`` names the columns to keep.
    """
    tp, tn, fp, fn = _cells()
    n, n_fake, n_real = tp + tn + fp + fn, tp + fn, tn + fp
    scores = {
        "fake": (ratio(tp, tp + fp), ratio(tp, n_fake)),
        "real": (ratio(tn, tn + fn), ratio(tn, n_real)),
    }

    def weighted(pick) -> Column:
        return ratio(n_fake * pick(*scores["fake"]) + n_real * pick(*scores["real"]), n)

    return cells.select(
        *by,
        ratio(tp + tn, n).alias("accuracy"),
        weighted(lambda p, r: p).alias("precision_weighted"),
        weighted(lambda p, r: r).alias("recall_weighted"),
        weighted(lambda p, r: ratio(2 * p * r, p + r)).alias("f1_weighted"),
    )


def error_summary(cells: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Errors, their share of all rows (also of those in no cell), and how they split."""
    _, _, fp, fn = _cells()
    return cells.select(
        *by,
        "n_rows",
        (fp + fn).alias("n_errors"),
        ratio(fp + fn, F.col("n_rows")).alias("error_rate"),
        "false_positive",
        "false_negative",
    )


def prediction_breakdown(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Right and wrong answers; a row without label or answer counts as wrong.

    ``share_correct_of_all`` divides by all rows, unlike ``accuracy``, which leaves out rows in no cell.
    """
    right = F.count_if(is_correct(F.col("label"), F.col("prediction")))
    total = F.count(F.lit(1))
    return predictions.groupBy(*by).agg(
        total.alias("n_rows"),
        right.alias("n_correct"),
        (total - right).alias("n_wrong"),
        ratio(right, total).alias("share_correct_of_all"),
    )


def error_by_class(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Error rate of the rows that truly belong to each class."""
    wrong = F.count_if(F.col("label") != F.col("prediction"))
    total = F.count(F.lit(1))
    return predictions.groupBy(*by, decode_label(F.col("label")).alias("label_name")).agg(
        total.alias("n_rows"), wrong.alias("n_errors"), ratio(wrong, total).alias("error_rate")
    )


def misclassified(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("label") != F.col("prediction"))


def error_rows(predictions: DataFrame) -> DataFrame:
    """False positives and false negatives in one pass, told apart by error_kind."""
    kind = error_kind(F.col("label"), F.col("prediction"))
    return predictions.withColumn("error_kind", kind).where(F.col("error_kind").isNotNull())
