import pytest
from fixtures import predictions
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from pixelproof.operators import confusion

# published matrix: cells and the figures printed beside it
TN, FP, FN, TP = 8940, 1060, 1142, 8858


@pytest.fixture(scope="module")
def published(spark):
    groups = [(0, 0.0, TN), (0, 1.0, FP), (1, 0.0, FN), (1, 1.0, TP)]
    counts = spark.createDataFrame(groups, "label int, prediction double, n int")
    rows = counts.select("label", "prediction", F.explode(F.sequence(F.lit(1), "n")))
    return rows.select(F.lit("LogisticRegression").alias("model"), "label", "prediction")


def test_published_figures(published):
    cells = confusion.confusion_cells(published)
    row = confusion.binary_metrics(cells).first()
    assert round(row["accuracy"], 4) == 0.8899
    assert round(row["false_positive_rate"], 3) == 0.106
    assert round(row["false_negative_rate"], 4) == 0.1142
    assert round(row["precision_fake"], 4) == 0.8931
    assert round(row["recall_fake"], 4) == 0.8858
    weighted = confusion.weighted_metrics(cells).first()
    for name in ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted"):
        assert round(weighted[name], 4) == 0.8899


def test_closed_form_equals_evaluators(published):
    row = confusion.weighted_metrics(confusion.confusion_cells(published)).first()
    for metric, column in (
        ("accuracy", "accuracy"),
        ("weightedPrecision", "precision_weighted"),
        ("weightedRecall", "recall_weighted"),
        ("f1", "f1_weighted"),
    ):
        evaluator = MulticlassClassificationEvaluator(metricName=metric, labelCol="label")
        assert evaluator.evaluate(published) == pytest.approx(row[column], abs=1e-12)


def test_nothing_predicted_fake(spark):
    rows = [("m", str(i), i % 2, 0.0, 0.1) for i in range(4)]
    row = confusion.binary_metrics(confusion.confusion_cells(predictions(spark, rows))).first()
    assert (row["precision_fake"], row["recall_fake"], row["f1_fake"]) == (0.0, 0.0, 0.0)
    assert row["specificity"] == 1.0


def test_one_class_only(spark):
    rows = [("m", str(i), 1, 1.0, 0.9) for i in range(3)]
    row = confusion.binary_metrics(confusion.confusion_cells(predictions(spark, rows))).first()
    assert row["accuracy"] == 1.0
    assert row["specificity"] == 0.0 and row["false_positive_rate"] == 0.0


def test_missing_labels_and_answers_are_counted(spark):
    rows = [("m", "a", None, 1.0, 0.9), ("m", "b", 1, None, None), ("m", "c", 1, 1.0, 0.9)]
    data = predictions(spark, rows)
    cells = confusion.confusion_cells(data).first()
    assert (cells["true_positive"], cells["n_null"], cells["n_other"], cells["n_rows"]) == (1, 2, 0, 3)
    assert confusion.misclassified(data).count() == 0
    row = confusion.prediction_breakdown(data).first()
    assert (row["n_correct"], row["n_wrong"]) == (1, 2)


def test_no_rows(spark):
    empty = predictions(spark, [])
    assert confusion.confusion_cells(empty).count() == 0
    row = confusion.binary_metrics(confusion.confusion_cells(empty, by=()), by=()).first()
    assert row["n"] == 0 and row["accuracy"] == 0.0


def test_error_rows_tell_the_kind(spark):
    rows = [("m", "a", 0, 1.0, 0.9), ("m", "b", 1, 0.0, 0.1), ("m", "c", 1, 1.0, 0.9)]
    kinds = {r["path"]: r["error_kind"] for r in confusion.error_rows(predictions(spark, rows)).collect()}
    assert kinds == {"a": "false_positive", "b": "false_negative"}
