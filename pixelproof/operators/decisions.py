"""Tables that answer a question: which model, good enough, and the report's numbers.

Inputs are metric tables of one row per model, so every step here is tiny.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import percent_text
from ..schemas import LOGISTIC_REGRESSION, MODELS, RANDOM_FOREST

METRIC_COLUMNS = ("accuracy", "precision", "recall", "f1_score", "auc_roc", "train_time_seconds")
SUFFICIENT_ACCURACY = 0.7

# Display names of models and metrics, and the two conclusions.
MODEL_TITLES = {LOGISTIC_REGRESSION: "Logistic Regression", RANDOM_FOREST: "Random Forest"}
METRIC_TITLES = {
    "accuracy": "Accuracy",
    "precision": "Precision",
    "recall": "Recall",
    "f1_score": "F1-Score",
    "auc_roc": "AUC-ROC",
}
SUFFICIENT_TEXT = "{extractor} features are SUFFICIENT for Deepfake detection"
INSUFFICIENT_TEXT = "Features need improvement"


def titled(name: Column, titles: dict[str, str]) -> Column:
    first, *rest = titles.items()
    choice = reduce(lambda c, item: c.when(name == item[0], item[1]), rest, F.when(name == first[0], first[1]))
    return choice.otherwise(name)


def metric_lookup(metrics: DataFrame, model: str) -> DataFrame:
    """The row of one model; no row when it was not trained."""
    return metrics.where(F.col("model") == model)


def best_metric(metrics: DataFrame, metric: str) -> DataFrame:
    return metrics.agg(F.max(metric).alias(f"best_{metric}"))


def best_row(priority: Sequence[str] = MODELS) -> Column:
    """Name and accuracy of the most accurate model, as an aggregate; the one place that names a winner.

    On a tie it is the one earlier in ``priority``, then one that is not in it, by name.
    """
    place = F.array_position(F.array(*map(F.lit, priority)), F.col("model"))
    behind = -F.coalesce(F.col("accuracy"), F.lit(float("-inf")))
    order = F.struct(behind, F.when(place > 0, place).otherwise(len(priority) + 1), F.col("model"))
    return F.min_by(F.struct("model", "accuracy"), order)


def champion(metrics: DataFrame, priority: Sequence[str] = MODELS) -> DataFrame:
    """The most accurate model; no row without any model."""
    best = metrics.agg(best_row(priority).alias("best")).where(F.col("best").isNotNull())
    return best.select(F.col("best.model").alias("best_model"), F.col("best.accuracy").alias("best_accuracy"))


def model_comparison(
    metrics: DataFrame, models: Sequence[str] = MODELS, columns: Sequence[str] = METRIC_COLUMNS
) -> DataFrame:
    """One row per metric, one column per model.

    The model list is given, so no job looks it up; a model that is not in it fails the job instead of being left out.
    """
    unknown = F.raise_error(F.concat(F.lit("no column for model "), F.coalesce("model", F.lit("null"))))
    known = metrics.withColumn("model", F.when(F.col("model").isin(*models), F.col("model")).otherwise(unknown))
    long = known.unpivot("model", list(columns), "metric", "value")
    return long.groupBy("metric").pivot("model", list(models)).agg(F.first("value"))


def is_sufficient(accuracy: Column, threshold: float = SUFFICIENT_ACCURACY) -> Column:
    return accuracy > threshold


def verdict(metrics: DataFrame, threshold: float = SUFFICIENT_ACCURACY) -> DataFrame:
    """Whether the best accuracy lies above the threshold."""
    best = F.max("accuracy")
    return metrics.agg(best.alias("best_accuracy"), is_sufficient(best, threshold).alias("sufficient"))


def _of_model(model: str, metric: str) -> Column:
    return F.max(F.when(F.col("model") == model, F.col(metric)))


def _facts(source: DataFrame, facts: dict[str, Column], key: str, value: str) -> DataFrame:
    """One aggregation, then one row per named fact."""
    names = list(facts)
    wide = source.agg(*[facts[n].alias(f"f{i}") for i, n in enumerate(names)])
    pairs = F.array(
        *[F.struct(F.lit(n).alias(key), F.col(f"f{i}").cast("string").alias(value)) for i, n in enumerate(names)]
    )
    return wide.select(F.inline(pairs))


def insight_facts(
    metrics: DataFrame,
    images: DataFrame,
    dataset: str,
    extractor: str,
    width: int,
    threshold: float = SUFFICIENT_ACCURACY,
) -> DataFrame:
    """The fourteen facts of the summary, as text; the image count is counted."""
    # The names of the facts.
    best_accuracy, best_f1 = best_row()["accuracy"], F.max("f1_score")
    from_metrics = {
        "Dataset": F.lit(dataset),
        "Feature Extractor": F.lit(extractor),
        "Feature Dimension": F.lit(str(width)),
        "Best Model": titled(best_row()["model"], MODEL_TITLES),
        "Best Accuracy": percent_text(best_accuracy, 100),
        "Best F1 Score": percent_text(best_f1, 100),
    }
    for short, model in (("LR", LOGISTIC_REGRESSION), ("RF", RANDOM_FOREST)):
        for metric in ("accuracy", "precision", "recall"):
            from_metrics[f"{short} {METRIC_TITLES[metric]}"] = percent_text(_of_model(model, metric), 100)
    from_metrics["Conclusion"] = F.when(
        is_sufficient(best_accuracy, threshold), SUFFICIENT_TEXT.format(extractor=extractor.split(" ")[0])
    ).otherwise(INSUFFICIENT_TEXT)
    counted = _facts(images, {"Total Images": F.count(F.lit(1))}, "metric", "value")
    return _facts(metrics, from_metrics, "metric", "value").unionByName(counted)


def report_facts(metrics: DataFrame, report_path: str, generated: str | None = None) -> DataFrame:
    """Path, best model, its accuracy and, when passed in, the time of the report."""
    facts = {
        "report_path": F.lit(report_path),
        "best_model": best_row()["model"],
        "best_accuracy": percent_text(best_row()["accuracy"], 100),
    }
    if generated is not None:
        facts["report_generated"] = F.lit(generated)
    return _facts(metrics, facts, "key", "value")


def report_series(metrics: DataFrame, cells: DataFrame, distribution: DataFrame, width: int) -> DataFrame:
    """All numbers the report draws, long: section, series, x, y."""

    def points(source: DataFrame, rows: list[tuple]) -> DataFrame:
        as_structs = [
            F.struct(
                F.lit(section).alias("section"),
                series.alias("series"),
                x.alias("x"),
                y.cast("double").alias("y"),
            )
            for section, series, x, y in rows
        ]
        return source.select(F.inline(F.array(*as_structs)))

    title = titled(F.col("model"), MODEL_TITLES)
    per_model = [("accuracy", F.lit("Accuracy (%)"), title, F.col("accuracy") * 100)]
    per_model += [("metrics", title, F.lit(t), F.col(m) * 100) for m, t in METRIC_TITLES.items()]
    per_model += [("training", F.lit("Training Time"), title, F.col("train_time_seconds"))]
    overall = metrics.agg(F.max("accuracy").alias("accuracy"), F.count(F.lit(1)).alias("models"))
    summary = [
        ("summary", F.lit("cards"), F.lit("Best Accuracy"), F.col("accuracy") * 100),
        ("summary", F.lit("cards"), F.lit("Models Trained"), F.col("models")),
        ("summary", F.lit("cards"), F.lit("Features"), F.lit(width)),
    ]
    matrix = [
        ("confusion", title, F.lit(short), F.col(cell))
        for short, cell in (
            ("TN", "true_negative"),
            ("FP", "false_positive"),
            ("FN", "false_negative"),
            ("TP", "true_positive"),
        )
    ]
    split = titled(F.col("split"), {"train": "Training", "test": "Test"})
    part = F.concat_ws(" ", split, F.coalesce("label_name", F.lit("without label")))
    slices = [
        ("dataset", F.lit("images"), part, F.col("n")),
        ("dataset", F.lit("share of split (%)"), part, F.col("share") * 100),
    ]
    totals = distribution.agg(F.sum("n").alias("n"))
    return reduce(
        DataFrame.unionByName,
        [
            points(metrics, per_model),
            points(overall, summary),
            points(cells, matrix),
            points(distribution, slices),
            points(totals, [("summary", F.lit("cards"), F.lit("Total Images"), F.col("n"))]),
        ],
    )


def table_sizes(spark: SparkSession, tables: dict[str, str | tuple[str, str]]) -> DataFrame:
    """Rows of each expected Parquet table; null when it is not there. Counts come from the footers.

    A table may be a path, or a path and a condition on its partitions: a table that a stream writes has a log of
    what counts, which reading one of its folders would pass by.
    """
    sizes = []
    for name, place in tables.items():
        path, condition = (place, "true") if isinstance(place, str) else place
        try:
            rows = spark.read.parquet(path).where(condition).agg(F.count(F.lit(1)).alias("n_rows"))
            rows = rows.withColumn("n_rows", F.nullif("n_rows", F.lit(0))) if condition != "true" else rows
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            rows = spark.range(1).select(F.lit(None).cast("long").alias("n_rows"))
        sizes.append(rows.select(F.lit(name).alias("table_name"), "n_rows"))
    return reduce(DataFrame.unionByName, sizes)


def output_check(sizes: DataFrame, needed: int = 5) -> DataFrame:
    """How many expected tables hold rows, and whether that is enough."""
    filled = F.count_if(F.col("n_rows") > 0)
    return sizes.agg(
        F.count(F.lit(1)).alias("n_expected"), filled.alias("n_filled"), (filled >= needed).alias("passed")
    )
