"""Result tables of a finished training run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.decisions import insight_facts, output_check, report_facts, report_series, table_sizes
from ..operators.distribution import class_distribution
from ..schemas import CONFUSION_MATRIX, FEATURES, METRICS
from ..sources.tables import read_table, write_table


def expected_tables(features_path: str, out: str) -> dict[str, str | tuple[str, str]]:
    """The tables a complete run leaves."""
    return {
        "train_features": (features_path, "split = 'train'"),
        "test_features": (features_path, "split = 'test'"),
        "metrics": f"{out}/metrics",
        "lr_predictions": f"{out}/predictions/model=LogisticRegression",
        "rf_predictions": f"{out}/predictions/model=RandomForest",
        "confusion_matrix": f"{out}/confusion_matrix",
        "business_insight": f"{out}/business_insight",
    }


def run_report(
    spark: SparkSession,
    features_path: str,
    out: str,
    dataset: str,
    extractor: str,
    width: int,
    generated: str | None = None,
) -> DataFrame:
    """Write business_insight, report_series and report_info; return the output check."""
    features = read_table(spark, features_path, FEATURES).select("split", "label_name")
    metrics = read_table(spark, f"{out}/metrics", METRICS)
    cells = read_table(spark, f"{out}/confusion_matrix", CONFUSION_MATRIX)
    write_table(insight_facts(metrics, features, dataset, extractor, width), f"{out}/business_insight")
    series = report_series(metrics, cells, class_distribution(features), width)
    write_table(series, f"{out}/report_series")
    write_table(report_facts(metrics, f"{out}/report_series", generated), f"{out}/report_info")
    return output_check(table_sizes(spark, expected_tables(features_path, out)))
