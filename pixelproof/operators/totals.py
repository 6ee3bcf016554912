"""All counts of a report in one pass: grouping sets over model, split and class.

One aggregation reads the rows once and keeps a few sums for each combination; the tables of the single operators
are projections of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import ratio
from ..schemas import TEST, TRAIN

SPLIT_AND_CLASS, SPLIT, MODEL_AND_CLASS, MODEL = "split and class", "split", "model and class", "model"
#: Which of (model, split, label_name) a level leaves out, as Spark's grouping_id gives it.
LEVELS = {0b100: SPLIT_AND_CLASS, 0b101: SPLIT, 0b010: MODEL_AND_CLASS, 0b011: MODEL}


def all_totals(rows: DataFrame) -> DataFrame:
    """level, model, split, label_name, n_rows, n_errors, n_empty and n_bytes of rows with label, prediction and length.

    Where a level leaves a column out, it is null; a null among the rows is a group of its own, as ``level`` tells.
    """
    model, split, name = (F.col(c) for c in ("model", "split", "label_name"))
    sums = rows.groupingSets([[split, name], [split], [model, name], [model]], model, split, name).agg(
        F.grouping_id().alias("_left_out"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("label") != F.col("prediction")).alias("n_errors"),
        F.count_if(F.col("length") == 0).alias("n_empty"),
        F.sum("length").alias("n_bytes"),
    )
    level = F.coalesce(*[F.when(F.col("_left_out") == number, text) for number, text in LEVELS.items()])
    return sums.select(level.alias("level"), "model", "split", "label_name", "n_rows", "n_errors", "n_empty", "n_bytes")


def class_distribution(totals: DataFrame) -> DataFrame:
    """Rows per split and class, with the share of the split."""
    counts = totals.where(F.col("level") == SPLIT_AND_CLASS).select("split", "label_name", F.col("n_rows").alias("n"))
    return counts.withColumn("share", ratio(F.col("n"), F.sum("n").over(Window.partitionBy("split"))))


def dataset_sizes(totals: DataFrame) -> DataFrame:
    """Training and test rows and their shares."""
    n = {s: F.coalesce(F.sum(F.when((F.col("level") == SPLIT) & (F.col("split") == s), F.col("n_rows"))), F.lit(0)) for s in (TRAIN, TEST)}
    sizes = totals.agg(n[TRAIN].alias("n_train"), n[TEST].alias("n_test"))
    total = F.col("n_train") + F.col("n_test")
    return sizes.select(
        "n_train", "n_test", total.alias("n_total"), ratio(F.col("n_train"), total).alias("train_share"), ratio(F.col("n_test"), total).alias("test_share")
    )


def file_inventory(totals: DataFrame) -> DataFrame:
    """Files, empty ones among them, and bytes per split and class."""
    level = totals.where(F.col("level") == SPLIT_AND_CLASS)
    return level.select("split", "label_name", F.col("n_rows").alias("n_files"), "n_empty", "n_bytes")


def error_by_class(totals: DataFrame) -> DataFrame:
    """Error rate of the rows that truly belong to each class."""
    level = totals.where(F.col("level") == MODEL_AND_CLASS)
    return level.select("model", "label_name", "n_rows", "n_errors", ratio(F.col("n_errors"), F.col("n_rows")).alias("error_rate"))
