"""Sizes and shares. Shares are taken over the few grouped rows, not over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import ratio
from ..functions.vectors import is_zero_vector
from ..schemas import TEST, TRAIN


def class_distribution(rows: DataFrame) -> DataFrame:
    """Rows per split and class, with the share of the split."""
    counts = rows.groupBy("split", "label_name").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", ratio(F.col("n"), F.sum("n").over(Window.partitionBy("split"))))


def dataset_sizes(rows: DataFrame) -> DataFrame:
    """Training and test rows and their shares, one pass over the split column."""
    sizes = rows.agg(
        F.count_if(F.col("split") == TRAIN).alias("n_train"),
        F.count_if(F.col("split") == TEST).alias("n_test"),
    )
    total = F.col("n_train") + F.col("n_test")
    return sizes.select(
        "n_train",
        "n_test",
        total.alias("n_total"),
        ratio(F.col("n_train"), total).alias("train_share"),
        ratio(F.col("n_test"), total).alias("test_share"),
    )


def result_summary(scored: DataFrame, result: str = "result") -> DataFrame:
    """Rows per answer with the share of all rows."""
    counts = scored.groupBy(result).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", ratio(F.col("n"), F.sum("n").over(Window.partitionBy())))


def quarantine_counts(features: DataFrame) -> DataFrame:
    """Usable, broken and all-zero feature rows per split."""
    return features.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("error").isNull()).alias("n_usable"),
        F.count_if(F.col("error").isNotNull()).alias("n_quarantined"),
        F.count_if(is_zero_vector(F.col("features"))).alias("n_zero_vectors"),
    )
