"""Counts that a write takes of its own rows, kept beside the table.

The counts are Spark's observed metrics of the writing job, taken right before the rows reach the files, so a
check of the output needs no second scan. The observing operator stands in the job's last stage, whose tasks count
once each, however often they are tried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .tables import read_table, write_table

N_ROWS = "n_rows"


def counts_path(path: str) -> str:
    return f"{path.rstrip('/')}_counts"


def write_counted(df: DataFrame, path: str, counts: dict[str, Column] | None = None, mode: str = "overwrite", **options) -> dict[str, int]:
    """Write a table and, beside it, its number of rows and further counts, aggregates over its columns.

    With ``mode="append"`` the counts are appended too, a row for each write; ``counted`` adds them up. Counts are
    written after the table: a run that stops between has rows that are not counted, which ``counts_agree`` shows.
    """
    seen = Observation()
    aggregates = {N_ROWS: F.count(F.lit(1)), **(counts or {})}
    write_table(df.observe(seen, *[c.alias(name) for name, c in aggregates.items()]), path, mode=mode, **options)
    values = {name: int(seen.get.get(name) or 0) for name in aggregates}
    spark = df.sparkSession
    row = spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in values.items()])
    write_table(row, counts_path(path), mode=mode)
    return values


def counted(spark: SparkSession, path: str) -> DataFrame:
    """One row: the counts of all writes of a table."""
    rows = read_table(spark, counts_path(path))
    return rows.agg(*[F.sum(c).alias(c) for c in rows.columns])


def beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row of the columns of both, which have one row each: an aggregation instead of a product."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def counts_agree(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows by the counts, rows by the Parquet footers, and whether they agree."""
    stored = read_table(spark, path).agg(F.count(F.lit(1)).alias("n_stored"))
    both = beside(counted(spark, path).select(F.col(N_ROWS).alias("n_counted")), stored)
    return both.withColumn("agree", F.col("n_counted") == F.col("n_stored"))
