"""Parquet and CSV tables: typed reads, writes, unions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.vectors import to_vector
from ..schemas import FEATURES

CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Usable feature rows with an ML vector; the error filter reaches the Parquet scan."""
    rows = read_table(spark, path, FEATURES).where(F.col("error").isNull())
    return rows.select("path", to_vector("features").alias("features"), "label", "label_name", "split")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table, empty when nothing has been written there yet."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name; a missing or extra column is an error."""
    for other in others:
        first = first.unionByName(other)
    return first


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = (),
    whole_table: bool = False,
) -> None:
    """Write Parquet. Overwriting with partition columns replaces only the partitions written,
    unless ``whole_table`` asks to drop the others too.
    """
    writer = df.write.mode(mode)
    if partition_by:
        replaced = "static" if whole_table else "dynamic"
        writer = writer.option("partitionOverwriteMode", replaced).partitionBy(*partition_by)
    writer.parquet(path)


def is_stream_table(spark: SparkSession, path: str) -> bool:
    """Whether a streaming query owns the table: readers then see only files in its log."""
    try:
        spark.read.text(f"{path}/_spark_metadata")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV part files written by the executors, each with a header."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
