"""Tables that live between jobs, in the folder all executors share."""

from __future__ import annotations

import ctypes
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import run_folder, ship_package


@dataclass
class Stored:
    """A written table: later jobs read it instead of computing it again after a lost executor."""

    path: str
    rows: DataFrame

    def discard(self) -> None:
        discard(self.rows.sparkSession, self.path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, purpose: str) -> Stored:
    """Writes the table; what was shuffled for it alone leaves the disks as soon as it is written."""
    spark = df.sparkSession
    path = run_folder(spark, purpose)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.select("*").write.parquet(path)  # planned anew, under this setting
    finally:
        spark.conf.set(CLEANUP, before)
    return Stored(path, spark.read.schema(df.schema).parquet(path))


def discard(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
FEW, USUAL = "1000", "10000"


def ready(df: DataFrame) -> SparkSession:
    """The session, with the package sent to the Python workers.

    Texts may be long, so Spark's usual batch of rows for Python is made smaller; any other setting stays.
    """
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(BATCH) == USUAL:
        spark.conf.set(BATCH, FEW)
    return spark


def give_back() -> None:
    """Returns the memory that a task's Python worker has freed to the system.

    Workers wait for later tasks, and what they keep then counts beside those tasks' own. Only glibc needs this.
    """
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
