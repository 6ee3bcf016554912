"""Histograms of files of any size, made of byte ranges.

Spark's file scan makes one row of a file and refuses those beyond its limit. Here a listed file becomes a row for
each range of its bytes, tasks read the ranges, and partial histograms are added up, so one huge file is read by
many tasks and none holds more than a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from ..sources.listing import read_range

MB = 1 << 20


def byte_ranges(listing: DataFrame, size: int = MB) -> DataFrame:
    """A row for each range of ``size`` bytes of each file: the listing's columns and start; none for empty files."""
    last = F.floor((F.col("length") - 1) / size)
    starts = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: i * size)
    return listing.where("length > 0").withColumn("start", F.explode(starts))


def range_histogram(path: Column, start: Column, size: int) -> Column:
    """How often each byte value occurs in a range of a file, and what went wrong if it could not be read."""

    @F.arrow_udf("struct<counts: array<bigint>, error: string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for paths, starts in batches:
            counts, errors = [], []
            for one, at in zip(paths.to_pylist(), starts.to_pylist()):
                try:
                    part = np.frombuffer(read_range(one, at, size), np.uint8)
                    counts.append(np.bincount(part, minlength=256).tolist())
                    errors.append(None)
                except Exception as problem:  # a file that cannot be read is data, not a failed job
                    counts.append(None)
                    errors.append(f"{type(problem).__name__}: {problem}")
            yield pa.StructArray.from_arrays([pa.array(counts, pa.list_(pa.int64())), pa.array(errors, pa.string())], names=["counts", "error"])

    return run(path, start)


def histograms_by_range(listing: DataFrame, size: int = MB) -> DataFrame:
    """path, features (256 counts of byte values), error of every listed file, as ``byte_histogram`` gives them.

    Ranges are spread by path and start, so those of one file go to many tasks; their counts are added by path and
    value, before the shuffle in each task. A file of which a range cannot be read has its error and no features.
    """
    spark = listing.sparkSession
    ship_package(spark)
    # with a number, since Spark merges partitions of little shuffled data, and these rows are small but cause long reads
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = byte_ranges(listing.select("path", "length"), size).repartition(tasks, "path", "start")
    parts = ranges.select("path", range_histogram(F.col("path"), F.col("start"), size).alias("x")).select("path", "x.*")
    values = parts.select("path", "error", F.posexplode_outer("counts").alias("value", "n"))
    sums = values.groupBy("path", "value").agg(F.sum("n").alias("n"), F.max("error").alias("error"))
    counts = F.transform(F.sort_array(F.collect_list(F.struct("value", "n"))), lambda x: x["n"].cast("float"))
    whole = sums.groupBy("path").agg(counts.alias("counts"), F.max("error").alias("error"))
    features = F.when(F.col("error").isNull(), F.col("counts")).alias("features")
    empty = listing.where("length = 0").select(
        "path", F.lit(None).cast("array<float>").alias("features"), F.lit("ValueError: no content").alias("error")
    )
    return whole.select("path", features, "error").unionByName(empty)
