"""Image files: scans, split and label from the location, inventories."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import encode_label
from .listing import list_files

# Accepted endings and the folder layout, either plain folders or the
# key=value folders Spark writes; the folders nearest to the file count.
IMAGE_ENDINGS = ("jpg", "jpeg", "png")
LAYOUT = r"^.*/(?:split=)?(train|test)/(?:label_name=)?(REAL|FAKE)/"


def any_case_glob(endings: tuple[str, ...]) -> str:
    """A glob for files of these endings in any mixture of cases; globs themselves are case sensitive."""
    return "*.{%s}" % ",".join("".join(f"[{c.lower()}{c.upper()}]" for c in ending) for ending in endings)


IMAGE_GLOB = any_case_glob(IMAGE_ENDINGS)


def scan_files(spark: SparkSession, root: str | list[str], glob: str = IMAGE_GLOB, recursive: bool = True) -> DataFrame:
    """Files below ``root`` as path, modificationTime, length, content.

    One load covers all folders and endings. ``content`` is read only when a
    later step asks for it, so listings and inventories stay metadata jobs.
    Spark's file sources leave out files of zero bytes; ``empty_files`` has them.
    """
    list_in_few_tasks(spark)
    return _file_source(spark.read.format("binaryFile"), glob, recursive).load(root)


def all_files(spark: SparkSession, root: str | list[str], glob: str = IMAGE_GLOB) -> DataFrame:
    """path, length and modificationTime of every file below ``root``, those of zero bytes included.

    Folders list themselves in tasks (``sources/listing.py``); no name passes through the driver.
    """
    return list_files(spark, root, glob)


def empty_files(spark: SparkSession, root: str | list[str], glob: str = IMAGE_GLOB) -> DataFrame:
    """The files below ``root`` that hold nothing: path, length 0, content null."""
    empty = all_files(spark, root, glob).where("length = 0")
    return empty.select("path", "length", F.lit(None).cast("binary").alias("content"))


def scan_images(spark: SparkSession, root: str | list[str], glob: str = IMAGE_GLOB) -> DataFrame:
    """Decoded pictures as path, image; a file that cannot be decoded stays, with height -1.

    The ``image`` source escapes its file names; they are undone here so that a
    picture has the same path in every scan.
    """
    list_in_few_tasks(spark)
    images = _file_source(spark.read.format("image").option("dropInvalid", False), glob, True).load(root)
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return images.select(F.url_decode(escaped).alias("path"), "image")


def as_literal_glob(path: str) -> str:
    """A path from an earlier scan, safe to load again: loads read their paths as globs."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


LISTING_TASKS, USUAL = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000"


def list_in_few_tasks(spark: SparkSession) -> None:
    """Loads of many names list them in four tasks a core, where Spark's default is a task for each name.

    Any other setting stays.
    """
    if spark.conf.get(LISTING_TASKS) == USUAL:
        spark.conf.set(LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism)


def _file_source(reader, glob: str, recursive: bool):
    return reader.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)


def path_part(path: Column, pattern: str, group: int) -> Column:
    """A group of ``pattern`` in ``path``; null when the path does not fit."""
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def with_split_and_label(files: DataFrame, path: str = "path") -> DataFrame:
    """Add split, label_name and label from the folder names; null outside the layout."""
    return files.withColumns(
        {
            "split": path_part(F.col(path), LAYOUT, 1),
            "label_name": path_part(F.col(path), LAYOUT, 2),
        }
    ).withColumn("label", encode_label(F.col("label_name")))


def file_inventory(files: DataFrame) -> DataFrame:
    """Files, empty ones among them, and bytes per split and label; null for files outside the layout."""
    return files.groupBy("split", "label_name").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(F.col("length") == 0).alias("n_empty"),
        F.sum("length").alias("n_bytes"),
    )


def ending_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per ending in any case, with a flag for those ``scan_files`` takes; empty files count."""
    ending = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return (
        all_files(spark, root, glob="*")
        .groupBy(ending.alias("ending"))
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
        .withColumn("is_image", F.col("ending").isin(*IMAGE_ENDINGS))
    )
