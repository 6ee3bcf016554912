"""Score arriving rows or files once each with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from ..functions.features import Featurizer, extracted_from_files
from ..plans.extract import (
    PARTITIONS,
    feature_rows,
    in_layout,
    known_versions,
    largest_content,
    log_versions,
    remove_rows,
    tasks_for,
)
from ..plans.score import Model, score_features
from ..schemas import FEATURES, NEW_PREDICTIONS
from ..session import drop_folder, run_folder
from ..sources.files import IMAGE_GLOB, list_in_few_tasks
from ..sources.listing import list_stream
from ..sources.tables import read_if_present, read_table, write_table

# The fixed columns of Spark's binaryFile source.
FILE_COLUMNS = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)


def file_stream(
    spark: SparkSession, root: str, glob: str = IMAGE_GLOB, files_per_trigger: int | None = None
) -> DataFrame:
    """New files below ``root`` as they arrive. A file rewritten under its old path is not read again."""
    list_in_few_tasks(spark)
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_COLUMNS)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(root)


def table_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """New files of a Parquet table as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def score_stream(
    arriving: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    wait: bool = True,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append scored rows to a Parquet table, exactly once per arriving file.

    ``score`` holds per-row steps only, so the stream keeps no state and late
    files need no watermark. With ``wait`` it handles what has arrived and stops;
    the next call goes on from the checkpoint.
    """
    writer = (
        score(arriving)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not wait:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def extract_stream(
    spark: SparkSession,
    root: str,
    out: str,
    featurizer: Featurizer,
    checkpoint: str,
    glob: str = IMAGE_GLOB,
    files_per_trigger: int = 1_000_000,
    files_per_task: int = 2000,
    wait: bool = True,
) -> StreamingQuery:
    """Feature extraction in committed steps of ``files_per_trigger`` files.

    A lost driver or executor costs the current step only. Each step runs in tasks
    of ``files_per_task`` files, or one per core if that is more. Files outside the
    split and label folders are left out, as in the batch job.
    """
    tasks = tasks_for(spark, files_per_trigger, files_per_task)

    def features(files: DataFrame) -> DataFrame:
        return feature_rows(in_layout(files), featurizer, tasks=tasks)

    arriving = file_stream(spark, root, glob, files_per_trigger)
    return score_stream(arriving, features, out, checkpoint, wait, PARTITIONS)


# ---- arrivals that follow rewritten and empty files -------------------------------

VERSION = "path string, length long, modificationTime timestamp"


def newest_versions(arriving: DataFrame, remember: str = "1 day") -> DataFrame:
    """Files that are new or newer than the version seen last: path, length, modificationTime, rewritten.

    The state holds the last modification time and length of each path. A file seen again as it was gives no row.
    ``remember`` is the watermark on modification times: a path that has not changed for so long before the newest
    file is forgotten, so the state holds the files of that time only. Forgetting loses nothing: a file that is
    rewritten later is new by its time, and the source does not list older files again (``overlap`` should be less
    than ``remember``).
    """
    keep = timedelta(seconds=pd.Timedelta(remember).total_seconds())

    def newer(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get if state.exists else None
        best = last
        for batch in batches:
            for length, at in zip(batch["length"].tolist(), batch["modificationTime"]):
                one = (int(at.value // 1000), int(length))
                if best is None or one > best:
                    best = one
        if best is None or best == last:
            return
        state.update(best)
        forget = best[0] // 1000 + int(keep.total_seconds() * 1000)
        state.setTimeoutTimestamp(max(forget, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(
            {"path": [key[0]], "length": [best[1]], "modificationTime": [pd.Timestamp(best[0], unit="us")], "rewritten": [last is not None]}
        )

    return (
        arriving.withWatermark("modificationTime", remember)
        .groupBy("path")
        .applyInPandasWithState(
            newer, f"{VERSION}, rewritten boolean", "modified long, length long", "append", GroupStateTimeout.EventTimeTimeout
        )
    )


def follow_files(
    spark: SparkSession,
    root: str,
    out: str,
    featurizer: Featurizer,
    checkpoint: str,
    glob: str = IMAGE_GLOB,
    settle: float = 0,
    overlap: float = 0,
    remember: str = "1 day",
    wait: bool = True,
) -> StreamingQuery:
    """Keep the features table ``out`` up to the files below ``root`` as they arrive or are rewritten.

    Tasks list the folders and open the files themselves. Empty, broken and too large files get rows with their
    error, as in the batch job, and the version log is the same, so ``run_extraction`` can go on with the table; it
    is also what finds deleted files, and files that arrive with a time older than the last step's.

    A step is stored, logged, takes the old rows of its paths out (only where the log knows them) and appends the
    new ones. A step that is repeated after a failure finds its paths in the log, so no row comes twice.
    """
    most = largest_content(spark)

    def step(files: DataFrame, number: int) -> None:
        session = files.sparkSession
        listed = run_folder(session, "arrived-files")
        write_table(in_layout(files), listed)
        batch = read_table(session, listed)
        if not batch.isEmpty():
            again = batch.join(known_versions(session, out).select("path"), "path", "left_semi")
            if not again.isEmpty() and not read_if_present(session, out, FEATURES).isEmpty():
                remove_rows(session, out, again)
            log_versions(batch, out)
            found = extracted_from_files(F.col("path"), F.col("length"), featurizer, most)
            rows = batch.select("path", "label", "label_name", "split", found.alias("x")).select("*", "x.*")
            write_table(rows.select(*FEATURES.fieldNames()), out, mode="append", partition_by=PARTITIONS)
        drop_folder(session, listed)

    versions = newest_versions(list_stream(spark, root, glob, settle=settle, overlap=overlap), remember)
    writer = versions.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if not wait:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def follow_scores(
    spark: SparkSession,
    root: str,
    out: str,
    featurizer: Featurizer,
    model: Model,
    checkpoint: str,
    glob: str = IMAGE_GLOB,
    settle: float = 0,
    overlap: float = 0,
    remember: str = "1 day",
    threshold: float | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Score files as they arrive, and again when they are rewritten; empty and broken ones get their error.

    Every version that was scored is a row of ``out`` in the folder of its step, which a repeated step replaces;
    ``current_answers`` has the newest one of each file.
    """
    most = largest_content(spark)

    def step(files: DataFrame, number: int) -> None:
        found = extracted_from_files(F.col("path"), F.col("length"), featurizer, most).alias("x")
        rows = files.select("path", "length", "modificationTime", found).select("path", "length", "modificationTime", "x.*")
        scored = score_features(rows, model, featurizer.width, threshold).withColumn("step", F.lit(number).cast("long"))
        write_table(scored, out, partition_by=("step",))

    versions = newest_versions(list_stream(spark, root, glob, settle=settle, overlap=overlap), remember)
    writer = versions.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if not wait:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def current_answers(spark: SparkSession, out: str) -> DataFrame:
    """path, prediction, result, confidence and error of the newest scored version of each file."""
    columns = [*NEW_PREDICTIONS.fieldNames(), "error"]
    newest = F.max_by(F.struct(*columns), F.struct("modificationTime", "step")).alias("x")
    return read_table(spark, out).groupBy(F.col("path").alias("_path")).agg(newest).select("x.*")
