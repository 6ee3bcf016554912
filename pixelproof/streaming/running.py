"""Results that grow with each arrival: answers now, labels later.

Answers and labels are two streams, joined by path where their times lie within ``late`` of each other; watermarks
let the join forget what can no longer be matched. Each step writes the confusion cells of its matches and the
counts of its answers as a few rows under its own number, so a repeated step replaces its rows, and the table so far
is a sum of small rows, however much has arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.labels import decode_label, ratio
from ..operators.confusion import confusion_cells
from ..sources.tables import read_if_present

COUNTS = ("true_positive", "true_negative", "false_positive", "false_negative", "n_other")
STEP_CELLS = StructType([StructField("model", StringType()), *[StructField(c, LongType()) for c in COUNTS], StructField("step", LongType())])
STEP_RESULTS = StructType(
    [StructField("model", StringType()), StructField("result", StringType()), StructField("n", LongType()), StructField("step", LongType())]
)


def matched(answers: DataFrame, labels: DataFrame, late: str = "1 day") -> DataFrame:
    """model, path, prediction, label of answers whose label arrives within ``late``, before or after.

    ``answers`` has model, path, prediction and answered_at, ``labels`` path, label and labelled_at. A label that
    comes later than that is not counted; ``answered`` counts its answer all the same.
    """
    a = answers.withWatermark("answered_at", late).alias("a")
    b = labels.withWatermark("labelled_at", late).alias("b")
    span = F.expr(f"INTERVAL {late}")
    near = F.col("b.labelled_at").between(F.col("a.answered_at") - span, F.col("a.answered_at") + span)
    return a.join(b, (F.col("a.path") == F.col("b.path")) & near).select("a.model", "a.path", "a.prediction", "b.label")


def _write_step(rows: DataFrame, out: str, number: int) -> None:
    numbered = rows.withColumn("step", F.lit(number).cast("long"))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("step").parquet(out)


def _run(steps: DataFrame, write, checkpoint: str, wait: bool) -> StreamingQuery:
    writer = steps.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if not wait:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_cells(answers: DataFrame, labels: DataFrame, out: str, checkpoint: str, late: str = "1 day", wait: bool = True) -> StreamingQuery:
    """Add the confusion cells of newly matched answers to the table ``out``."""

    def write(rows: DataFrame, number: int) -> None:
        _write_step(confusion_cells(rows).select("model", *COUNTS), out, number)

    return _run(matched(answers, labels, late), write, checkpoint, wait)


def run_results(answers: DataFrame, out: str, checkpoint: str, wait: bool = True) -> StreamingQuery:
    """Add the counts of newly arrived answers, labelled or not, to the table ``out``."""

    def write(rows: DataFrame, number: int) -> None:
        result = decode_label(F.col("prediction")).alias("result")
        _write_step(rows.groupBy("model", result).agg(F.count(F.lit(1)).alias("n")), out, number)

    return _run(answers, write, checkpoint, wait)


def cells_so_far(spark: SparkSession, out: str) -> DataFrame:
    """The confusion cells of all answers matched so far, one row per model."""
    return read_if_present(spark, out, STEP_CELLS).groupBy("model").agg(*[F.sum(c).alias(c) for c in COUNTS])


def results_so_far(spark: SparkSession, out: str) -> DataFrame:
    """Answers per model and result so far, with the share of the model's answers."""
    counts = read_if_present(spark, out, STEP_RESULTS).groupBy("model", "result").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("model").agg(F.sum("n").alias("_all"))
    return counts.join(totals, "model").select("model", "result", "n", ratio(F.col("n"), F.col("_all")).alias("share"))
