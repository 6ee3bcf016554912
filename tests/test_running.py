"""Running cells and results from two streams."""

from pyspark.sql import functions as F

from pixelproof.streaming import running
from pixelproof.streaming.arrivals import table_stream

ANSWERS = "model string, path string, prediction double, answered_at timestamp"
LABELS = "path string, label int, labelled_at timestamp"



def land(spark, rows, schema, time, place):
    plain = schema.replace(f"{time} timestamp", "h double")
    spark.createDataFrame(rows, plain).select("*", F.timestamp_seconds((F.col("h") + 1000) * 3600).alias(time)).drop("h").write.mode("append").parquet(place)


def test_labels_that_come_later_are_counted_once(spark, tmp_path):
    answers, labels, out, point = (str(tmp_path / n) for n in ("answers", "labels", "cells", "checkpoint"))

    def run():
        a = table_stream(spark, answers, spark.createDataFrame([], ANSWERS).schema)
        b = table_stream(spark, labels, spark.createDataFrame([], LABELS).schema)
        running.run_cells(a, b, out, point, late="1 day")
        rows = running.cells_so_far(spark, out).collect()
        return {r["model"]: tuple(r[c] for c in running.COUNTS) for r in rows}

    land(spark, [("m", "a", 1.0, 0.0), ("m", "b", 0.0, 1.0), ("k", "a", 0.0, 1.0)], ANSWERS, "answered_at", answers)
    land(spark, [("none", 1, 0.0)], LABELS, "labelled_at", labels)
    assert run() == {}
    land(spark, [("a", 1, 5.0)], LABELS, "labelled_at", labels)
    assert run() == {"m": (1, 0, 0, 0, 0), "k": (0, 0, 0, 1, 0)}
    assert run() == {"m": (1, 0, 0, 0, 0), "k": (0, 0, 0, 1, 0)}  # nothing new, nothing counted again
    land(spark, [("b", 1, 20.0), ("c", 0, 21.0), ("d", 7, 21.0)], LABELS, "labelled_at", labels)
    land(spark, [("m", "c", 0.0, 22.0), ("m", "d", 1.0, 22.0), ("m", "e", 1.0, 80.0)], ANSWERS, "answered_at", answers)
    assert run() == {"m": (1, 1, 0, 1, 1), "k": (0, 0, 0, 1, 0)}
    land(spark, [("e", 1, 200.0)], LABELS, "labelled_at", labels)  # five days late
    assert run() == {"m": (1, 1, 0, 1, 1), "k": (0, 0, 0, 1, 0)}


def test_repeated_step_replaces_its_rows(spark, tmp_path):
    out = str(tmp_path / "cells")
    rows = spark.createDataFrame([("m", 1, 2, 3, 4, 5)], "model string, " + ", ".join(f"{c} long" for c in running.COUNTS))
    for step in (0, 1, 1):
        running._write_step(rows, out, step)
    assert [tuple(r) for r in running.cells_so_far(spark, out).collect()] == [("m", 2, 4, 6, 8, 10)]
    assert running.cells_so_far(spark, str(tmp_path / "nothing")).count() == 0
