"""A stream that follows rewritten, repeated and empty files, against the batch job."""

import os
import time

from pyspark.sql import functions as F

from pixelproof.__main__ import main
from pixelproof.functions.featurizers import byte_histogram
from pixelproof.operators.linear import LinearScorer
from pixelproof.plans.extract import run_extraction
from pixelproof.plans.score import score_new
from pixelproof.schemas import FEATURES, NEW_PREDICTIONS
from pixelproof.sources.files import scan_files
from pixelproof.sources.tables import read_table
from pixelproof.streaming.arrivals import current_answers, follow_files, follow_scores


def rows(table):
    found = table.select(F.element_at(F.split("path", "/"), -1).alias("n"), "label", "split", "error", F.aggregate("features", F.lit(0.0), lambda a, x: a + x).alias("s"))
    return sorted(tuple(map(str, r)) for r in found.collect())


def test_stream_equals_batch_with_rewritten_repeated_and_empty_files(spark, tmp_path):
    folder, out = tmp_path / "raw/train/REAL", str(tmp_path / "streamed")
    folder.mkdir(parents=True)
    (tmp_path / "raw/test/FAKE").mkdir(parents=True)
    (folder / "a.jpg").write_bytes(b"x" * 4)
    (folder / "b.jpg").write_bytes(b"x" * 5)
    (folder / "e.jpg").write_bytes(b"")
    (tmp_path / "raw/outside.jpg").write_bytes(b"x")

    def stream():
        time.sleep(0.05)
        follow_files(spark, str(tmp_path / "raw"), out, byte_histogram(), str(tmp_path / "checkpoint"), overlap=3600)
        return read_table(spark, out, FEATURES)

    def batch(name):
        return run_extraction(spark, str(tmp_path / "raw"), str(tmp_path / name), byte_histogram())

    assert rows(stream()) == rows(batch("one"))
    parts = {p for p in (tmp_path / "streamed").rglob("*.parquet")}
    assert rows(stream()) == rows(batch("one"))  # the overlap lists all files again: none is scored again
    assert parts == {p for p in (tmp_path / "streamed").rglob("*.parquet")}

    (folder / "a.jpg").write_bytes(b"y" * 10)
    (folder / "e.jpg").write_bytes(b"full")
    (folder / "b.jpg").write_bytes(b"")
    (tmp_path / "raw/test/FAKE/new.jpg").write_bytes(b"zz")
    found = rows(stream())
    assert found == rows(batch("one")) == rows(batch("two")) and len(found) == 4
    assert ("b.jpg", "0", "train", "ValueError: no content", "None") in found

    # the batch job goes on with the stream's table, and finds what is deleted
    os.unlink(folder / "a.jpg")
    done = run_extraction(spark, str(tmp_path / "raw"), out, byte_histogram())
    assert rows(done) == rows(batch("three")) and done.count() == 3


def test_answers_follow_rewritten_files(spark, tmp_path):
    root, out = tmp_path / "raw", str(tmp_path / "answers")
    root.mkdir()
    for name, content in (("a", b"xx"), ("b", b"yyyy"), ("e", b"")):
        (root / f"{name}.jpg").write_bytes(content)
    model = LinearScorer(tuple(1.0 if b == ord("y") else -1.0 for b in range(256)))

    def stream():
        time.sleep(0.05)
        follow_scores(spark, str(root), out, byte_histogram(), model, str(tmp_path / "checkpoint"), overlap=3600)
        return {tuple(map(str, r)) for r in current_answers(spark, out).collect()}

    def batch():
        scored = score_new(scan_files(spark, str(root)), byte_histogram(), model)
        return {tuple(map(str, r)) for r in scored.select(*NEW_PREDICTIONS.fieldNames(), "error").collect()}

    first = stream()
    empty = {r for r in first if r[0].endswith("e.jpg")}
    assert first - empty == batch() and {r[1:] for r in empty} == {("None", "None", "None", "ValueError: no content")}
    (root / "a.jpg").write_bytes(b"yyy")
    (root / "e.jpg").write_bytes(b"x")
    assert stream() == batch() and len(batch()) == 3
    steps = read_table(spark, out).groupBy("path").count().collect()
    assert sorted(r["count"] for r in steps) == [1, 2, 2]  # what did not change was not scored again


def test_commands_follow(spark, tmp_path, capsys):
    folder = tmp_path / "raw/train/FAKE"
    folder.mkdir(parents=True)
    (folder / "a.jpg").write_bytes(b"abc")
    args = ["follow", "--root", str(tmp_path / "raw"), "--out", str(tmp_path / "out"), "--featurizer", "byte_histogram"]
    for expected in (1, 1):
        assert main(args, spark).first()["n_usable"] == expected
