import pytest
from fixtures import png_tree, separable
from pyspark.sql import functions as F

from pixelproof.functions.featurizers import byte_histogram
from pixelproof.functions.vectors import to_vector
from pixelproof.operators.linear import LinearScorer
from pixelproof.plans.extract import run_extraction
from pixelproof.plans.score import score_features, score_new
from pixelproof.plans.train import classifiers, fit_models
from pixelproof.schemas import FEATURES
from pixelproof.sources.files import scan_files
from pixelproof.sources.tables import read_table, write_table
from pixelproof.streaming.arrivals import extract_stream, file_stream, score_stream, table_stream

WEIGHTS = tuple(((i * 37) % 17 - 8) / 8.0 for i in range(64))


def test_second_run_scores_only_new_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(
        "vec_id", F.col("embedding").alias("features")
    )
    write_table(rows.repartition(3), source)
    scorer = LinearScorer(WEIGHTS)

    def run():
        arriving = table_stream(spark, source, rows.schema, files_per_trigger=1)
        score_stream(arriving, lambda df: scorer.transform(df), out, str(tmp_path / "checkpoint"))
        return read_table(spark, out)

    batch = {r["vec_id"]: r["prediction"] for r in scorer.transform(rows).collect()}
    first = run()
    assert {r["vec_id"]: r["prediction"] for r in first.collect()} == batch
    write_table(rows.where("vec_id < 7").withColumn("vec_id", F.col("vec_id") + 100000), source, mode="append")
    assert run().count() == 507


def test_stored_pipeline_scores_a_stream(spark, tmp_path):
    rows = separable(spark).select(
        F.col("id").cast("string").alias("path"),
        F.col("a").cast("array<float>").alias("features"),
        F.lit(None).cast("string").alias("error"),
        "label",
    )
    train = rows.withColumn("features", to_vector("features"))
    model = fit_models(train, {"m": classifiers()["LogisticRegression"]})["m"].model
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_table(rows.repartition(5), source)

    def score(df):
        return score_features(df, model, 16)

    arriving = table_stream(spark, source, rows.schema, files_per_trigger=2)
    score_stream(arriving, score, out, str(tmp_path / "checkpoint"))
    batch = {r["path"]: r["confidence"] for r in score(rows).collect()}
    assert {r["path"]: r["confidence"] for r in read_table(spark, out).collect()} == batch


def test_arriving_files_equal_batch(spark, tmp_path):
    png_tree(tmp_path)
    root, out = str(tmp_path / "raw"), str(tmp_path / "out")
    scorer = LinearScorer(tuple((b % 5 - 2) / 500 for b in range(256)))

    def score(files):
        return score_new(files, byte_histogram(), scorer)

    score_stream(file_stream(spark, root, files_per_trigger=5), score, out, str(tmp_path / "checkpoint"))
    stream = {r["path"]: r["confidence"] for r in read_table(spark, out).collect()}
    batch = {r["path"]: r["confidence"] for r in score(scan_files(spark, root)).collect()}
    assert len(stream) == 12 and stream == batch


def test_extraction_in_steps(spark, tmp_path):
    png_tree(tmp_path)
    (tmp_path / "raw/loose.png").write_bytes(b"outside the folders")
    root, out, checkpoint = str(tmp_path / "raw"), str(tmp_path / "features"), str(tmp_path / "checkpoint")
    extract_stream(spark, root, out, byte_histogram(), checkpoint, files_per_trigger=4)
    assert read_table(spark, out, FEATURES).select("split", "label_name").distinct().count() == 4
    extract_stream(spark, root, out, byte_histogram(), checkpoint, files_per_trigger=4)
    assert read_table(spark, out, FEATURES).count() == 12
    with pytest.raises(ValueError, match="belongs to a stream"):
        run_extraction(spark, root, out, byte_histogram())
