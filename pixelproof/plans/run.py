"""The whole batch run, and the check of a stored model on a labelled sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import Featurizer, with_features
from ..functions.labels import decode_label
from ..operators.decisions import champion
from ..operators.ranking import sample_per_class
from ..schemas import INFERENCE_SAMPLE, METRICS, TEST
from ..sources.files import IMAGE_GLOB, as_literal_glob, scan_files, scan_images
from ..sources.tables import read_table, write_table
from .extract import in_layout, run_extraction
from .report import run_report
from .score import score_features
from .train import load_model, run_training


def run_all(
    spark: SparkSession,
    root: str,
    out: str,
    featurizer: Featurizer,
    dataset: str,
    glob: str = IMAGE_GLOB,
    decoded: bool = False,
    generated: str | None = None,
) -> DataFrame:
    """Files to features, models, metrics and report tables below ``out``; returns the output check."""
    features = f"{out}/features"
    run_extraction(spark, root, features, featurizer, glob, decoded)
    run_training(spark, features, f"{out}/results", featurizer)
    return run_report(
        spark, features, f"{out}/results", dataset, featurizer.name, featurizer.width, generated
    )


def run_sample(
    spark: SparkSession,
    root: str,
    results: str,
    featurizer: Featurizer,
    n: int = 50,
    glob: str = IMAGE_GLOB,
    decoded: bool = False,
) -> DataFrame:
    """Answers of the best stored model for the first n test files of each class.

    The sample is chosen from the listing; only the chosen files are read.
    """
    best = champion(read_table(spark, f"{results}/metrics", METRICS)).first()
    model = load_model(f"{results}/models/{best['best_model']}", featurizer)
    listing = in_layout(scan_files(spark, root, glob=glob)).where(F.col("split") == TEST)
    chosen = sample_per_class(listing.select("path", "label_name"), n)
    paths = [as_literal_glob(row["path"]) for row in chosen.collect()]  # at most n per class
    scan, item = (scan_images, "image") if decoded else (scan_files, "content")
    sample = in_layout(scan(spark, paths, glob=glob)).select("path", item, "label_name")
    scored = score_features(with_features(sample, featurizer, item), model, featurizer.width)
    rows = scored.select(
        "path",
        F.col("label_name").alias("actual_label"),
        decode_label(F.col("prediction")).alias("predicted_label"),
        "prediction",
    )
    write_table(rows, f"{results}/inference_sample")
    return read_table(spark, f"{results}/inference_sample", INFERENCE_SAMPLE)
