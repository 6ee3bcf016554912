"""Command line for the jobs; each prints the table it returns."""

from __future__ import annotations

import argparse
import importlib
import sys
from pathlib import Path

if not __package__:  # started as a file by spark-submit
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession

from pixelproof.functions.features import Featurizer
from pixelproof.functions.featurizers import byte_histogram, pixel_histogram
from pixelproof.operators.decisions import output_check, table_sizes
from pixelproof.operators.distribution import quarantine_counts, result_summary
from pixelproof.plans.extract import run_extraction, tasks_for
from pixelproof.plans.report import expected_tables, run_report
from pixelproof.plans.run import run_all, run_sample
from pixelproof.plans.score import run_scoring, score_new
from pixelproof.plans.train import load_model, run_training
from pixelproof.schemas import FEATURES
from pixelproof.session import build_session
from pixelproof.sources.files import scan_files, scan_images
from pixelproof.sources.tables import read_table
from pixelproof.streaming.arrivals import current_answers, extract_stream, file_stream, follow_files, follow_scores, score_stream

FEATURIZERS = {"pixel_histogram": pixel_histogram, "byte_histogram": byte_histogram}
FILES_PER_TASK = 2000


def _options(args: argparse.Namespace) -> tuple[Featurizer, bool]:
    """The featurizer, and whether it wants decoded pictures; ``module:function`` names one of the user's own."""
    module, _, function = args.featurizer.partition(":")
    make = getattr(importlib.import_module(module), function) if function else FEATURIZERS[module]
    return make(), args.featurizer == "pixel_histogram"


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    featurizer, decoded = _options(args)
    return run_all(spark, args.root, args.out, featurizer, args.dataset, decoded=decoded, generated=args.generated)


def extract(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    featurizer, decoded = _options(args)
    return quarantine_counts(run_extraction(spark, args.root, f"{args.out}/features", featurizer, decoded=decoded))


def stream_extract(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    featurizer, decoded = _options(args)
    if decoded:
        raise SystemExit("the image source cannot be streamed; use extract")
    out = f"{args.out}/features"
    extract_stream(spark, args.root, out, featurizer, f"{args.out}/features-checkpoint")
    return quarantine_counts(read_table(spark, out, FEATURES))


def train(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return run_training(spark, f"{args.out}/features", f"{args.out}/results", _options(args)[0])


def report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    f, _ = _options(args)
    features, results = f"{args.out}/features", f"{args.out}/results"
    return run_report(spark, features, results, args.dataset, f.name, f.width, args.generated)


def sample(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    featurizer, decoded = _options(args)
    return run_sample(spark, args.root, f"{args.out}/results", featurizer, decoded=decoded)


def score(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    featurizer, decoded = _options(args)
    raw = scan_images(spark, args.root) if decoded else scan_files(spark, args.root)
    model = load_model(args.model, featurizer)
    item = "image" if decoded else "content"
    tasks = tasks_for(spark, raw.select("path").count(), FILES_PER_TASK)
    options = {"item": item, "refit_scaler": args.refit_scaler, "threshold": args.threshold, "tasks": tasks}
    return result_summary(run_scoring(raw, featurizer, model, args.out, **options))


def stream_score(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    featurizer, decoded = _options(args)
    if decoded:
        raise SystemExit("the image source cannot be streamed; use score")
    model = load_model(args.model, featurizer)
    out = f"{args.out}/new_predictions"
    arriving = file_stream(spark, args.root, files_per_trigger=args.files_per_trigger)
    tasks = tasks_for(spark, args.files_per_trigger, FILES_PER_TASK)

    def answers(files: DataFrame) -> DataFrame:
        return score_new(files, featurizer, model, threshold=args.threshold, tasks=tasks)

    score_stream(arriving, answers, out, f"{out}-checkpoint")
    return result_summary(read_table(spark, out))


def follow(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    featurizer, decoded = _options(args)
    if decoded:
        raise SystemExit("the image source cannot be streamed; use extract, which follows rewritten files too")
    out = f"{args.out}/features"
    follow_files(spark, args.root, out, featurizer, f"{out}-follow-checkpoint", overlap=args.overlap)
    return quarantine_counts(read_table(spark, out))


def follow_score(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    featurizer, decoded = _options(args)
    if decoded:
        raise SystemExit("the image source cannot be streamed; use score")
    out = f"{args.out}/answers"
    model = load_model(args.model, featurizer)
    follow_scores(
        spark, args.root, out, featurizer, model, f"{out}-checkpoint", overlap=args.overlap, threshold=args.threshold
    )
    return result_summary(current_answers(spark, out))


def check(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    tables = expected_tables(f"{args.out}/features", f"{args.out}/results")
    return output_check(table_sizes(spark, tables))


JOBS = {
    "run": run,
    "extract": extract,
    "stream-extract": stream_extract,
    "train": train,
    "report": report,
    "sample": sample,
    "score": score,
    "stream-score": stream_score,
    "follow": follow,
    "follow-score": follow_score,
    "check": check,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    parser = argparse.ArgumentParser(prog="pixelproof", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", help="folder of image files")
    parser.add_argument("--out", required=True, help="folder of all tables and models")
    parser.add_argument(
        "--featurizer", default="pixel_histogram", help=f"one of {', '.join(FEATURIZERS)}, or module:function of your own"
    )
    parser.add_argument("--files-per-trigger", type=int, default=1_000_000, help="files of a streaming step")
    parser.add_argument("--overlap", type=float, default=0, help="seconds a following step looks back for late files")
    parser.add_argument("--model", help="stored model, for the scoring jobs")
    parser.add_argument("--dataset", default="images", help="name shown in the report tables")
    parser.add_argument("--generated", help="time shown in the report tables")
    parser.add_argument("--refit-scaler", action="store_true", help="fit the scaler on the files to be scored")
    parser.add_argument("--threshold", type=float, help="P(FAKE) above which a new file is called FAKE")
    args = parser.parse_args(argv)
    if args.root is None and args.job not in ("train", "report", "check"):
        parser.error(f"{args.job} needs --root")
    if args.model is None and args.job in ("score", "stream-score", "follow-score"):
        parser.error(f"{args.job} needs --model")
    result = JOBS[args.job](spark or build_session("pixelproof"), args)
    result.show(truncate=False)
    return result


if __name__ == "__main__":
    main()
