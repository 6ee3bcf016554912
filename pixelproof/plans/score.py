"""Scoring files nobody has labelled."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import Featurizer, with_features
from ..functions.labels import decode_label
from ..functions.vectors import to_vector
from ..operators.linear import LinearScorer, answer
from ..schemas import FAKE, NEW_PREDICTIONS, NEW_PREDICTIONS_CSV, REAL
from ..session import run_folder
from ..sources.counted import write_counted
from ..sources.tables import read_table, write_csv, write_table
from .train import scaler

Model = PipelineModel | LinearScorer


def score_features(rows: DataFrame, model: Model, width: int, threshold: float | None = None) -> DataFrame:
    """Add prediction, result and confidence to rows with features and error.

    With ``threshold`` a row is FAKE when P(FAKE) lies above it, whatever the model's own.
    A row without features is carried through with no answer. ML models cannot
    take a null vector, so such a row passes them as zeros and is blanked after.
    """
    usable = F.col("features").isNotNull()
    if isinstance(model, LinearScorer):
        scored = model.transform(rows)
        fake: Column = F.col("fake_probability")
    else:
        zeros = F.array_repeat(F.lit(0.0).cast("float"), width)
        filled = rows.withColumns(
            {"_usable": usable, "features": to_vector(F.coalesce(F.col("features"), zeros))}
        )
        scored = model.transform(filled)
        usable = F.col("_usable")
        fake = vector_to_array("probability")[1]
    usable = usable & ~F.isnan(fake)
    prediction = F.when(usable, F.col("prediction") if threshold is None else answer(fake, threshold))
    kept = [c for c in rows.columns if c != "features"]
    return scored.select(
        *kept, prediction.alias("prediction"), F.when(usable, fake * 100).alias("confidence")
    ).withColumn("result", decode_label(F.col("prediction")))


def refitted(model: Model, features: DataFrame) -> Model:
    """The model with its scaler fitted again on the data to be scored.

    For parity only: the stored scaler is the right one, since the weights were
    learned in its units. A LinearScorer takes its weights as those of scaled features.
    """
    usable = features.where(F.col("features").isNotNull())
    scaling = scaler().fit(usable.select(to_vector("features").alias("features")))
    if isinstance(model, LinearScorer):
        return model.scaled(list(scaling.std))
    return PipelineModel([scaling if _is_scaler(stage) else stage for stage in model.stages])


def _is_scaler(stage) -> bool:
    return stage.hasParam("withStd")


def score_new(
    raw: DataFrame,
    featurizer: Featurizer,
    model: Model,
    item: str = "content",
    refit_scaler: bool = False,
    tasks: int | None = None,
    threshold: float | None = None,
) -> DataFrame:
    """path, prediction, result, confidence (percent P(FAKE)) and error for every file."""
    rows = with_features(raw.select("path", item), featurizer, item, tasks)
    if refit_scaler:
        # two passes need the features: store them once instead of extracting twice
        stored = run_folder(raw.sparkSession, "features-to-score")
        write_table(rows, stored)
        rows = read_table(raw.sparkSession, stored, rows.schema)
        model = refitted(model, rows)
    return score_features(rows, model, featurizer.width, threshold).select(*NEW_PREDICTIONS.fieldNames(), "error")


def run_scoring(raw: DataFrame, featurizer: Featurizer, model: Model, out: str, **options) -> DataFrame:
    """Score, then store Parquet, CSV and quarantine tables from one scoring pass, which also counts its rows."""
    spark = raw.sparkSession
    counts = {
        "n_fake": F.count_if(F.col("result") == FAKE),
        "n_real": F.count_if(F.col("result") == REAL),
        "n_quarantined": F.count_if(F.col("error").isNotNull()),
    }
    write_counted(score_new(raw, featurizer, model, **options), f"{out}/new_predictions", counts)
    stored = read_table(spark, f"{out}/new_predictions")
    write_csv(stored.select(*NEW_PREDICTIONS_CSV.fieldNames()), f"{out}/new_predictions_csv")
    write_table(
        stored.where(F.col("error").isNotNull()).select("path", "error"), f"{out}/new_quarantine"
    )
    return stored
