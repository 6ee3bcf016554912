"""Training, storing, scoring and evaluating the models."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import Featurizer
from ..functions.labels import decode_label
from ..operators.confusion import cell_counts, weighted_metrics
from ..operators.linear import one_row_per_model
from ..operators.ranking import auc_exact
from ..schemas import (
    CONFUSION_MATRIX,
    LOGISTIC_REGRESSION,
    METRICS,
    PREDICTIONS,
    RANDOM_FOREST,
    TEST,
    TRAIN,
    TRAINED_ON,
)
from ..session import drop_folder, run_folder
from ..sources.tables import read_features, read_if_present, read_table, write_table

SCALED = "scaled_features"


def scaler() -> StandardScaler:
    """Division by the standard deviation, no centring, so sparse stays sparse."""
    return StandardScaler(inputCol="features", outputCol=SCALED, withStd=True, withMean=False)


def classifiers() -> dict[str, Estimator]:
    """The two models. Their hyperparameters."""
    columns = {"featuresCol": SCALED, "labelCol": "label"}
    return {
        LOGISTIC_REGRESSION: LogisticRegression(maxIter=100, regParam=0.01, elasticNetParam=0.8, **columns),
        RANDOM_FOREST: RandomForestClassifier(numTrees=50, maxDepth=10, seed=42, **columns),
    }


@dataclass(frozen=True)
class Fitted:
    model: PipelineModel
    seconds: float


def fit_models(
    train: DataFrame, estimators: dict[str, Estimator] | None = None, keep: StorageLevel | None = None
) -> dict[str, Fitted]:
    """Fit the scaler once and each classifier on its output; rows without label or features teach nothing.

    Both learners cache their own compact blocks between iterations, so scaled
    rows are read only about three times per model. ``keep`` holds them for those
    reads, where memory or local disks have room for twice the stored features.
    Only the classifier's fit is timed. The models come back without their training
    summaries.
    """
    rows = train.select("features", "label").dropna()
    scaling = scaler().fit(rows)
    scaled = scaling.transform(rows).select(SCALED, "label")
    if keep:
        scaled.persist(keep)
    fitted = {}
    for name, estimator in (estimators or classifiers()).items():
        start = time.perf_counter()
        model = estimator.fit(scaled)
        seconds = time.perf_counter() - start
        fitted[name] = Fitted(without_summary(PipelineModel([scaling, model])), seconds)
    if keep:
        scaled.unpersist()
    return fitted


def without_summary(model: PipelineModel) -> PipelineModel:
    """The model as it is when stored and loaded.

    A fitted classifier holds its training summary, that one the session, and Spark sends it all to the tasks that
    score. A session that has observed a write cannot be sent.
    """
    spark = SparkSession.active()
    folder = run_folder(spark, "fitted")
    save_model(model, folder)
    loaded = PipelineModel.load(folder)
    drop_folder(spark, folder)
    return loaded


class FeaturizerMismatch(ValueError):
    """The model was trained on another featurizer's vectors."""


def save_model(model: PipelineModel, path: str, featurizer: Featurizer | None = None) -> None:
    """Store scaler and classifier together, and which featurizer they belong to."""
    model.write().overwrite().save(path)
    if featurizer:
        spark = SparkSession.active()
        known = spark.createDataFrame([(featurizer.name, featurizer.width)], TRAINED_ON)
        write_table(known, f"{path}/featurizer")


def load_model(path: str, featurizer: Featurizer | None = None) -> PipelineModel:
    """Load a stored model; with ``featurizer``, fail unless it is the one trained on."""
    if featurizer:
        known = read_if_present(SparkSession.active(), f"{path}/featurizer", TRAINED_ON).first()
        if known and tuple(known) != (featurizer.name, featurizer.width):
            raise FeaturizerMismatch(f"trained on {tuple(known)}, not {(featurizer.name, featurizer.width)}")
    return PipelineModel.load(path)


def probabilities(rows: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """One column of P(FAKE) per model, ``p_<model>``, from a single scan of the features.

    Preparation stages that models share, such as the scaler, run once per row.
    """
    applied: set[str] = set()
    kept = list(rows.columns)
    for name, model in models.items():
        *preparation, classifier = model.stages
        for stage in preparation:
            if stage.uid not in applied:
                rows = stage.transform(rows.drop(stage.getOutputCol()))
                applied.add(stage.uid)
        fake = vector_to_array("probability")[1].alias(f"p_{name}")
        rows = classifier.transform(rows).select(*rows.columns, fake)
        kept.append(f"p_{name}")
    return rows.select(*kept)


def score_models(rows: DataFrame, models: dict[str, PipelineModel], threshold: float = 0.5) -> DataFrame:
    """Rows of the predictions table for every model; FAKE above the threshold."""
    wide = probabilities(rows, models).drop("features")
    if "label_name" not in wide.columns:
        wide = wide.withColumn("label_name", decode_label(F.col("label")))
    long = one_row_per_model(wide, {name: f"p_{name}" for name in models}, threshold)
    return long.select(*[c for c in PREDICTIONS.fieldNames() if c in long.columns])


def evaluation(predictions: DataFrame) -> DataFrame:
    """Confusion cells and exact ROC area of every model, in one aggregation."""
    return auc_exact(predictions, counts=cell_counts())


def metrics_of(totals: DataFrame, seconds: dict[str, float] | None = None) -> DataFrame:
    """The metrics table, one row per model with weighted metrics, from an evaluation."""
    pairs = [F.lit(x) for item in (seconds or {}).items() for x in item]
    took = F.try_element_at(F.create_map(*pairs), F.col("model")) if pairs else F.lit(None)
    return weighted_metrics(totals, by=("model", "auc_roc")).select(
        "model",
        "accuracy",
        F.col("precision_weighted").alias("precision"),
        F.col("recall_weighted").alias("recall"),
        F.col("f1_weighted").alias("f1_score"),
        "auc_roc",
        took.cast("double").alias("train_time_seconds"),
    )


def evaluate(predictions: DataFrame, seconds: dict[str, float] | None = None) -> DataFrame:
    """Predictions to the metrics table."""
    return metrics_of(evaluation(predictions), seconds)


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Importance of each feature of a forest: as many rows as the vector is wide."""
    importances = model.stages[-1].featureImportances.toArray()
    rows = [(i, float(x)) for i, x in enumerate(importances)]
    return spark.createDataFrame(rows, "dim int, importance double")


def run_training(
    spark: SparkSession, features_path: str, out: str, featurizer: Featurizer | None = None
) -> DataFrame:
    """Fit, store models, predictions, metrics and confusion matrix; return the metrics.

    Vectors are scored once and the stored predictions aggregated once; the result
    tables are projections of that aggregation. Nothing is held in memory between
    the steps.
    """
    features = read_features(spark, features_path)
    fitted = fit_models(features.where(F.col("split") == TRAIN))
    for name, one in fitted.items():
        save_model(one.model, f"{out}/models/{name}", featurizer)
    test = features.where(F.col("split") == TEST)
    write_table(
        score_models(test, {n: f.model for n, f in fitted.items()}),
        f"{out}/predictions",
        partition_by=("model",),
        whole_table=True,
    )
    write_table(evaluation(read_table(spark, f"{out}/predictions", PREDICTIONS)), f"{out}/evaluation")
    totals = read_table(spark, f"{out}/evaluation")
    write_table(metrics_of(totals, {n: f.seconds for n, f in fitted.items()}), f"{out}/metrics")
    write_table(totals.select(*CONFUSION_MATRIX.fieldNames()), f"{out}/confusion_matrix")
    return read_table(spark, f"{out}/metrics", METRICS)
