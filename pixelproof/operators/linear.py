"""A linear model as plain column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot


@dataclass(frozen=True)
class LinearScorer:
    """Fixed weights: adds fake_probability (0 to 1) and prediction to rows with float arrays."""

    weights: tuple[float, ...]
    intercept: float = 0.0
    threshold: float = 0.5

    def probability(self, features: Column) -> Column:
        return 1 / (1 + F.exp(-(dot(features, self.weights) + self.intercept)))

    def transform(self, rows: DataFrame, features: str = "features") -> DataFrame:
        scored = rows.withColumn("fake_probability", self.probability(F.col(features)))
        return with_prediction(scored, self.threshold)

    def scaled(self, std: list[float]) -> LinearScorer:
        """The same model for features not yet divided by ``std``; a constant feature gets 0."""
        weights = tuple(w / s if s else 0.0 for w, s in zip(self.weights, std, strict=True))
        return LinearScorer(weights, self.intercept, self.threshold)


def answer(score: Column, threshold: float) -> Column:
    """1 above the threshold, else 0; null for a score that is null or not a number."""
    return F.when(~F.isnan(score), (score > threshold).cast("double"))


def with_prediction(rows: DataFrame, threshold: float = 0.5, score: str = "fake_probability") -> DataFrame:
    return rows.withColumn("prediction", answer(F.col(score), threshold))


def one_row_per_model(wide: DataFrame, scores: dict[str, str], threshold: float = 0.5) -> DataFrame:
    """Turn one probability column per model into one row per model, after a single scan."""
    pairs = F.array(
        *[F.struct(F.lit(model).alias("model"), F.col(c).alias("fake_probability")) for model, c in scores.items()]
    )
    kept = [c for c in wide.columns if c not in scores.values()]
    return with_prediction(wide.select(*kept, F.inline(pairs)), threshold)
