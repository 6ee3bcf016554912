"""Array and vector helpers that stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F


def to_vector(features: str | Column) -> Column:
    """Array to ML vector; null stays null instead of failing the task."""
    column = F.col(features) if isinstance(features, str) else features
    return F.when(column.isNotNull(), array_to_vector(column.cast("array<double>")))


def dot(features: Column, weights: Sequence[float]) -> Column:
    """Inner product with fixed weights, summed in double; another width fails, null stays null."""
    fixed = F.array(*[F.lit(float(w)) for w in weights])
    products = F.zip_with(features, fixed, lambda x, w: x.cast("double") * w)
    total = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    wrong = F.raise_error(F.concat(F.lit(f"expected {len(weights)} features, got "), F.size(features).cast("string")))
    fits = features.isNull() | (F.size(features) == len(weights))
    return F.when(fits, total).otherwise(wrong.cast("double"))


def is_zero_vector(features: Column) -> Column:
    return F.forall(features, lambda x: x == 0)
