"""Table layouts and the fixed names every job shares."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Class names, their codes, folder names and model names.
REAL, FAKE = "REAL", "FAKE"
LABEL_CODES = {REAL: 0, FAKE: 1}
TRAIN, TEST = "train", "test"
LOGISTIC_REGRESSION, RANDOM_FOREST = "LogisticRegression", "RandomForest"
MODELS = (LOGISTIC_REGRESSION, RANDOM_FOREST)
FEATURE_WIDTH = 1280


def _table(**columns) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


# Features at rest keep float32 arrays: half the bytes of an ML vector of doubles.
FEATURES = _table(
    path=StringType(),
    features=ArrayType(FloatType()),
    error=StringType(),
    label=IntegerType(),
    label_name=StringType(),
    split=StringType(),
)

# The log of the file versions a features table was made of.
FILE_VERSIONS = _table(path=StringType(), length=LongType(), modificationTime=TimestampType(), run=LongType())

PREDICTIONS = _table(
    model=StringType(),
    path=StringType(),
    label=IntegerType(),
    label_name=StringType(),
    prediction=DoubleType(),
    fake_probability=DoubleType(),
)

METRICS = _table(
    model=StringType(),
    accuracy=DoubleType(),
    precision=DoubleType(),
    recall=DoubleType(),
    f1_score=DoubleType(),
    auc_roc=DoubleType(),
    train_time_seconds=DoubleType(),
)

CONFUSION_MATRIX = _table(
    model=StringType(),
    true_positive=LongType(),
    true_negative=LongType(),
    false_positive=LongType(),
    false_negative=LongType(),
)


INFERENCE_SAMPLE = _table(
    path=StringType(),
    actual_label=StringType(),
    predicted_label=StringType(),
    prediction=DoubleType(),
)

NEW_PREDICTIONS = _table(
    path=StringType(),
    prediction=DoubleType(),
    result=StringType(),
    confidence=DoubleType(),
)

NEW_PREDICTIONS_CSV = _table(path=StringType(), result=StringType(), confidence=DoubleType())

TRAINED_ON = _table(name=StringType(), width=IntegerType())
