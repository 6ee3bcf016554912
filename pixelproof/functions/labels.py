"""Labels, answers and display text as column expressions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FAKE, LABEL_CODES, REAL


def encode_label(name: Column) -> Column:
    """REAL to 0, FAKE to 1, anything else to null."""
    return F.when(name == REAL, LABEL_CODES[REAL]).when(name == FAKE, LABEL_CODES[FAKE])


def decode_label(code: Column) -> Column:
    """0 to REAL, 1 to FAKE; no answer and any other code have no name."""
    return F.when(code == LABEL_CODES[REAL], REAL).when(code == LABEL_CODES[FAKE], FAKE)


def is_correct(label: Column, prediction: Column) -> Column:
    return label == prediction


def error_kind(label: Column, prediction: Column) -> Column:
    """false_positive for REAL taken as FAKE, false_negative for the reverse, else null."""
    return F.when((label == 0) & (prediction == 1), "false_positive").when(
        (label == 1) & (prediction == 0), "false_negative"
    )


def fake_probability(probability: Column) -> Column:
    """Percent P(FAKE) out of a class probability vector; null when there is none."""
    return F.when(probability.isNotNull(), vector_to_array(probability)[1] * 100)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def percent_text(value: Column, scale: float = 1.0) -> Column:
    """Two decimals and a percent sign; ``scale`` 100 turns a ratio into percent."""
    number = F.round(value * F.lit(float(scale)), 2)
    return F.when(number.isNotNull(), F.format_string("%.2f%%", number))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))
