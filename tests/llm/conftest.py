"""Small tables for the text operators."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

#: Other columns whose names operators may use inside, and one that is like a result's.
DOCUMENTS = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())]
    + [StructField(name, StringType()) for name in ("source", "id", "score", "component", "n")]
    + [StructField("n_chars", LongType())]
)
LABELS = StructType([StructField(n, t) for n, t in (("doc_id", LongType()), ("quality", IntegerType()), ("toxic", IntegerType()))])

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def prose(seed: int, words: int = 60) -> str:
    """Text that differs from seed to seed in all its word sequences."""
    return " ".join(WORDS[(seed * 7 + i * (i + seed)) % len(WORDS)] + str((seed * 31 + i * i) % 97) for i in range(words))


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [
            (r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s1")), "x", "y", "z", "w", len(r[1] or "")) for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls, empty and very long texts, ties and repeated rows."""
    return documents([
        (1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, prose(1)), (5, prose(1)), (6, prose(1)), (None, prose(1)),
        (7, prose(2, 30_000)), (8, "x" * 200_000), (9, prose(3), None, None), (10, "Ünïcödé ▁ 😀 日本語\u0000\n" * 3),
    ])


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
