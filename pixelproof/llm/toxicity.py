"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A bounded sample of labelled rows is dealt to shards of a fixed size. Each shard runs the online
learner from the current state with a learning rate of its own for every coordinate; the states are
averaged between rounds. The L1 term leaves few weights, which travel to all tasks as one small array.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import WORD, hashes, mixed
from .work import ready, store


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the sample: so many labelled rows of each class are learned from at most."""

    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.1
    shard: int = 2048  # rows that one task learns from, about
    rounds: int = 3
    per_class: int = 4096
    seed: int = 8


def features(text: str | None, bits: int) -> np.ndarray:
    """Distinct slots of a text's words, word pairs and pairs with one or two words between them."""
    h = hashes(WORD.findall((text or "").lower()))
    parts = [mixed(h, 1), *(mixed(h[:-gap] + mixed(h[gap:], 7), gap + 1) for gap in (1, 2, 3) if len(h) > gap)]
    return np.unique((np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int32))


class Learner:
    """FTRL-proximal state; slot ``2**bits`` is the intercept, which has no L1 term."""

    def __init__(self, settings: Settings, z: np.ndarray | None = None, n: np.ndarray | None = None):
        size = (1 << settings.bits) + 1
        self.s = settings
        self.z = np.zeros(size, np.float32) if z is None else z.copy()
        self.n = np.zeros(size, np.float32) if n is None else n.copy()

    def weights(self, slots: np.ndarray | slice) -> np.ndarray:
        z, n, s = self.z[slots], self.n[slots], self.s
        w = (np.sign(z) * s.l1 - z) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
        return np.where(np.abs(z) <= s.l1, 0, w)

    def learn(self, slots: np.ndarray, label: int) -> None:
        slots = np.append(slots, self.z.size - 1)
        w = self.weights(slots)
        w[-1] = -self.z[-1] / ((self.s.beta + np.sqrt(self.n[-1])) / self.s.alpha)
        g = probability(w.sum()) - label
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[slots] = n + g * g

    def compact(self) -> tuple[np.ndarray, np.ndarray, float]:
        w = self.weights(slice(0, self.z.size - 1))
        slots = np.flatnonzero(w)
        intercept = -self.z[-1] / ((self.s.beta + np.sqrt(self.n[-1])) / self.s.alpha)
        return slots.astype(np.int32), w[slots].astype(np.float32), float(intercept)


def probability(score: float) -> float:
    return 1 / (1 + np.exp(-np.clip(score, -35, 35)))


def sample(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, settings: Settings) -> DataFrame:
    """Labelled rows, ``per_class`` of each class at most, first by seeded hash: columns label, order, text.

    A key labelled twice counts once, by its largest label; labels other than 0 and 1 are left out.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).cast("int").alias("_label"))
        .withColumn("_order", F.xxhash64(F.lit(settings.seed), "_key"))
    )
    # the bound makes this side small whatever the corpus is: 2 * per_class rows of three numbers
    picked = [known.where(F.col("_label") == c).orderBy("_order", "_key").limit(settings.per_class) for c in (0, 1)]
    own = documents.select(F.col(key).alias("_id"), F.col(text).alias("text"))
    return own.join(F.broadcast(picked[0].unionAll(picked[1])), F.col("_id") == F.col("_key")).select(
        F.col("_label").alias("label"),
        F.col("_order").alias("order"),
        F.col("text"),
    )


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        settings: Settings | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Slots, weights and intercept. Without labelled rows there are no weights and every text scores 0.5."""
    settings = settings or Settings()
    spark = ready(documents)

    @F.pandas_udf("array<int>")
    def slots(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([features(t, settings.bits) for t in batch], dtype=object)

    rows = store(
        sample(documents, labels, key, text, label, settings).select("label", "order", slots("text").alias("slots")),
        "toxicity-sample",
    )
    shards = max(1, -(-rows.rows.count() // settings.shard))
    dealt = rows.rows.withColumn("shard", F.pmod("order", F.lit(shards)))
    learner = Learner(settings)
    for number in range(settings.rounds):
        state = spark.sparkContext.broadcast((learner.z, learner.n))
        done = dealt.groupBy("shard").applyInPandas(round_of(state, number, settings), "z binary, n binary")
        z, n, count = np.zeros_like(learner.z), np.zeros_like(learner.n), 0
        for row in done.toLocalIterator():
            z, n, count = z + np.frombuffer(row["z"], np.float32), n + np.frombuffer(row["n"], np.float32), count + 1
        state.unpersist()
        if not count:
            break
        learner = Learner(settings, z / count, n / count)
    rows.discard()
    return learner.compact()


def round_of(state: Broadcast, number: int, settings: Settings):
    """One shard's pass over its rows, in an order that the round seeds."""

    def trained(group: pd.DataFrame) -> pd.DataFrame:
        own = Learner(settings, *state.value)
        group = group.sort_values(["order", "label"])
        for i in np.random.default_rng(settings.seed + number).permutation(len(group)):
            own.learn(np.asarray(group["slots"].iloc[i]), int(group["label"].iloc[i]))
        return pd.DataFrame({"z": [own.z.tobytes()], "n": [own.n.tobytes()]})

    return trained


def scorer(documents: DataFrame, model: tuple[np.ndarray, np.ndarray, float], settings: Settings | None = None):
    """A column function from text to the probability of label 1; null and empty texts get the intercept's."""
    settings = settings or Settings()
    slots, weights, intercept = model
    sent = ready(documents).sparkContext.broadcast((slots, weights))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(1 << settings.bits, np.float32)
        dense[sent.value[0]] = sent.value[1]
        for batch in texts:
            yield pd.Series(
                [float(probability(dense[features(t, settings.bits)].sum(dtype=np.float64) + intercept)) for t in batch],
                dtype="float64",
            )

    return score


def predicted(score: Column, threshold: float = 0.7) -> Column:
    return (score >= threshold).cast("int")
