"""Quality: random Fourier features of document statistics, ridge scores, isotonic calibration.

Each text becomes some statistics. Cosines of random projections of them approximate a Gaussian
kernel; every partition adds up its share of the normal equations, and the sums meet in a tree. A
second fold calibrates the scores: ranks on a fixed grid are counted, and pooling adjacent violators
turns the counts into a rising curve. Nothing is sampled, and only sums reach the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sums import summed
from .work import ready, store


@dataclass(frozen=True)
class Settings:
    features: int = 256
    width: float = 2.5  # of the Gaussian kernel, in standard deviations of the statistics
    ridge: float = 1e-3
    grid: int = 4096
    seed: int = 1


STATISTICS = (
    "log_words", "word_length", "letters", "digits", "upper", "symbols", "spaces", "distinct_words", "same_as_last",
    "top_word", "top_pair", "line_words", "repeated_lines", "shouted_words", "decorated_words", "piped_words",
    "long_words", "sentence_ends", "joined_words", "short_lines",
)


def statistics(text: str | None) -> list[float]:
    """Shares and lengths of a whole text; an empty one has zeros."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    lines = [line for line in text.split("\n") if line.strip()]
    counts, pairs = Counter(words), Counter(zip(words, words[1:], strict=False))
    letters = digits = upper = spaces = 0
    for char, times in Counter(text).items():
        if char.isalpha():
            letters += times
            upper += times if char.isupper() else 0
        elif char.isdigit():
            digits += times
        elif char.isspace():
            spaces += times
    shouted = decorated = long = ends = joined = piped = 0
    for word, times in counts.items():
        core = word.strip(".,;:!?\"'()")
        plain = core.isalpha()
        shouted += times if len(core) > 1 and core.isupper() else 0
        decorated += times if not plain and core and not core[-1].isalnum() or len(word) - len(core) > 1 else 0
        joined += times if not plain and core else 0
        long += times if len(word) > 20 else 0
        ends += times if word[-1] in ".!?" else 0
        piped += times if word in ("|", "-", "*", "•") else 0
    same = sum(times for (a, b), times in pairs.items() if a == b)
    return [
        np.log1p(n), (size - spaces) / n, letters / size, digits / size, upper / size,
        1 - (letters + digits + spaces) / size, spaces / size, len(counts) / n, same / n,
        max(counts.values()) / n, max(pairs.values(), default=0) / n, np.log1p(n / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)), shouted / n, decorated / n, piped / n, long / n, ends / n, joined / n,
        sum(len(line) < 20 for line in lines) / max(1, len(lines)),
    ]


def with_statistics(documents: DataFrame, text: str, into: str) -> DataFrame:
    ready(documents)

    @F.pandas_udf("array<double>")
    def measured(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([statistics(t) for t in batch], dtype=object)

    return documents.withColumn(into, measured(text))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def lifted(self, statistics: np.ndarray) -> np.ndarray:
        """Random Fourier features of standardised statistics, and a constant."""
        inner = np.clip((statistics - self.mean) / self.scale, -8, 8) @ self.projection + self.shift
        return np.hstack([np.cos(inner) * np.sqrt(2 / len(self.shift)), np.ones((len(statistics), 1))])

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return self.lifted(statistics) @ self.weights

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(statistics), self.knots, self.levels)


def stacked(batch: pd.DataFrame, column: str) -> np.ndarray:
    return np.vstack(batch[column].to_numpy())


def isotonic(positives: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The rising curve nearest to positives / totals, weighted by totals: adjacent violators are pooled."""
    blocks: list[list[float]] = []
    for p, n in zip(positives, totals, strict=True):
        blocks.append([p, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.concatenate([np.full(int(k), p / n) for p, n, k in blocks])


def fit(rows: DataFrame, statistics: str, label: str, calibrate: Column, settings: Settings | None = None) -> Model:
    """``rows`` hold statistics and labels; those where ``calibrate`` holds shape the curve, the others the weights.

    Rows without a label of 0 or 1 are left out. Without any rows every text scores 0.5.
    """
    settings = settings or Settings()
    width = len(STATISTICS)
    rows = rows.where(F.col(label).isin(0, 1)).select(
        F.col(statistics).alias("x"), F.col(label).cast("double").alias("y"), calibrate.alias("late")
    )
    early, late = rows.where("not late"), rows.where("late")

    def moments(batch: pd.DataFrame) -> np.ndarray:
        x = stacked(batch, "x")
        return np.vstack([np.full(width, len(x)), x.sum(0), (x * x).sum(0)])

    rng = np.random.default_rng(settings.seed)
    projection = rng.normal(size=(width, settings.features)) / (settings.width * np.sqrt(width))
    shift = rng.uniform(0, 2 * np.pi, settings.features)
    flat = Model(np.zeros(width), np.ones(width), projection, shift, np.zeros(settings.features + 1), np.zeros(1),
                 np.full(1, 0.5))
    sums = summed(early, moments, ["x"])
    if sums is None:
        return flat
    mean = sums[1] / sums[0]
    scale = np.sqrt(np.maximum(sums[2] / sums[0] - mean**2, 1e-8))
    base = Model(mean, scale, projection, shift, flat.weights, flat.knots, flat.levels)

    def equations(batch: pd.DataFrame) -> np.ndarray:
        z = base.lifted(stacked(batch, "x"))
        return z.T @ np.hstack([z, batch[["y"]].to_numpy()])

    normal = summed(early, equations, ["x", "y"])
    gram = normal[:, :-1] + settings.ridge * sums[0, 0] * np.eye(settings.features + 1) / settings.features
    solved = Model(mean, scale, projection, shift, np.linalg.solve(gram, normal[:, -1]), flat.knots, flat.levels)
    edges = np.linspace(-0.5, 1.5, settings.grid)

    def counted(batch: pd.DataFrame) -> np.ndarray:
        at = np.searchsorted(edges, np.clip(solved.raw(stacked(batch, "x")), edges[0], edges[-1]))
        y = batch["y"].to_numpy()
        return np.vstack([np.bincount(at, y, settings.grid), np.bincount(at, minlength=settings.grid).astype(float)])

    tally = summed(late, counted, ["x", "y"])
    if tally is None:
        knots, levels = edges, np.clip(edges, 0, 1)
    else:
        seen = np.flatnonzero(tally[1])
        # one row of the mean label, spread over the grid, keeps the curve off 0 and 1
        share, prior = 1 / len(seen), tally[0].sum() / tally[1].sum()
        knots, levels = edges[seen], isotonic(tally[0][seen] + share * prior, tally[1][seen] + share)
    return Model(mean, scale, projection, shift, solved.weights, knots, levels)


def with_score(df: DataFrame, statistics: str, model: Model, into: str = "score") -> DataFrame:
    sent = ready(df).sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batch: pd.Series) -> pd.Series:
        return pd.Series(sent.value.score(np.vstack(batch.to_numpy())) if len(batch) else [], dtype="float64")

    return df.withColumn(into, score(statistics))


def measure(documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)):
    """Stored statistics of every text, so that fitting and scoring read each text once."""
    return store(with_statistics(documents.select(*keep, text), text, "statistics").drop(text), "quality")
