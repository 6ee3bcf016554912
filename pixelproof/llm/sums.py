"""Sums of arrays over all partitions of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .work import ready


def added(one: list[np.ndarray], other: list[np.ndarray]) -> list[np.ndarray]:
    """The sum of two arrays, either of which may be missing; whole numbers of few bits become wide."""
    if not (one and other):
        return one or other
    return [np.add(one[0], other[0], dtype=np.float64 if one[0].dtype.kind == "f" else np.int64)]


def summed(
    df: DataFrame,
    function: Callable[[pd.DataFrame], np.ndarray],
    columns: list[str],
    sent: Callable[[np.ndarray], np.ndarray] = lambda total: total,
) -> np.ndarray | None:
    """The sum of the arrays that ``function`` makes of batches; partial sums meet in a tree. None without rows.

    ``sent`` may make a partition's sum smaller before it travels.
    """
    ready(df)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                one = function(batch)
                total = one if total is None else total + one
        if total is not None:
            total = sent(total)
            yield pd.DataFrame({"sum": [total.tobytes()], "shape": [list(total.shape)], "dtype": [total.dtype.str]})

    parts = df.select(*columns).mapInPandas(part, "sum binary, shape array<int>, dtype string").rdd
    arrays = parts.map(lambda r: [np.frombuffer(bytes(r["sum"]), r["dtype"]).reshape(r["shape"])])
    total = arrays.treeAggregate([], added, added, 3)
    return total[0] if total else None
