"""Vectors packed into blocks, and the grid of query blocks against candidate blocks.

A block is a bounded number of vectors in one row. Each query block meets each candidate block once:
both sides carry the coordinates of a cell of the grid and are shuffled to it, dealt evenly, whatever the
vectors look like. Nothing is broadcast, so the driver holds no blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import ready

PACKED = "dim int, ids binary, vectors binary"
CELLS = 64  # of a grid at least, or four for each core
CELL = 64 << 20  # bytes of either side of a cell, about
KINDS = {np.dtype(kind).itemsize: kind for kind in (np.int8, np.int16, np.float32, np.float64)}


def usable(vectors: DataFrame, id_column: str, vector: str, zero: bool = True) -> DataFrame:
    """Rows (id, v) of finite, non-empty vectors as doubles; ``zero=False`` leaves vectors of zeros out too."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
    return rows if zero else rows.where(F.exists(v, lambda x: x != 0))


def packed(rows: DataFrame, rows_per_block: int) -> DataFrame:
    """Blocks of at most so many vectors of one length, in vertical layout: all first components, then all second."""
    ready(rows)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def block(dim: int) -> pd.DataFrame:
            got = held.pop(dim)
            ids = np.array([i for i, _ in got], np.int64)
            return pd.DataFrame({"dim": [dim], "ids": [ids.tobytes()], "vectors": [data(np.array([v for _, v in got]))]})

        for batch in batches:
            for i, v in zip(batch["id"], batch["v"], strict=True):
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) == rows_per_block:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)

    return rows.select("id", "v").mapInPandas(pack, PACKED)


def numbered(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks with an evenly dealt number."""
    return blocks.withColumn(name, F.xxhash64("ids"))


def measured(blocks: DataFrame) -> tuple[int, int, int]:
    """How many blocks, how many vectors in them, and their bytes."""
    size = sum((F.length(name) for name, kind in blocks.dtypes if kind == "binary"), F.lit(0))
    n, vectors, total = blocks.agg(F.count("*"), F.sum(F.length("ids") / 8), F.sum(size)).first()
    return n, int(vectors or 0), int(total or 0)


def shape(queries: DataFrame, candidates: DataFrame, k: int) -> tuple[int, int]:
    """Query groups and candidate groups, so that what travels is about the least for that many cells.

    Candidates travel once for each query group; queries, and k answers of 24 bytes for each, once for each
    candidate group. A group has no more than about ``CELL`` bytes.
    """
    cells = max(CELLS, 4 * queries.sparkSession.sparkContext.defaultParallelism)
    q_blocks, asked, q_size = measured(queries)
    c_blocks, _, c_size = measured(candidates)
    rows = min(cells, round(math.sqrt(cells * (q_size + 24 * k * asked) / max(1, c_size))))
    rows = max(1, min(q_blocks, max(rows, -(-q_size // CELL))))
    return rows, max(1, min(c_blocks, max(-(-cells // rows), -(-c_size // CELL))))


def met(
    queries: DataFrame, candidates: DataFrame, k: int, function: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], answers: str
) -> DataFrame:
    """What ``function`` makes of the query blocks and the candidate blocks of each cell, at most k rows for a query.

    Query blocks are copied to every candidate group and candidate blocks to every query group. A join may not do
    this: Spark judges the copies by the size of the stored blocks, and broadcasts all of them.
    """
    rows, columns = shape(queries, candidates, k)
    keys = ["dim", "row", "column"]

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))

    q = numbered(queries, "n").withColumn("row", F.pmod("n", F.lit(rows))).withColumn("column", each(columns)).drop("n")
    c = numbered(candidates, "n").withColumn("column", F.pmod("n", F.lit(columns))).withColumn("row", each(rows)).drop("n")
    q, c = (side.repartition(rows * columns, *keys).groupBy(*keys) for side in (q, c))
    return q.cogroup(c).applyInPandas(function, answers)


def data(vectors: np.ndarray) -> bytes:
    """Vectors, one a row, in vertical layout, by the smallest type that holds each component exactly."""
    for kind in KINDS.values():
        with np.errstate(over="ignore", invalid="ignore"):
            small = vectors.astype(kind)
        if (small == vectors).all():
            break
    return np.ascontiguousarray(small.T).tobytes()


def matrix(vectors: bytes, dim: int, ids: bytes) -> np.ndarray:
    """Components by vectors, as doubles."""
    kind = KINDS[len(vectors) * 8 // (dim * len(ids))]
    return np.frombuffer(vectors, kind).reshape(dim, -1).astype(np.float64)


def ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def best(found: DataFrame, k: int, order: Column) -> DataFrame:
    """Each query's k first rows by ``order``, ties to smaller ids: query_id, rank, vec_id, score."""
    from pyspark.sql import Window

    window = Window.partitionBy("query_id").orderBy(order, F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
