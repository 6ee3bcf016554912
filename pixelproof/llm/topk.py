"""Exact top-k inner products by columnar branch and bound.

Candidates lie in vertical layout. Products are added up one block of dimensions after another; after
each, a pair's sum plus the largest product that the norms of the remaining dimensions allow bounds its
final score. Pairs whose bound is below the k-th best score that is already certain for their query are
dropped, and the surviving ones are compacted.

Sums are made of doubles where they are exact, else of 64-bit integers where no sum can leave them, and pairs of
vectors with larger components are multiplied as whole numbers of any size. A score that does not fit 64 bits
raises an error.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks
from .work import store

DENSE = 1 / 64  # of a block's pairs


@dataclass(frozen=True)
class Settings:
    k: int = 20
    query_block: int = 512
    candidate_block: int = 2048
    steps: tuple[int, ...] = (16, 16)  # dimensions of the first blocks; the rest is the last one


def scaled(vectors: DataFrame, id_column: str, vector: str, factor: float) -> DataFrame:
    """Usable vectors of floor(factor * x), as doubles, which from 2^53 on are whole numbers anyway.

    A component that is no longer finite after scaling raises an error.
    """
    rows = blocks.usable(vectors, id_column, vector)

    def floored(x: Column) -> Column:
        y = x * factor
        beyond = F.raise_error(F.lit("a component is not finite after scaling")).cast("double")
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).when(F.abs(y) < float("inf"), y).otherwise(beyond)

    return rows.withColumn("v", F.transform("v", floored))


class Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), np.iinfo(np.int64).min)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    @staticmethod
    def part(best: Best, at: np.ndarray) -> Best:
        """Those of some queries, to be put back after."""
        out = Best(0, best.k)
        out.score, out.id = best.score[at], best.id[at]
        return out

    def certain(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merge pairs. Only those that can enter are sorted."""
        enter = score >= self.certain()[query]
        query, score, ids = query[enter], score[enter], ids[enter]
        if not len(query):
            return
        order = np.lexsort((ids, ~score, query))  # ~ turns the order round and cannot overflow
        query, score, ids = query[order], score[order], ids[order]
        starts = np.flatnonzero(np.diff(query, prepend=-1))
        for start, end in zip(starts, np.append(starts[1:], len(query)), strict=True):
            q, end = query[start], min(end, start + self.k)
            s, i = np.append(self.score[q], score[start:end]), np.append(self.id[q], ids[start:end])
            top = np.lexsort((i, ~s))[: self.k]
            self.score[q], self.id[q] = s[top], i[top]

    def rows(self, query_ids: np.ndarray) -> pd.DataFrame:
        q, j = np.nonzero(self.id != np.iinfo(np.int64).max)
        return pd.DataFrame({"query_id": query_ids[q], "vec_id": self.id[q, j], "score": self.score[q, j]})


def search(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, best: Best, steps: tuple[int, ...]) -> None:
    """Products of every query and candidate that can still be among a query's best. q and c: dimension by row."""
    # vectors beyond this may have sums of 2^62 and more
    most = (2.0**62 / max(1, len(q))) ** 0.5
    large_q, large_c = (np.abs(m).max(0, initial=0) > most for m in (q, c))
    if large_q.any() or large_c.any():
        of_any_size(q, q_ids, c, c_ids, best, large_q, large_c)
    small = np.flatnonzero(~large_q)
    if len(small) < len(q_ids):
        part = Best.part(best, small)
        bounded(q[:, small], q_ids[small], c[:, ~large_c], c_ids[~large_c], part, steps)
        best.score[small], best.id[small] = part.score, part.id
    else:
        bounded(q, q_ids, c[:, ~large_c] if large_c.any() else c, c_ids[~large_c], best, steps)


def of_any_size(q, q_ids, c, c_ids, best: Best, large_q: np.ndarray, large_c: np.ndarray) -> None:
    """All pairs with a large vector on one side, or both, as whole numbers of Python's."""
    whole = [[int(x) for x in column] for column in c.T]
    for i, column in enumerate(q.T):
        own = [int(x) for x in column]
        with_ = np.arange(len(c_ids)) if large_q[i] else np.flatnonzero(large_c)
        with_ = with_[c_ids[with_] != q_ids[i]]
        scores = [sum(map(operator.mul, own, whole[j])) for j in with_.tolist()]
        if any(not -(2**63) <= x < 2**63 for x in scores):
            raise OverflowError(f"a score of vector {q_ids[i]} does not fit 64 bits")
        best.add(np.full(len(with_), i), np.array(scores, np.int64), c_ids[with_])


def bounded(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, best: Best, steps: tuple[int, ...]) -> None:
    """The same by branch and bound, for vectors whose sums fit 64 bits."""
    dim = len(q)
    ends = [min(dim, int(e)) for e in np.cumsum(steps)] + [dim]
    # doubles are exact up to 2^53
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * dim < 2**53
    if not exact:
        q, c = q.astype(np.int64), c.astype(np.int64)

    def rest(m: np.ndarray, start: int) -> np.ndarray:
        return np.sqrt((m[start:].astype(np.float64) ** 2).sum(0))

    def possible(sums: np.ndarray, rest_q: np.ndarray, rest_c: np.ndarray, sure: np.ndarray) -> np.ndarray:
        gain = rest_q * rest_c
        # a rounded bound may fall short of the true one by a few parts in 2^50
        error = 1e-12 * (max(sums.max(initial=0), -sums.min(initial=0)) + gain.max(initial=0)) + 1e-6
        return sums + gain >= sure - error

    sure = best.certain().astype(np.float64)
    alive = q_ids[:, None] != c_ids[None, :]
    sums = np.zeros(alive.shape, q.dtype)
    at = 0
    # while many are left, the products of all pairs take less time than those of the pairs that are left
    for start, end in zip([0, *ends], ends, strict=False):
        if at and alive.sum() <= DENSE * alive.size:
            break
        sums += q[start:end].T @ c[start:end]
        alive &= possible(sums, rest(q, end)[:, None], rest(c, end), sure[:, None])
        at = end
    if at == dim and len(c_ids) > best.k and alive.sum() > 2 * best.k * len(q_ids):
        known = np.where(alive, sums, -np.inf if exact else np.iinfo(np.int64).min)
        alive &= sums >= np.partition(known, -best.k, 1)[:, -best.k, None]  # the k-th best of this block
    at_q, at_c = np.nonzero(alive)
    sums = sums[at_q, at_c]
    for start, end in zip([0, *ends], ends, strict=False):
        if start < at or start == end:
            continue
        for piece in range(start, end):
            sums = sums + q[piece, at_q] * c[piece, at_c]
        live = possible(sums, rest(q, end)[at_q], rest(c, end)[at_c], sure[at_q])
        at_q, at_c, sums = at_q[live], at_c[live], sums[live]
    best.add(at_q, np.rint(sums).astype(np.int64) if exact else sums, c_ids[at_c])


def top_k(rows: DataFrame, queries: DataFrame, settings: Settings | None = None) -> DataFrame:
    """For each query its k best candidates: query_id, rank, vec_id, score.

    Both sides have columns id and v, whole numbers as doubles. A query's own id is no candidate; an id that
    comes twice among the queries counts once, by its smaller vector. Vectors of another length than the
    query's are not compared with it. Ties go to smaller ids. Empty tables give no rows.
    """
    settings = settings or Settings()
    queries = queries.groupBy("id").agg(F.min("v").alias("v"))
    q_blocks = store(blocks.packed(queries, settings.query_block), "topk-queries").rows
    c_blocks = store(blocks.packed(rows, settings.candidate_block), "topk-rows").rows

    def searched(asked: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = [Best(0, settings.k).rows(np.empty(0, np.int64))]
        for block in asked.itertuples():
            q, own = blocks.matrix(block.vectors, block.dim, block.ids), blocks.ids(block.ids)
            best = Best(len(own), settings.k)
            for row in candidates.itertuples():
                c, c_ids = blocks.matrix(row.vectors, row.dim, row.ids), blocks.ids(row.ids)
                # a few columns first, so that a threshold is certain before the others are bounded
                for start, end in ((0, 256), (256, len(c_ids))):
                    search(q, own, c[:, start:end], c_ids[start:end], best, settings.steps)
            found.append(best.rows(own))
        return pd.concat(found)

    found = blocks.met(q_blocks, c_blocks, settings.k, searched, "query_id long, vec_id long, score long")
    return blocks.best(found, settings.k, F.col("score").desc())
