"""Approximate nearest neighbours by robust-pruned directed graphs, one graph for each shard.

Equal vectors are one node, so a vector held by many rows is indexed once. Nodes are dealt to shards of a
bounded size. In a shard, points join the graph in batches: a greedy search proposes neighbours, and the
pruning keeps a neighbour unless one that is already kept lies closer to it by a factor. Queries visit
every shard with a beam search; what the beams hold is scored exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks
from .work import ready, store


@dataclass(frozen=True)
class Settings:
    k: int = 10
    shard: int = 4096  # nodes in a shard, about
    degree: int = 24
    slack: int = 8  # links beyond the degree before a node is pruned again
    beam: int = 48  # while building
    query_beam: int = 96
    alpha: float = 1.2
    batch: int = 512
    query_block: int = 512
    seed: int = 7


class Graph:
    """Links of a shard's vectors; -1 fills the rest of a row."""

    def __init__(self, vectors: np.ndarray, links: np.ndarray, entry: int):
        self.x = vectors.astype(np.float32)
        self.norm = (self.x**2).sum(1)
        self.links, self.entry = links, entry

    def search(self, q: np.ndarray, beam: int, wide: int = 3) -> tuple[np.ndarray, np.ndarray]:
        """For each query the nodes of its beam, nearest first, and their squared distances (-1, inf: none)."""
        n = len(q)
        q = q.astype(np.float32)
        q_norm = (q**2).sum(1)
        ids = np.full((n, beam), -1, np.int64)
        dist = np.full((n, beam), np.inf, np.float32)
        done = np.zeros((n, beam), bool)
        seen = np.zeros((n, len(self.x)), bool)
        ids[:, 0], seen[:, self.entry] = self.entry, True
        dist[:, 0] = self.norm[self.entry] + q_norm - 2 * q @ self.x[self.entry]
        active = np.arange(n)
        while len(active):
            open_dist = np.where(done[active] | (ids[active] < 0), np.inf, dist[active])
            pick = np.argsort(open_dist, 1)[:, :wide]
            at = np.arange(len(active))[:, None]
            valid = np.isfinite(open_dist[at, pick])
            go = valid[:, 0]
            active, pick, valid = active[go], pick[go], valid[go]
            if not len(active):
                break
            at = active[:, None]
            done[at, pick] |= valid
            near = np.where(valid[:, :, None], self.links[ids[at, pick]], -1).reshape(len(active), -1)
            near = np.sort(near, 1)
            fresh = (near >= 0) & ~seen[at, near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            rows, cols = np.nonzero(fresh)
            seen[active[rows], near[rows, cols]] = True
            width = int(fresh.sum(1).max(initial=0))
            if not width:
                continue
            # fresh neighbours move to the left, so that the merge is as narrow as it can be
            slot = (np.cumsum(fresh, 1) - 1)[rows, cols]
            new_ids = np.full((len(active), width), -1, np.int64)
            new_dist = np.full((len(active), width), np.inf, np.float32)
            found = near[rows, cols]
            new_ids[rows, slot] = found
            owner = active[rows]
            new_dist[rows, slot] = self.norm[found] + q_norm[owner] - 2 * np.einsum("ij,ij->i", self.x[found], q[owner])
            all_ids = np.concatenate([ids[active], new_ids], 1)
            all_dist = np.concatenate([dist[active], new_dist], 1)
            all_done = np.concatenate([done[active], np.zeros_like(new_ids, bool)], 1)
            order = np.argsort(all_dist, 1, kind="stable")[:, :beam]
            at = np.arange(len(active))[:, None]
            ids[active], dist[active], done[active] = all_ids[at, order], all_dist[at, order], all_done[at, order]
        return ids, dist

    def pruned(self, ids: np.ndarray, dist: np.ndarray, degree: int, alpha: float) -> np.ndarray:
        """For each row of candidates, nearest first, up to ``degree`` that lie in different directions."""
        v = self.x[ids]
        gaps = self.norm[ids][:, :, None] + self.norm[ids][:, None, :] - 2 * v @ v.transpose(0, 2, 1)
        alive = (ids >= 0) & np.isfinite(dist)
        rows = np.arange(len(ids))
        out = np.full((len(ids), degree), -1, np.int64)
        for slot in range(degree):
            first = alive.argmax(1)
            some = alive[rows, first]
            if not some.any():
                break
            out[some, slot] = ids[rows, first][some]
            alive &= alpha * alpha * gaps[rows, first] > dist
            alive[rows, first] = False
        return out

    def link(self, points: np.ndarray, chosen: np.ndarray, degree: int, alpha: float) -> None:
        """Set the links of ``points`` and add the links back, pruning nodes that have too many."""
        self.links[points] = -1
        self.links[points, : chosen.shape[1]] = chosen
        rows, cols = np.nonzero(chosen >= 0)
        target, source = chosen[rows, cols], points[rows]
        gap = ((self.x[target] - self.x[source]) ** 2).sum(1)
        order = np.lexsort((gap, target))
        target, source = target[order], source[order]
        starts = np.flatnonzero(np.diff(target, prepend=-1))
        counts = np.diff(np.append(starts, len(target)))
        place = np.arange(len(target)) - np.repeat(starts, counts)
        most = 2 * degree  # of a batch's links to one node the nearest, twice as many as it can keep
        keep = place < most
        nodes = target[starts]
        wide = np.full((len(nodes), most), -1, np.int64)
        wide[np.repeat(np.arange(len(nodes)), counts)[keep], place[keep]] = source[keep]
        have = self.links[nodes]
        used = (have >= 0).sum(1)
        fits = used + np.minimum(counts, most) <= have.shape[1]
        for row in np.flatnonzero(fits):
            count = min(counts[row], most)
            self.links[nodes[row], used[row] : used[row] + count] = wide[row, :count]
        full = np.flatnonzero(~fits)
        for start in range(0, len(full), 256):
            part = full[start : start + 256]
            ids = np.concatenate([have[part], wide[part]], 1)
            dist = ((self.x[ids] - self.x[nodes[part]][:, None]) ** 2).sum(2)
            dist[ids < 0] = np.inf
            order = np.argsort(dist, 1)
            at = np.arange(len(part))[:, None]
            new = self.pruned(ids[at, order], dist[at, order], degree, alpha)
            self.links[nodes[part]] = -1
            self.links[nodes[part], :degree] = new


def built(vectors: np.ndarray, settings: Settings) -> Graph:
    n = len(vectors)
    rng = np.random.default_rng(settings.seed)
    middle = int(((vectors - vectors.mean(0)) ** 2).sum(1).argmin())
    graph = Graph(vectors, np.full((n, settings.degree + settings.slack), -1, np.int64), middle)
    order = rng.permutation(n)
    order = np.concatenate([[middle], order[order != middle]])
    at = 1
    while at < n:
        points = order[at : at + max(1, min(settings.batch, at // 4))]
        ids, dist = graph.search(graph.x[points], settings.beam)
        graph.link(points, graph.pruned(ids, dist, settings.degree, settings.alpha), settings.degree, settings.alpha)
        at += len(points)
    return graph


def nodes_of(rows: DataFrame, k: int) -> DataFrame:
    """One row for each distinct vector: v, its smallest id, and its k + 1 smallest ids.

    Ties go to smaller ids, so no answer of k rows can hold others of the same vector.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    first = rows.withColumn("_place", place).where(F.col("_place") <= k + 1)
    return first.groupBy("v").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("members"))


def indexed(rows: DataFrame, settings: Settings) -> DataFrame:
    """One row for each shard: dim, ids and vectors in vertical layout, links, entry, members; stored."""
    ready(rows)
    stored = store(nodes_of(rows, settings.k), "ann-nodes")
    nodes = stored.rows
    shards = max(1, -(-nodes.count() // settings.shard))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        vectors = np.vstack(group["v"].to_numpy())
        graph = built(vectors, settings)
        members = group["members"].to_numpy()
        return pd.DataFrame({
            "dim": [vectors.shape[1]],
            "ids": [group["id"].to_numpy(np.int64).tobytes()],
            "vectors": [blocks.data(vectors)],
            "links": [graph.links.astype(np.int32).tobytes()],
            "entry": [graph.entry],
            "sizes": [np.array([len(m) for m in members], np.int64).tobytes()],
            "members": [np.concatenate(members).astype(np.int64).tobytes()],
        })

    dealt = nodes.select(
        "id", "v", "members", F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard")
    )
    graphs = dealt.groupBy("dim", "shard").applyInPandas(
        build, f"{blocks.PACKED}, links binary, entry int, sizes binary, members binary"
    )
    index = store(graphs, "ann-index").rows
    stored.discard()
    return index


def searched(rows: DataFrame, queries: DataFrame, settings: Settings | None = None) -> DataFrame:
    """For each query its k nearest found: query_id, rank, vec_id, score (Euclidean distance).

    Both sides have columns id and v. A query's own id is no candidate; an id that comes twice among the queries
    counts once, by its smaller vector. Vectors of another length are not compared. Empty tables give no rows.
    """
    settings = settings or Settings()
    shards = indexed(rows, settings)
    q = blocks.packed(queries.groupBy("id").agg(F.min("v").alias("v")), settings.query_block)

    def near(asked: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = [NONE] * len(asked)
        for row in candidates.itertuples():
            x = blocks.matrix(row.vectors, row.dim, row.ids).T
            links = np.frombuffer(row.links, np.int32).reshape(len(x), -1).astype(np.int64)
            graph = Graph(x, links, row.entry)
            sizes = np.frombuffer(row.sizes, np.int64)
            starts, members = np.cumsum(sizes) - sizes, blocks.ids(row.members)
            for i, block in enumerate(asked.itertuples()):
                own = blocks.matrix(block.vectors, block.dim, block.ids).T
                more = answers(graph, x, starts, sizes, members, own, blocks.ids(block.ids), settings)
                found[i] = nearest(pd.concat([found[i], more]) if len(found[i]) else more, settings.k)
        return pd.concat(found or [NONE])

    found = blocks.met(store(q, "ann-queries").rows, shards, settings.k, near, "query_id long, vec_id long, score double")
    return blocks.best(found, settings.k, F.col("score").asc())


#: No answers.
NONE = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})


def nearest(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k first rows of each query."""
    return found.sort_values(["query_id", "score", "vec_id"]).groupby("query_id", sort=False).head(k)


def answers(graph: Graph, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray, members: np.ndarray, q: np.ndarray,
            q_ids: np.ndarray, settings: Settings) -> pd.DataFrame:
    """What the beams of a block of queries hold, scored on the original vectors; k rows for each query."""
    ids, _ = graph.search(q, settings.query_beam)
    rows, cols = np.nonzero(ids >= 0)
    node = ids[rows, cols]
    score = np.sqrt(((x[node] - q[rows]) ** 2).sum(1))
    order = np.lexsort((members[starts[node]], score, rows))
    rows, node, score = rows[order], node[order], score[order]
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
    near = place <= settings.k
    rows, node, score = rows[near], node[near], score[near]
    each = sizes[node]
    flat = np.repeat(starts[node] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    out = pd.DataFrame({
        "query_id": np.repeat(q_ids[rows], each), "vec_id": members[flat], "score": np.repeat(score, each)
    })
    return nearest(out[out["query_id"] != out["vec_id"]], settings.k)
