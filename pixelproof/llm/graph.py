"""Connected components of links that are never gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import Stored, store


def components(links: DataFrame) -> Stored:
    """Each node of the links (a, b) with the smallest node it can reach: columns node, component.

    Large stars and small stars take turns: a node's larger neighbours are tied to its smallest neighbour, then its
    smaller ones are. The links stay as many as the nodes, and end as one star for each component. Smallest
    neighbours are found by aggregation, and tied by a join that Spark splits for nodes of very many links.
    """
    now = store(oriented(links), "links")
    mark = marked(now.rows)
    while True:
        large = star(now.rows.unionAll(now.rows.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        tied = store(large, "links")
        after = store(star(tied.rows, larger=False), "links")
        tied.discard()
        now.discard()
        now, last, mark = after, mark, marked(after.rows)
        if mark == last:
            break
    roots = now.rows.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    out = store(now.rows.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots), "components")
    now.discard()
    return out


def marked(links: DataFrame) -> tuple:
    """What tells one set of distinct links from another: their number and 128 bits of hashes."""
    one, two = F.xxhash64("a", "b"), F.xxhash64("b", "a", F.lit(1))
    return tuple(links.agg(F.count("*"), F.bit_xor(one), F.bit_xor(two)).first())


def oriented(links: DataFrame) -> DataFrame:
    """Distinct links from the larger node a to the smaller node b; nulls and loops are left out."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def star(links: DataFrame, larger: bool) -> DataFrame:
    """Links (node a, neighbour b): ties neighbours, larger or smaller than the node, to the smallest one around."""
    smallest = links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    joined = links.join(smallest, "a")
    tied = joined.where("b > a" if larger else "b < a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not larger:
        tied = tied.unionAll(smallest.select("a", F.col("least").alias("b")))
    return oriented(tied)
