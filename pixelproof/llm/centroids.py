"""Centroid clustering of integer vectors with Spark's own expressions.

Vectors become whole numbers, so every distance and every sum is exact. A round is one pass over the vectors:
``zip_with`` and ``aggregate`` give the squared distance to each centroid of a constant array, ``array_min`` of
(distance, number) takes the nearest, ties to the smaller number, and sums of columns by cluster, combined before
they are shuffled, give the next centroids. Only k sums of a vector's width reach the driver.

Vectors of another width, and those that are null or hold null or a component that is not finite, take no part.
Repeated rows count as often as they stand there; a vector without an id takes part but is the last to be a first
centroid. With fewer vectors than clusters there are fewer clusters; an empty table gives no rows. Components
beyond the range of 64 bits, and distances or sums beyond it, raise an error (Spark's ANSI mode), never a wrong
number. The whole numbers are stored once for all rounds, the answer of the last round once for both its uses.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import store

Centroid = tuple[int, ...]


def whole(df: DataFrame, id_column: str, vector: str, width: int, factor: float) -> DataFrame:
    """(id, v): the vectors that take part, with floor(factor * x) for each component x."""
    fits = (F.size(vector) == width) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )

    def floored(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * factor)
        beyond = F.raise_error(F.lit("a component does not fit 64 bits after scaling")).cast("long")
        return F.when(F.abs(x.cast("double") * factor) < 2.0**63, scaled).otherwise(beyond)

    return df.where(F.coalesce(fits, F.lit(False))).select(
        F.col(id_column).alias("id"), F.transform(vector, floored).alias("v")
    )


def first_centroids(rows: DataFrame, k: int, seed: str) -> list[Centroid]:
    """The k vectors with the smallest SHA-256 of ``seed:id``; ties go by the vector."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.select("v", place.alias("place")).orderBy(F.col("place").asc_nulls_last(), "v").limit(k)
    return [tuple(r["v"]) for r in first.collect()]


def constant(centroids: list[Centroid]) -> Column:
    arrays = ", ".join(f"array({', '.join(f'{x}L' if x > -(2**63) else 'bigint(-9223372036854775808)' for x in c)})" for c in centroids)
    return F.expr(f"array({arrays})")


def nearest(vector: str, centroids: list[Centroid]) -> Column:
    """struct<distance, cluster> of the nearest centroid."""

    def distance(c: Column) -> Column:
        squares = F.zip_with(vector, c, lambda x, y: (x - y) * (x - y))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x)

    each = F.transform(constant(centroids), lambda c, i: F.struct(distance(c).alias("distance"), i.alias("cluster")))
    return F.array_min(each)


def moved(rows: DataFrame, centroids: list[Centroid]) -> list[Centroid]:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays."""
    width = len(centroids[0])
    near = rows.select(nearest("v", centroids)["cluster"].alias("cluster"), *[F.col("v")[i].alias(f"v{i}") for i in range(width)])
    sums = near.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(width)])
    out = list(centroids)
    for r in sums.collect():  # k rows at most
        out[r["cluster"]] = tuple(r[f"v{i}"] // r["n"] for i in range(width))
    return out


def digest(centroid: Centroid) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clustered(
    df: DataFrame, id_column: str, vector: str, *, width: int, factor: float, k: int, rounds: int, seed: str
) -> tuple[DataFrame, list[Centroid]]:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector, and the centroids."""
    # work is long for its bytes, so a round should not have as few tasks as the table has splits
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    stored = store(whole(df, id_column, vector, width, factor).repartition(tasks), "whole-vectors")
    rows = stored.rows
    centroids = first_centroids(rows, k, seed)
    if not centroids:
        empty = "id, int(0) AS cluster, bigint(0) AS distance, bigint(0) AS cluster_inertia, bigint(0) AS inertia, '' AS centroid_sha256"
        return rows.selectExpr(*empty.split(", ")), []
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    near = store(rows.select("id", nearest("v", centroids).alias("near")).select("id", "near.*"), "clusters").rows
    stored.discard()
    totals = {r["cluster"]: r["n"] for r in near.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    inertia = sum(totals.values())
    if inertia >= 2**63:
        raise OverflowError("the inertia does not fit 64 bits")

    def of_cluster(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)

    return near.select(
        "id",
        "cluster",
        "distance",
        of_cluster([totals.get(i, 0) for i in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(inertia).cast("long").alias("inertia"),
        of_cluster([digest(c) for c in centroids]).alias("centroid_sha256"),
    ), centroids
