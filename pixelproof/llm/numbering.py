"""Places of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import store


def numbered(rows: DataFrame, group: list[str], order: list[str], place: str, purpose: str) -> DataFrame:
    """The rows with their place in their group, from 1, in ascending order with nulls first.

    Ranges of (group, order) are sorted apart and stored with the number of their range, so a group may be larger
    than a task: places count on from the rows of the group in earlier ranges. Rows that agree in the whole order
    get places in any order. A group goes on from an earlier range only at the head of a range, so what is joined
    back has at most one row for each range.
    """
    part, before = "__part", "__before"
    ranges = rows.repartitionByRange(*group, *order).withColumn(part, F.spark_partition_id())
    stored = store(ranges, purpose).rows
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(*group, part).agg(F.count("*").alias("__n"))
    offsets = counts.withColumn(before, F.sum("__n").over(earlier)).where(F.col(before) > 0).drop("__n")
    own = Window.partitionBy(part, *group).orderBy(*order)
    placed = stored.withColumn(place, F.row_number().over(own).cast("long"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (part, *group)]
    joined = placed.alias("a").join(F.broadcast(offsets).alias("b"), same, "left")
    return joined.select(
        *[F.col(f"a.{c}") for c in rows.columns], (F.col(place) + F.coalesce(F.col(f"b.{before}"), F.lit(0))).alias(place)
    )
