"""Mixing sources to target weights by budgets that run down a tree, such as domain, language, source.

Each node's budget is dealt to its children by weight. A child gets no more than its texts can give within
the allowed epochs, and what it cannot take goes to its siblings; only when all of them are full does the
node itself ask for less, so that its own siblings take over. Each leaf then takes whole epochs and the
first part of one more, in an order that seed and epoch shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import discard, store


@dataclass(frozen=True)
class Level:
    """A level of the tree: its name, the node a document belongs to, and the node's weight by that name."""

    name: str
    node: Column
    weight: Column


@dataclass(frozen=True)
class Settings:
    budget: float = 1.0  # of all tokens
    max_epochs: int = 2
    seed: str = "mix-1"


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def shuffled(key: str, settings: Settings, epoch: str = "__epochs") -> Column:
    """A document's place in an epoch's order, as text."""
    return F.md5(F.concat_ws("|", F.lit(settings.seed), F.col(epoch).cast("string"), F.col(key).cast("string")))


def budgets(leaves: DataFrame, levels: list[Level], settings: Settings) -> DataFrame:
    """The tree's leaves with the tokens each may give: columns of the levels, have, budget.

    Children are taken by capacity for their weight, smallest first. While those before one are full, the rest of
    the budget over the rest of the weights is a share; the largest share decides for all children.
    """
    names = [level.name for level in levels]
    parents = leaves.agg((F.sum("have") * F.lit(settings.budget)).alias("parent_budget"))
    for depth, level in enumerate(levels, 1):
        above = names[: depth - 1]
        nodes = leaves.groupBy(*names[:depth]).agg((F.sum("have") * settings.max_epochs).alias("cap"))
        nodes = nodes.withColumn("weight", level.weight.cast("double")).where("weight > 0")
        nodes = nodes.join(parents, above) if above else nodes.join(parents)
        order = Window.partitionBy(*above).orderBy(F.col("cap") / F.col("weight"), level.name)
        before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
        left = F.col("parent_budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
        nodes = nodes.withColumn("share", left / F.sum("weight").over(after))
        share = F.max("share").over(Window.partitionBy(*above))
        nodes = nodes.withColumn("budget", F.least(F.col("cap").cast("double"), F.col("weight") * share))
        parents = nodes.select(*names[:depth], F.col("budget").alias("parent_budget"))
    return leaves.join(parents.withColumnRenamed("parent_budget", "budget"), names)


def cuts(rows: DataFrame, planned: DataFrame, names: list[str], settings: Settings) -> DataFrame:
    """Each leaf with whole epochs and the last place, in the order of one more epoch, that fits its budget.

    Places are cut by their digits: sums over 256 parts tell in which part the budget ends, that part is cut again,
    and only what is left is summed row by row.
    """
    budget = F.floor("budget")
    leaves = planned.where("have > 0").withColumn("__epochs", F.floor(budget / F.col("have")).cast("int"))
    leaves = leaves.withColumn("rest", (budget - F.col("__epochs") * F.col("have")).cast("bigint"))
    at = leaves.withColumn("start", F.lit("")).withColumn("base", F.lit(0).cast("bigint"))
    for level in (0, 1):
        inside = rows.join(at, names).withColumn("place", shuffled("key", settings))
        inside = inside.where(F.col("place").startswith(F.col("start")))
        part = F.substring("place", 1, 2 * level + 2)
        sums = inside.groupBy(*names, "have", "__epochs", "rest", "base", part.alias("start")).agg(F.sum("tokens").alias("t"))
        run = F.sum("t").over(Window.partitionBy(*names).orderBy("start"))
        sums = sums.withColumn("end", F.col("base") + run).where(F.col("end") > F.col("rest"))
        first = F.row_number().over(Window.partitionBy(*names).orderBy("start"))
        at = sums.withColumn("first", first).where("first = 1").select(
            *names, "have", "__epochs", "rest", "start", (F.col("end") - F.col("t")).alias("base")
        )
    inside = rows.join(at, names).withColumn("place", shuffled("key", settings))
    inside = inside.where(F.col("place").startswith(F.col("start")))
    run = F.sum("tokens").over(Window.partitionBy(*names).orderBy("place"))
    fits = F.when(F.col("base") + run <= F.col("rest"), F.col("place"))
    last = inside.withColumn("fits", fits).groupBy(*names, "__epochs", "start").agg(F.max("fits").alias("fits"))
    return last.select(*names, "__epochs", F.coalesce("fits", "start").alias("__last"))


def mixed(documents: DataFrame, levels: list[Level], key: str = "doc_id", text: str = "text",
          settings: Settings | None = None, copies: str = "copies", count: str = "n_tokens") -> DataFrame:
    """The documents chosen, with the levels' columns, their tokens and how many copies to take.

    Documents of weightless nodes and of leaves without any token are not chosen; a null node counts as '?'. Rows
    of the same key stand at the same place, and are chosen together. No document gets more than max_epochs copies.
    """
    settings = settings or Settings()
    spark = documents.sparkSession
    names = [level.name for level in levels]
    own = documents.withColumns({x.name: F.coalesce(x.node, F.lit("?")) for x in levels})
    rows = store(own.select(*names, F.col(key).alias("key"), tokens(text).alias("tokens")), "mixing-rows")
    leaves = store(rows.rows.groupBy(*names).agg(F.sum("tokens").alias("have")), "mixing-leaves")
    planned = store(budgets(leaves.rows, levels, settings), "mixing-budgets")
    chosen = store(cuts(rows.rows, planned.rows, names, settings), "mixing-cuts")
    for path in (rows.path, leaves.path, planned.path):
        discard(spark, path)
    picked = own.join(chosen.rows, names).withColumn("__place", shuffled(key, settings))
    number = F.col("__epochs") + (F.col("__place") <= F.col("__last")).cast("int")
    picked = picked.withColumn(copies, number).where(F.col(copies) > 0)
    return picked.withColumn(count, tokens(text)).drop("__epochs", "__last", "__place")
