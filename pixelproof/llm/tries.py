"""Prefix trie of conversations, with sums over subtrees made band by band.

Only hashes travel: a turn is a 128-bit hash of role and text, and a prefix the combination (XOR) of the hashes of
its turns with their depths, so that prefixes of any length can be put together from pieces. Two prefixes of the
same depth are one node if these 128 bits agree.

Depths are cut into bands of ``band`` turns. Within a band, a window over one conversation and one band gives the
prefixes and the path from the band's root, so no window sees more than ``band`` rows, however long a conversation
is. Sums go up in the same bands: a node adds its value to its ancestors down from its band's root, at most
``band`` + 1 rows; the sums of whole bands belong to the band roots, which form a trie of their own with depths
``band`` times smaller, rolled up in the same way first; then each band root hands its finished total to its
ancestors in the band above. So a trie of depth d takes log(d) / log(band) rounds, and a node becomes ``band`` + 1
rows at most.

A turn without a conversation id belongs to none; null roles and texts are empty; turns without a number come
first, and turns of the same number go by the MD5 of their role and text. Repeated turns are turns. An empty table
has no conversations and no nodes. Any other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered
from .work import ready, store

KEY = ["depth", "k1", "k2"]
#: Ids of one list that are put into one string before they are hashed.
IDS = 4096


def halves(digest: Column) -> list[Column]:
    """The 128 bits of an MD5 as two longs."""
    return [F.conv(F.substring(digest, start, 16), 16, -10).cast("long") for start in (1, 17)]


def turn_hash(role: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text))


def placed_turns(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, place, hash, bytes): the turns of each conversation, numbered from 1."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    turns = df.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).alias("c"), F.col(turn).alias("turn"), turn_hash(role, text).alias("hash"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return numbered(turns, ["c"], ["turn", "hash"], "place", "turns").drop("turn")


def rebuilt(turns: DataFrame, lender: Column, borrowed: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one: (c, length) and (c, depth, hash, bytes).

    ``lender`` and ``borrowed`` are expressions of c: the first ``borrowed`` turns, ``most`` at most, come from
    ``lender``, the rest are those of c behind as many turns of its own. What a conversation is joined to is one row
    for each piece of ``IDS`` turns, so a long conversation does not meet in one task.
    """
    lengths = turns.groupBy("c").agg(F.max("place").alias("own"))
    whole = lengths.select("c", "own", lender.alias("from"), borrowed.cast("long").alias("h"))
    lent = lengths.select(F.col("c").alias("from"), F.col("own").alias("theirs"))
    known = whole.join(lent, "from", "left").withColumn("got", F.least("h", F.coalesce("theirs", F.lit(0))))
    known = store(known.select("c", "from", "h", "own", "got"), "conversations").rows
    lengths = known.select("c", (F.col("got") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))

    piece = F.floor((F.col("place") - 1) / IDS)
    pieces = known.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("own") - 1) / IDS))))
    kept = turns.withColumn("piece", piece).join(pieces.select("c", "piece", "h", "got"), ["c", "piece"])
    kept = kept.where("place > h").select("c", (F.col("place") - F.col("h") + F.col("got")).alias("depth"), "hash", "bytes")
    heads = turns.where(F.col("place") <= most).withColumnRenamed("c", "from")
    first = known.where("got > 0").select("c", "from", "got").join(heads, "from").where("place <= got")
    return lengths, first.select("c", F.col("place").alias("depth"), "hash", "bytes").unionByName(kept)


def prefixes(rows: DataFrame, band: int, deepest: int) -> list[DataFrame]:
    """(c, depth, k1, k2, path) of (c, depth, x1, x2), then the same of band roots, of roots of their bands, …

    ``depth`` counts from 1 on each level. ``path`` holds the prefixes from the band's root down to the row's own.
    """
    of_band = F.floor((F.col("depth") - 1) / band)
    rows = rows.withColumn("b", of_band)
    levels: list[DataFrame] = []
    if deepest > band:
        # whole bands only: a band that a conversation does not fill has no root below it
        roots = rows.groupBy("c", "b").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.count("*").alias("n"))
        roots = roots.where(F.col("n") == band).select("c", (F.col("b") + 1).alias("depth"), "x1", "x2")
        first, *more = prefixes(store(roots, "bands").rows, band, deepest // band)
        levels = [store(first, "band-roots").rows, *more]
        above = levels[0].select("c", F.col("depth").alias("b"), F.col("k1").alias("s1"), F.col("k2").alias("s2"))
        rows = rows.join(above, ["c", "b"], "left")
    else:
        rows = rows.withColumns({"s1": F.lit(None).cast("long"), "s2": F.lit(None).cast("long")})
    so_far = Window.partitionBy("c", "b").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    start = [F.coalesce(s, F.lit(0)) for s in ("s1", "s2")]
    keys = rows.withColumns({f"k{i}": F.bit_xor(f"x{i}").over(so_far).bitwiseXOR(start[i - 1]) for i in (1, 2)})
    path = F.concat(
        F.array(F.struct(start[0].alias("k1"), start[1].alias("k2"))), F.collect_list(F.struct("k1", "k2")).over(so_far)
    )
    return [keys.withColumn("path", path).drop("b", "s1", "s2", "x1", "x2"), *levels]


def rolled(levels: list[DataFrame], sums: list[str], band: int) -> DataFrame:
    """(depth, k1, k2) with the ``sums`` over each node's subtree.

    ``levels[0]`` has all nodes with path and values; the path of the trie's root is the root alone. The levels
    above have the band roots but the trie's own, with their paths.
    """
    nodes, *above = levels
    add = [F.sum(s).alias(s) for s in sums]
    if not above:
        return nodes.select(_steps(band).alias("at"), *sums).select("at.*", *sums).groupBy(*KEY).agg(*add)

    # what a band root's own band adds up to, the band root itself included
    is_root = F.col("depth") % band == 0
    own = F.struct(F.floor(F.col("depth") / band).alias("depth"), "k1", "k2")
    top = F.struct(F.floor((F.col("depth") - 1) / band).alias("depth"), F.col("path")[0]["k1"].alias("k1"), F.col("path")[0]["k2"].alias("k2"))
    of_bands = nodes.select(F.when(is_root, own).otherwise(top).alias("at"), *sums).select("at.*", *sums).groupBy(*KEY).agg(*add)
    paths = above[0].unionByName(nodes.where("depth = 0").select(*KEY, "path"))
    finished = store(rolled([paths.join(of_bands, KEY), *above[1:]], sums, band), "totals").rows

    # each band root hands its total to the band above it; all others add their own
    totals = finished.withColumn("depth", F.col("depth") * band)
    roots = nodes.where(is_root).drop(*sums).join(totals, KEY)
    handed = roots.where("depth > 0").select(_steps(band, last=False).alias("at"), *sums)
    inner = nodes.where(~is_root).select(_steps(band).alias("at"), *sums)
    # a band root's total is known already: what its band adds again is left out
    others = handed.unionByName(inner).select("at.*", *sums).where(F.col("depth") % band != 0)
    return others.groupBy(*KEY).agg(*add).unionByName(totals.select(*KEY, *sums))


def _steps(band: int, last: bool = True) -> Column:
    """Explodes a path into the (depth, k1, k2) of its nodes."""
    top = F.when(F.col("depth") == 0, 0).otherwise(F.floor((F.col("depth") - 1) / band) * band)
    path = F.col("path") if last else F.slice("path", 1, F.size("path") - 1)
    return F.explode(F.transform(path, lambda k, i: F.struct((top + i).alias("depth"), k["k1"].alias("k1"), k["k2"].alias("k2"))))


def list_hashes(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, sha): SHA-256 of the ids that end at a node, ascending, with commas between them.

    Ids are put together by ``IDS``; only nodes with more of them than that are hashed piece by piece, in a sorted
    stream that holds one piece at a time: this hash cannot be made of parts.
    """
    ready(ends)
    places = numbered(ends, KEY, ["c"], "place", "ends")
    pieces = places.groupBy(*KEY, F.floor((F.col("place") - 1) / IDS).alias("piece")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string"))).alias("ids")
    )
    pieces = store(pieces, "end-pieces").rows
    large = pieces.where("piece > 0").select(*KEY).distinct()
    short = pieces.join(large, KEY, "left_anti").select(*KEY, F.sha2("ids", 256).alias("sha"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for batch in batches:
            done = []
            for *key, ids in batch.itertuples(index=False):
                if key == at:
                    state.update(b"," + ids.encode())
                    continue
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = key, hashlib.sha256(ids.encode())
            if done:
                yield pd.DataFrame(done, columns=[*KEY, "sha"])
        if at is not None:
            yield pd.DataFrame([(*at, state.hexdigest())], columns=[*KEY, "sha"])

    long = pieces.join(large, KEY, "left_semi").repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")
    return short.unionByName(long.mapInPandas(hashed, "depth long, k1 long, k2 long, sha string"))


def trie(
    df: DataFrame, conversation: str, turn: str, role: str, text: str, *, lender: Column, borrowed: Column, most: int, band: int = 16
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: the columns of the query ``op12_prefix_trie``."""
    lengths, turns = rebuilt(placed_turns(df, conversation, turn, role, text), lender, borrowed, most)
    x = F.md5(F.concat_ws(":", F.col("depth").cast("string"), "hash"))
    hashed = turns.select("c", "depth", "bytes", *[h.alias(f"x{i + 1}") for i, h in enumerate(halves(x))])
    hashed = store(hashed, "rebuilt").rows
    deepest = hashed.agg(F.max("depth")).first()[0] or 0
    below, *bands = prefixes(hashed, band, deepest)
    root = lengths.select(
        "c", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"),
        *[F.lit(0).cast("long").alias(k) for k in ("k1", "k2")],
        F.array(F.struct(*[F.lit(0).cast("long").alias(k) for k in ("k1", "k2")])).alias("path"),
    )
    members = store(below.unionByName(root), "members").rows
    nodes = members.groupBy(*KEY).agg(
        F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.first("path").alias("path")
    )
    parent = F.get("path", F.size("path") - 2)
    nodes = store(nodes.withColumns({"p1": parent["k1"], "p2": parent["k2"]}), "nodes").rows
    above = [store(level.groupBy(*KEY).agg(F.first("path").alias("path")), "band-nodes").rows for level in bands]

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), KEY, "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    values = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}
    nodes = store(nodes.withColumns(values), "families").rows
    totals = rolled([nodes.select(*KEY, "path", *values), *above], list(values), band)

    ends = lengths.select("c", F.col("length").alias("depth")).join(members.select("c", *KEY), ["c", "depth"])
    named = with_parents(nodes.select(*KEY, "p1", "p2", "conv_id", "n_convs", "n_children"))
    out = named.join(totals, KEY).join(list_hashes(ends.select(*KEY, "c")), KEY, "left")
    no_ends = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *values, F.coalesce("sha", no_ends).alias("ends_sha256")
    )


def with_parents(nodes: DataFrame, most: int = 1024) -> DataFrame:
    """The nodes with their parent's conv_id.

    A parent with many children would be one key of a join. Fewer than ``most`` parents can have more than the
    ``most``-th part of all nodes as children, so these are few enough to be broadcast at any size; the rest is shuffled.
    """
    on = ["depth", "p1", "p2"]
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    bound = nodes.count() / most
    many = parents.where(F.col("n_children") > bound).drop("n_children")
    few = parents.where(F.col("n_children") <= bound).drop("n_children")
    first = nodes.join(F.broadcast(many), on, "left")
    known = F.col("depth").eqNullSafe(0) | F.col("parent_conv_id").isNotNull()
    return first.where(known).unionByName(first.where(~known).drop("parent_conv_id").join(few, on))
