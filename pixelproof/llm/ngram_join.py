"""N-gram Jaccard join: which documents share enough of their shingles, and the groups that links make.

Equal sets are one node. Every node has a token bitmap, as long as its size asks for (a power of two, one to two
bits a token), so that it tells unlike sets of any size apart; two sets share no more tokens than the common bits of
their bitmaps, plus the tokens that fell on a bit already taken. Sets that can link are of the same length or of
neighbouring ones; the longer bitmap is then folded.

1. Sets that agree on a minimum hash are held against one of them. This costs one comparison a set, however
   many there are, and ties nearly all near copies together.
2. For what may link different groups, tokens are put in one order, rare ones first by a sketch of fixed size.
   Sets that are similar enough share one of the first tokens. The sets of a token form a forest of signature
   trees, one for each length of bitmaps and the next, whose nodes hold OR-combined bitmaps and size ranges; pairs
   of nodes are traversed, and dropped when the overlap they can have at most is too small. Tokens of very many sets are cut into cells of two parts.
   A pair is listed for a token only if it could be the first, in that order, that both have: what both share then
   lies from there on. Sets that differ in rare tokens begin with those, so few unlike pairs are listed.

   A first round takes few pairs and joins most groups, a second one all pairs between the groups that are left.

What remains is compared exactly, so every link between two groups is found, whatever the order and the hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from xxhash import xxh3_128_digest

from . import graph
from .text import mixed, shingles
from .work import Stored, give_back, ready, store

SMALL_TABLE = 8 << 20  # bytes of a written table that may be sent to all tasks; larger ones are joined by shuffling


@dataclass(frozen=True)
class Settings:
    percent: int = 80  # of the union that two sets have to share
    hashes: int = 8
    bitmap: int = 256  # bits at least
    sketch: int = 1 << 20  # counters
    cell: int = 256  # sets of a part
    leaf: int = 8
    ordered: bool = True  # the first tokens come in the common order, from the first token of all on


def checked(spark, table: Stored) -> DataFrame:
    """The table, to be broadcast if its files are small; Spark joins it by shuffling otherwise."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table.path)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return F.broadcast(table.rows) if size <= SMALL_TABLE else table.rows


def first_tokens(tokens: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The tokens, in the common order, of which two sets that are similar enough share at least one."""
    slots = (tokens >> np.uint64(20)).astype(np.int64) & (len(rank) - 1)
    order = np.lexsort((tokens, rank[slots]))
    return tokens[order[: len(tokens) - -(-percent * len(tokens) // 100) + 1]]


def bits_for(n: int, least: int) -> int:
    return max(least, 1 << max(0, n - 1).bit_length())


def bitmap_of(tokens: np.ndarray, least: int) -> np.ndarray:
    """A bitmap of at least ``least`` bits, and of one to two for each token."""
    bits = bits_for(len(tokens), least)
    out = np.zeros(bits, np.uint8)
    out[(mixed(tokens, 3) >> np.uint64(32)).astype(np.int64) % bits] = 1
    return np.packbits(out)


COUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def stacked(bitmaps: list[bytes], size: int) -> np.ndarray:
    """Rows of ``size`` bytes, of bitmaps that are that long or twice as long: those are folded."""
    out = np.empty((len(bitmaps), size), np.uint8)
    for row, one in enumerate(bitmaps):
        whole = np.frombuffer(one, np.uint8)
        out[row] = whole if len(whole) == size else whole[:size] | whole[size:]
    return out


TOGETHER = 1 << 20  # bytes of bitmaps that are looked at together


def overlap(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common bits of rows i and j of bitmaps."""
    out = np.empty(len(i), np.int64)
    if bits.shape[1] % 8 == 0:
        bits = np.ascontiguousarray(bits).view(np.uint64)
    step = max(1, TOGETHER // bits[:1].nbytes) if len(bits) else 1
    for start in range(0, len(i), step):
        some = slice(start, start + step)
        out[some] = np.bitwise_count(bits[i[some]] & bits[j[some]]).sum(1, dtype=np.int64)
    return out


@dataclass
class Tree:
    """A signature tree over sets: levels from leaves of single sets up to one root."""

    bits: list[np.ndarray]
    low: list[np.ndarray]  # smallest size below
    high: list[np.ndarray]
    spare: list[np.ndarray]  # most tokens below that fell on a bit already taken
    fan: int

    @classmethod
    def over(cls, bits: np.ndarray, sizes: np.ndarray, fan: int) -> Tree:
        spare = sizes - COUNT[bits].sum(1, dtype=np.int64)
        tree = cls([bits], [sizes], [sizes], [spare], fan)
        while len(tree.low[-1]) > 1:
            starts = np.arange(0, len(tree.low[-1]), fan)
            tree.bits.append(np.bitwise_or.reduceat(tree.bits[-1], starts))
            tree.low.append(np.minimum.reduceat(tree.low[-1], starts))
            tree.high.append(np.maximum.reduceat(tree.high[-1], starts))
            tree.spare.append(np.maximum.reduceat(tree.spare[-1], starts))
        return tree

    def possible(self, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Whether a set below node i and one below node j can be similar enough."""
        low, high, spare = self.low[level], self.high[level], self.spare[level]
        ok = (100 * high[i] >= percent * low[j]) & (100 * high[j] >= percent * low[i])
        most = overlap(self.bits[level], i, j) + np.minimum(spare[i], spare[j])
        most = np.minimum(most, np.minimum(high[i], high[j]))
        # share / (a + b - share) >= percent / 100
        return ok & ((100 + percent) * most >= percent * (low[i] + low[j]))

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of sets, i < j, that a traversal of the tree against itself does not rule out."""
        i = j = np.zeros(1, np.int64)
        for level in range(len(self.low) - 2, -1, -1):
            n = len(self.low[level])
            step = np.arange(self.fan)
            a = (i[:, None, None] * self.fan + step[None, :, None]) + np.zeros((1, 1, self.fan), np.int64)
            b = (j[:, None, None] * self.fan + step[None, None, :]) + np.zeros((1, self.fan, 1), np.int64)
            a, b = a.ravel(), b.ravel()
            keep = (a < n) & (b < n) & ((a < b) if level == 0 else (a <= b))
            i, j = a[keep], b[keep]
            keep = self.possible(level, i, j, percent)
            i, j = i[keep], j[keep]
        return (i, j) if len(self.low) > 1 else (i[:0], j[:0])


def counted(documents: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """Each document's id, size of its set, and the set's name; a document without words has no name.

    A partition adds one row that holds nothing but a sketch: how often its tokens fall on each of the counters,
    up to 255, which tells common tokens from rare ones as well.
    """
    ready(documents)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(settings.sketch, np.int64)
        for batch in batches:
            sets = [shingles(t) for t in batch["t"].to_pylist()]
            slots = (np.concatenate([*sets, np.empty(0, np.uint64)]) >> np.uint64(20)).astype(np.int64) & (settings.sketch - 1)
            np.add.at(total, slots, 1)
            names = [xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.nulls(len(sets), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["id"].cast(pa.int64()), *columns], COUNTED.names)
        if total.any():
            few = np.minimum(total, 255).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_pylist([{"sketch": few}], COUNTED)
        give_back()

    rows = documents.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t"))
    return rows.mapInArrow(measured, "id bigint, n bigint, name binary, sketch binary")


COUNTED = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("name", pa.binary()), ("sketch", pa.binary())])
MEET = 32  # sketches that are added in one task


def common(counted: DataFrame, settings: Settings) -> np.ndarray:
    """How common tokens are: a logarithm of counts in a sketch of fixed size, over all documents.

    The sketches meet in a tree.
    """

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(settings.sketch, np.int64)
        for batch in batches:
            for sketch in batch["sketch"]:
                part = np.frombuffer(sketch.as_buffer(), np.uint8)
                total += part if len(part) == settings.sketch else part.view(np.int64)
        if total.any():
            yield pa.RecordBatch.from_pydict({"sketch": [total.tobytes()]}, pa.schema([("sketch", pa.binary())]))

    sketches = counted.where("sketch is not null").select("sketch")
    left = sketches.count()
    while left > 1:
        left = -(-left // MEET)
        sketches = sketches.repartition(left).mapInArrow(added, "sketch binary")
    one = sketches.first()
    total = np.zeros(settings.sketch, np.int64)
    if one:
        sketch = bytes(one["sketch"])
        total = np.frombuffer(sketch, np.uint8 if len(sketch) == settings.sketch else np.int64)
    return np.minimum(255, 8 * np.log2(1 + total.astype(np.float64))).astype(np.uint8)


def frequencies(documents: DataFrame, text: str, settings: Settings) -> np.ndarray:
    """The same for documents that were not counted before."""
    return common(counted(documents.withColumn("__none", F.lit(None)), "__none", text, settings), settings)


def signatures(documents: DataFrame, key: str, text: str, nodes: DataFrame, rank: np.ndarray, settings: Settings):
    """For each text of a node: id, n, minimum hashes, first tokens, bitmap."""
    sent = ready(documents).sparkContext.broadcast(rank)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch["t"].to_pylist()]
            hashes = [[mixed(tokens, 100 + i).min() for i in range(settings.hashes)] for tokens in sets]
            first = [first_tokens(tokens, sent.value, settings.percent) for tokens in sets]
            bits = [bitmap_of(tokens, settings.bitmap).tobytes() for tokens in sets]
            columns = [pa.array([len(tokens) for tokens in sets], pa.int64()), lists(hashes), lists(first), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["id"], *columns], ["id", "n", "hashes", "first", "bits"])

    made = owners(documents, key, text, nodes).select("id", "t")
    return made.mapInArrow(signed, "id bigint, n bigint, hashes array<bigint>, first array<bigint>, bits binary")


def lists(arrays: list, kind: type = np.uint64) -> pa.ListArray:
    """A column of arrays of whole numbers; those without sign keep their bits."""
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)]).astype(np.int32)
    values = np.concatenate([np.empty(0, kind), *[np.asarray(a, kind) for a in arrays]])
    return pa.ListArray.from_arrays(ends, values.view(np.int64) if kind is np.uint64 else values)


def owners(documents: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """The text of each node: any document of the node's id whose text is not empty of words."""
    rows = documents.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t"))
    return rows.where(F.col("t").rlike(r"[^\x20\x09-\x0D]")).join(nodes, "id")


@F.pandas_udf(BinaryType())
def packed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The sorted hashes of each text's shingles."""
    for batch in texts:
        yield pd.Series([shingles(t).tobytes() for t in batch], dtype=object)


def compared(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], percent: int) -> Stored:
    """The pairs (a, b) that are links, by their whole sets. ``texts`` gives columns id and t for wanted ids."""
    spark = ready(pairs)
    pairs = store(pairs, "join-pairs")
    wanted = pairs.rows.select(F.col("a").alias("id")).unionAll(pairs.rows.select(F.col("b").alias("id"))).distinct()
    wanted = store(wanted, "join-wanted")
    sets = store(texts(checked(spark, wanted)).select("id", packed("t").alias("set")), "join-sets")

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    one = sets.rows.select(F.col("id").alias("a"), F.col("set").alias("x"))
    two = sets.rows.select(F.col("id").alias("b"), F.col("set").alias("y"))
    links = store(pairs.rows.join(one, "a").join(two, "b").where(linked("x", "y")).select("a", "b"), "join-links")
    for table in (pairs, wanted, sets):
        table.discard()
    return links


def hash_heads(signed: DataFrame) -> DataFrame:
    """The smallest id (b) of the sets that agree on a minimum hash (its place i, and h), where two or more do."""
    hashes = signed.select("id", F.posexplode("hashes").alias("i", "h"))
    heads = hashes.groupBy("i", "h").agg(F.min("id").alias("b"), F.count("*").alias("m")).where("m > 1").drop("m")
    return checked(signed.sparkSession, store(heads, "join-heads"))


def near_copies(signed: DataFrame, settings: Settings, heads: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of a set and the smallest id with the same minimum hash, if their bitmaps allow a link."""
    hashes = signed.select("id", F.posexplode("hashes").alias("i", "h"))
    heads = hash_heads(signed) if heads is None else heads
    pairs = hashes.join(heads, ["i", "h"]).where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    one = signed.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("x"))
    two = signed.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("y"))

    @F.pandas_udf("boolean")
    def possible(n: pd.Series, x: pd.Series, m: pd.Series, y: pd.Series) -> pd.Series:
        n, m, x, y = n.to_numpy(np.int64), m.to_numpy(np.int64), x.tolist(), y.tolist()
        out = np.zeros(len(n), bool)
        lengths = np.array([(len(p), len(q)) for p, q in zip(x, y, strict=True)], np.int64).reshape(-1, 2)
        for size in np.unique(lengths.min(1)).tolist():
            # bitmaps more than one step apart belong to sets that cannot link
            at = np.flatnonzero((lengths.min(1) == size) & (lengths.max(1) <= 2 * size))
            bits = stacked([b for i in at.tolist() for b in (x[i], y[i])], size)
            tree = Tree.over(bits, np.column_stack([n[at], m[at]]).ravel(), 2)
            i = np.arange(0, 2 * len(at), 2)
            if len(at):
                out[at] = tree.possible(0, i, i + 1, settings.percent)
        return pd.Series(out)

    return pairs.join(one, "a").join(two, "b").where(possible("n_a", "x", "n_b", "y")).select("a", "b")


def in_groups(signed: DataFrame, groups: Stored) -> DataFrame:
    """The sets with their first tokens and the group they are in."""
    own = F.coalesce("component", "id").alias("own")
    named = checked(signed.sparkSession, groups).withColumnRenamed("node", "id")
    return signed.join(named, "id", "left").select("id", "n", "first", "bits", own)


def meeting(signed: DataFrame, groups: Stored, settings: Settings, among: DataFrame | None = None) -> DataFrame:
    """The first tokens that sets of different groups share, and the parts their sets are cut into: token, parts.

    ``among`` (token) are tokens beside which there are none, if they are known: those that met before the groups grew.
    """
    posted = in_groups(signed, groups).select("own", F.explode("first").alias("token"))
    posted = posted if among is None else posted.join(among, "token", "left_semi")
    shared = posted.groupBy("token").agg(F.min("own").alias("lo"), F.max("own").alias("hi"), F.count("*").alias("m"))
    shared = shared.where("lo < hi").select("token", F.ceil(F.col("m") / settings.cell).cast("int").alias("parts"))
    return checked(signed.sparkSession, store(shared, "join-tokens"))


def across(signed: DataFrame, groups: Stored, settings: Settings, few: bool = False, shared: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of different groups that share one of their first tokens and pass the signature tree.

    With ``few`` a group gives one pair for each batch of cells, with the smallest group it meets there: a first
    round of as many pairs as rows at most, which joins most groups, so that a second one, with all pairs, has
    little left. It cannot stand alone.
    """
    shared = meeting(signed, groups, settings) if shared is None else shared
    rows = in_groups(signed, groups).select("id", "n", "own", "bits", F.posexplode("first").alias("place", "token")).join(shared, "token")
    # a token of many sets: each part meets each part, itself too, in a cell
    part = F.pmod(F.xxhash64("id", "token"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("part", part).withColumn("other", other)
    rows = rows.withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other"))
    rows = rows.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "n", "id")

    def traversed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cells in whole(batches, ["token", "lo", "hi"]):
            a, b = cell_pairs(cells, settings)
            if settings.ordered:
                keep = from_here(cells, a, b, settings.percent)
                a, b = a[keep], b[keep]
            ids = cells["id"].to_numpy()
            pairs = pd.DataFrame({"a": np.maximum(ids[a], ids[b]), "b": np.minimum(ids[a], ids[b])})
            if few:
                own = cells["own"].to_numpy()
                larger, smaller = np.maximum(own[a], own[b]), np.minimum(own[a], own[b])
                order = np.lexsort((smaller, larger))
                first = np.ones(len(order), bool)
                first[1:] = np.diff(larger[order]) != 0
                pairs = pairs.iloc[order[first]]
            yield pairs.drop_duplicates()
        give_back()

    columns = ["token", "lo", "hi", "part", "id", "n", "own", "bits", *["place"] * settings.ordered]
    return rows.select(*columns).mapInPandas(traversed, "a long, b long").distinct()


def whole(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of sorted rows, cut so that no cell is split; a cell is bounded, so what waits is too."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(held):
            continue
        last = (held[key] == held[key].iloc[-1]).all(axis=1)
        start = len(held) - int(last.sum())
        if start:
            yield held.iloc[:start].reset_index(drop=True)
            held = held.iloc[start:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def from_here(cells: pd.DataFrame, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether two sets can be similar enough if they share no token before that of the cell."""
    sizes = cells["n"].to_numpy(np.int64)
    rest = sizes - cells["place"].to_numpy(np.int64)
    return (100 + percent) * np.minimum(rest[a], rest[b]) >= percent * (sizes[a] + sizes[b])


def cell_pairs(cells: pd.DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each cell that the signature trees do not rule out, in different groups and parts."""
    lengths = cells["bits"].str.len().to_numpy()
    found = []
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero((lengths == size) | (lengths == 2 * size))
        some = cells.iloc[at]
        a, b = tree_pairs(some, stacked(some["bits"].tolist(), size), settings)
        one = (lengths[at[a]] == size) | (lengths[at[b]] == size)  # two longer ones meet in their own tree
        found.append((at[a[one]], at[b[one]]))
    left, right = zip(*found, strict=True)
    return np.concatenate(left), np.concatenate(right)


def tree_pairs(cells: pd.DataFrame, bits: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The same for sets whose bitmaps have one length."""
    sizes, own, part = (cells[c].to_numpy(np.int64) for c in ("n", "own", "part"))
    lo, hi = cells["lo"].to_numpy(), cells["hi"].to_numpy()
    names = cells[["token", "lo", "hi"]].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]).any(1)]))
    counts = np.diff(np.append(starts, len(names)))
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    # cells of no more sets than a leaf are one leaf each: their pairs are looked at together
    for m in np.unique(counts[(counts > 1) & (counts <= settings.leaf)]):
        at = starts[counts == m]
        i, j = np.triu_indices(int(m), 1)
        left.append((at[:, None] + i).ravel())
        right.append((at[:, None] + j).ravel())
    a, b = np.concatenate(left), np.concatenate(right)
    leaves = Tree([bits], [sizes], [sizes], [sizes - COUNT[bits].sum(1, dtype=np.int64)], settings.leaf)
    keep = (own[a] != own[b]) & ((part[a] != part[b]) | (lo[a] == hi[a]))
    a, b = a[keep], b[keep]
    keep = leaves.possible(0, a, b, settings.percent)
    left, right = [a[keep]], [b[keep]]
    for start, count in zip(starts[counts > settings.leaf], counts[counts > settings.leaf], strict=True):
        here = slice(start, start + count)
        if own[here].min() == own[here].max():
            continue
        i, j = Tree.over(bits[here], sizes[here], settings.leaf).pairs(settings.percent)
        i, j = i + start, j + start
        keep = (own[i] != own[j]) & ((part[i] != part[j]) | (lo[i] == hi[i]))
        left.append(i[keep])
        right.append(j[keep])
    return np.concatenate(left), np.concatenate(right)


def joined(documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """For each document: id, n (size of its set), component (the smallest id reachable by links).

    Documents without words are linked with nothing. Rows of the same id are the same document. A null id links
    others as any set does, but its own component is that of its set.
    """
    settings = settings or Settings()
    ready(documents)
    # documents of one id and several texts: the id stands for the first set, the others are tied to it by name
    measured = store(counted(documents, key, text, settings), "join-members").rows
    members = measured.where("sketch is null").drop("sketch")
    named = members.where("name is not null and id is not null").groupBy("name")
    heads = store(named.agg(F.min("id").alias("id")), "join-heads").rows
    nodes = store(heads.select("id").distinct(), "join-nodes")
    rank = common(measured, settings)
    signed = store(signatures(documents, key, text, checked(documents.sparkSession, nodes), rank, settings), "join-signatures")

    def texts(wanted: DataFrame) -> DataFrame:
        return owners(documents, key, text, wanted)

    nodes.discard()
    close = compared(near_copies(signed.rows, settings), texts, settings.percent)
    groups = graph.components(close.rows)
    shared = meeting(signed.rows, groups, settings)
    some = compared(across(signed.rows, groups, settings, True, shared), texts, settings.percent)
    groups.discard()
    tied = close.rows.unionAll(some.rows)
    groups = graph.components(tied)
    shared = meeting(signed.rows, groups, settings, shared.select("token"))
    more = compared(across(signed.rows, groups, settings, False, shared), texts, settings.percent)
    for table in (signed, groups):
        table.discard()
    groups = graph.components(tied.unionAll(more.rows))
    for table in (close, some, more):
        table.discard()
    final = heads.join(groups.rows.withColumnRenamed("node", "id"), "id", "left")
    final = final.select("name", F.coalesce("component", "id").alias("component"))
    out = members.join(final, "name", "left")
    return out.select("id", "n", F.coalesce("component", "id").alias("component"))
