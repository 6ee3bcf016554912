"""Passages that repeat across documents: paragraph MinHash banding.

A paragraph is a line of enough words. Equal paragraphs are one node. Bands of minimum hashes are tuned so
that a pair at the threshold collides almost surely; paragraphs that collide are joined, their exact Jaccard
similarity is verified, and components of the verified pairs say what repeats. All but the first occurrence
of a component are to be removed.

Passages that are no whole line are found as runs of equal words, wherever lines begin and end. Pieces of half
a passage, cut where the content says so, tell which places can hold such a run; there every window of a
passage's words is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from . import graph, ngram_join
from .text import SHINGLE, STEP, distinct, in_a_row, mixed, some_powers, word_hashes
from .work import Stored, ready, store


@dataclass(frozen=True)
class Settings:
    words: int = 50  # of a paragraph at least
    percent: int = 80
    hashes: int = 64  # of a signature at most
    recall: float = 0.9995  # of pairs just at the threshold


BITMAP = 256  # bits of a paragraph's bitmap at least


def tuned(settings: Settings) -> tuple[int, int]:
    """Bands and rows of a band: the most rows, hence the fewest chance collisions, that reach the recall."""
    best = (settings.hashes, 1)
    for rows in range(1, settings.hashes + 1):
        for bands in range(1, settings.hashes // rows + 1):
            if 1 - (1 - (settings.percent / 100) ** rows) ** bands >= settings.recall:
                best = (bands, rows)
                break
    return best


def bands_of(tokens: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band of minimum hashes; the number of the band is part of it."""
    salts = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64), 11)[:, None] | np.uint64(1)  # tokens are hashes already
    least = (tokens[None, :] * salts).min(1).reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for row in range(rows):
        out = mixed(out ^ least[:, row], 13 + row)
    return out.view(np.int64)


def signed(tokens: np.ndarray, sizes: np.ndarray, settings: Settings) -> tuple[np.ndarray, list[np.ndarray], list[bytes]]:
    """Size, ``bands_of`` and bitmap of sets, all together. They come as sorted tokens, one set behind the other, which may repeat."""
    starts = np.cumsum(sizes) - sizes
    new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    new[starts] = True
    n = np.add.reduceat(new, starts, dtype=np.int64)
    tokens, starts = tokens[new], np.cumsum(n) - n
    bands, rows = tuned(settings)
    salts = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64), 11) | np.uint64(1)
    least = np.array([np.minimum.reduceat(tokens * salt, starts) for salt in salts]).reshape(bands, rows, -1)
    out = np.arange(1, bands + 1, dtype=np.uint64)[:, None]
    for row in range(rows):
        out = mixed(out ^ least[:, row], 13 + row)
    bits = np.array([ngram_join.bits_for(x, BITMAP) for x in n.tolist()])
    slots = (mixed(tokens, 3) >> np.uint64(32)).astype(np.int64)
    bitmaps: list[bytes] = [b""] * len(n)
    for wide in np.unique(bits).tolist():
        own = np.flatnonzero(bits == wide)
        flags = np.zeros((len(own), wide), np.uint8)
        at = np.repeat(np.where(bits == wide, np.cumsum(bits == wide) - 1, -1), n)
        flags[at[at >= 0], slots[at >= 0] % wide] = 1
        for i, one in zip(own.tolist(), np.packbits(flags, axis=1), strict=True):
            bitmaps[i] = one.tobytes()
    return n, np.ascontiguousarray(out.T).view(np.int64), bitmaps


PARAGRAPH = pa.schema(
    [("doc", pa.int64()), ("line", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("id", pa.int64()), ("n", pa.int64())]
    + [("bands", pa.list_(pa.int64())), ("bits", pa.binary()), ("pieces", pa.list_(pa.int64()))]
)


def paragraphs(documents: DataFrame, key: str, text: str, settings: Settings, pieces: bool = False) -> DataFrame:
    """Each long enough paragraph: doc, line, its first and last character, its node id, size, bands and bitmap.

    With ``pieces`` there is one row more for each text, with nothing but doc and the text's pieces, so that its words
    are looked at once.
    """
    ready(documents)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, places, tokens, names = [], [], [np.empty(0, np.uint64)], []
            of_runs, cut = [], []
            for row, t in enumerate(batch["t"].to_pylist()):
                words, begins = word_hashes(t)
                if len(words) < settings.words:
                    continue
                if pieces:
                    at = elected(words, settings)
                    of_runs.append(row)
                    cut.append(distinct(run_hashes(words, settings.words // 2, 23)[at[blocks_of(at)]]))
                feeds = np.flatnonzero(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8) == 10)
                first = np.searchsorted(begins, np.concatenate([[0], feeds]))  # the first word of each line
                last = np.append(first[1:], len(words))
                long = np.flatnonzero(last - first >= settings.words)
                if not len(long):
                    continue
                stops = np.cumsum([len(line) + 1 for line in t.split("\n")]) - 1
                starts = np.append(0, stops[:-1] + 1)
                rows = in_a_row(words)
                for a, b in zip(first[long].tolist(), (last[long] - SHINGLE + 1).tolist(), strict=True):
                    own = np.sort(rows[a:b])
                    names.append(xxh3_64_intdigest(distinct(own) if (own[1:] == own[:-1]).any() else own))
                    tokens.append(own)
                owners.append(np.full(len(long), row))
                places.append(np.column_stack([long, starts[long], stops[long]]))
            at, place = np.concatenate([np.empty(0, int), *owners]), np.concatenate([np.empty((0, 3), int), *places])
            sizes = np.array([len(own) for own in tokens[1:]], np.int64)
            n, bands, bits = signed(np.concatenate(tokens), sizes, settings) if names else (sizes, [], [])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc"].take(pa.array(at)), *[pa.array(x.astype(np.int32)) for x in place.T],
                        pa.array(np.array(names, np.uint64).view(np.int64)), pa.array(n),
                        ngram_join.lists(bands, np.int64), pa.array(bits, pa.binary()), pa.nulls(len(at), pa.list_(pa.int64())),
                    ],
                    schema=PARAGRAPH,
                )
            if of_runs:
                none = [pa.nulls(len(of_runs), kind) for kind in PARAGRAPH.types[1:-1]]
                of_runs = batch["doc"].take(pa.array(of_runs))
                yield pa.RecordBatch.from_arrays([of_runs, *none, ngram_join.lists(cut)], schema=PARAGRAPH)

    kind = "doc bigint, line int, start int, stop int, id bigint, n bigint, bands array<bigint>, bits binary, pieces array<bigint>"
    return documents.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("t")).where(
        "doc is not null"
    ).mapInArrow(found, kind)


def repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """Paragraphs that two or more documents share: doc, line, start, stop (characters), component, removed.

    The component is named by the smallest document that holds it and the first such line. Null, empty and short
    texts have no paragraphs; rows of the same id are the same document. Equal lines of one document alone do not
    repeat across documents.
    """
    settings = settings or Settings()
    return repeats_among(store(paragraphs(documents, key, text, settings), "passages"), documents, key, text, settings)


def repeats_among(all_rows: Stored, documents: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """The same from the documents' paragraphs, which are discarded."""
    ready(documents)
    lines = all_rows.rows.where("pieces is null")
    places = lines.select("doc", "line", "start", "stop", "id")
    heads = lines.groupBy("id").agg(
        F.min(F.struct("doc", "line")).alias("at"),
        F.first("n").alias("n"),
        F.first("bands").alias("hashes"),
        F.first("bits").alias("bits"),
    )
    nodes = store(heads, "passage-nodes")
    heads = nodes.rows.withColumn("first", F.col("hashes"))

    def texts(wanted: DataFrame) -> DataFrame:
        where = store(heads.join(wanted, "id").select("id", "at.doc", "at.line"), "passage-places")
        where = ngram_join.checked(documents.sparkSession, where)
        rows = documents.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("t")).join(where, "doc")
        rows = rows.select("id", F.split("t", "\n")[F.col("line")].alias("t"))
        return rows.where("t is not null")

    join = ngram_join.Settings(percent=settings.percent, bitmap=BITMAP, ordered=False)
    hashes = ngram_join.hash_heads(heads)
    close = ngram_join.compared(ngram_join.near_copies(heads, join, hashes), texts, settings.percent)
    groups = graph.components(close.rows)
    shared = ngram_join.meeting(heads, groups, join, hashes.select(F.col("h").alias("token")))  # bands are the first tokens
    some = ngram_join.compared(ngram_join.across(heads, groups, join, True, shared), texts, settings.percent)
    close = store(close.rows.unionAll(some.rows), "passage-links")
    groups = graph.components(close.rows)
    shared = ngram_join.meeting(heads, groups, join, shared.select("token"))
    more = ngram_join.compared(ngram_join.across(heads, groups, join, False, shared), texts, settings.percent)
    groups = graph.components(close.rows.unionAll(more.rows))
    named = heads.select("id").join(groups.rows.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("id", F.coalesce("component", "id").alias("component"))
    grouped = store(places.join(named, "id"), "passage-groups").rows
    for table in (all_rows, nodes):  # signatures, which are most of what is written so far
        table.discard()
    ends = grouped.groupBy("component").agg(
        F.min(F.struct("doc", "line")).alias("kept"), F.min("doc").alias("lo"), F.max("doc").alias("hi")
    )
    shared = ends.where("lo < hi").select("component", "kept")
    out = grouped.join(shared, "component")
    return out.select(
        "doc", "line", "start", "stop", F.col("kept.doc").alias("first_doc"), F.col("kept.line").alias("first_line"),
        (F.struct("doc", "line") != F.col("kept")).alias("removed"),
    )


def run_hashes(words: np.ndarray, width: int, salt: int) -> np.ndarray:
    """A hash for every ``width`` words in a row, from sums of the words' hashes times powers by place."""
    n = len(words) - width + 1
    if n < 1:
        return words[:0]
    up, down = some_powers(len(words))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(words, salt) * up, dtype=np.uint64)])
    return mixed((sums[width:] - sums[:-width]) * down[:n], salt + 1)


def elected(words: np.ndarray, settings: Settings) -> np.ndarray:
    """For each window of a passage's words, where the piece of half a passage begins that stands for it.

    It is the least hash of a few words among those that begin a piece of the window, the first if they tie; what
    lies in the window decides it alone, so equal windows have such a piece at the same place.
    """
    half, n = settings.words // 2, len(words) - settings.words + 1
    if n < 1:
        return np.empty(0, np.int64)
    least = run_hashes(words, min(SHINGLE, half), 21)
    at, wide, stretch = np.arange(len(least)), 1, settings.words - half + 1
    while wide < stretch:  # the least of ``wide`` in a row, then of more
        step = min(wide, stretch - wide)
        later = least[step:] < least[:-step]
        least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
        wide += step
    return at[:n]


def blocks_of(at: np.ndarray) -> np.ndarray:
    """The first of the windows in a row that one piece stands for."""
    return np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at


def word_places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last character, and line, of each of the words that ``shingle_words`` gives."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    word = ((codes < 9) | (codes > 13)) & (codes != 32)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], word, [0]])))
    return edges[::2], edges[1::2], np.searchsorted(np.flatnonzero(codes == 10), edges[::2])


HEAD = ["doc", "h", "b", "pos", "line", "start", "stop"]
BLOCK = (
    "doc bigint, h bigint, b bigint, pos int, line int, start int, stop int, "
    "names array<bigint>, lines array<int>, starts array<int>, stops array<int>"
)


def wanted_pieces(pieces: DataFrame) -> Stored:
    """For each document (doc) the pieces that another one has too: wanted."""
    posted = pieces.where("pieces is not null").select("doc", F.explode("pieces").alias("h"))
    shared = posted.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("h")
    shared = ngram_join.checked(pieces.sparkSession, store(shared, "run-shared"))
    return store(posted.join(shared, "h").groupBy("doc").agg(F.collect_set("h").alias("wanted")), "run-wanted")


def shared_windows(wanted: Stored, documents: DataFrame, key: str, text: str, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Every window of a passage's words that two or more documents hold, word by word, in blocks.

    ``wanted`` are the pieces to look at, and is discarded. A block holds the windows in a row that one piece stands for: doc, its first window's place pos, line, start and stop,
    and for each window its line from there on, and how far its start and stop are from those of the window before,
    which are small numbers that take little room. The second table names blocks by doc, pos, h and b: ``i`` are the windows of it that are shared, and for each of them the first
    document that holds it, and its place and line there. Windows are equal if their pieces and they agree in 64 bits
    each. Where all blocks of a piece are equal they are looked at as one; else windows are, of unlike blocks only.
    """
    spark, width, half = ready(documents), settings.words, settings.words // 2
    rows = documents.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("t")).where("doc is not null")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, windows, sizes = [], [], []
            for doc, text, hit in zip(batch["doc"].to_pylist(), batch["t"].to_pylist(), batch["wanted"], strict=True):
                words, _ = word_hashes(text)
                at = elected(words, settings)
                first = blocks_of(at)
                pieces = run_hashes(words, half, 23)[at[first]].view(np.int64)
                n = np.diff(np.append(first, len(at)))
                keep = np.isin(pieces, hit.values.to_numpy())
                if not keep.any():  # another text of the same id
                    continue
                names = run_hashes(words, width, 25)
                place = np.arange(len(at)) - np.repeat(first, n)
                whole = np.add.reduceat(mixed(names + place.astype(np.uint64) * np.uint64(STEP), 27), first)
                whole = mixed(whole + n.astype(np.uint64), 29).view(np.int64)
                pos = np.flatnonzero(np.repeat(keep, n))
                start, stop, line = word_places(text)
                start, stop, line, begin = start[pos], stop[pos + width - 1], line[pos], np.cumsum(n[keep]) - n[keep]
                own = [np.full(len(begin), doc), pieces[keep], whole[keep], first[keep]]
                heads.append(np.column_stack([*own, line[begin], start[begin], stop[begin]]))
                line = line - np.repeat(line[begin], n[keep])
                start, stop = np.diff(start, prepend=0), np.diff(stop, prepend=0)
                start[begin] = stop[begin] = 0
                windows.append(np.column_stack([names[pos].view(np.int64), line, start, stop]))
                sizes.append(n[keep])
            head = np.concatenate([np.empty((0, len(HEAD)), np.int64), *heads])
            window = np.concatenate([np.empty((0, 4), np.int64), *windows])
            ends = pa.array(np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, int), *sizes]))]).astype(np.int32))
            names, *places = (pa.array(x) for x in (window[:, 0], *window[:, 1:].astype(np.int32).T))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x) for x in head[:, :3].T], *[pa.array(x) for x in head[:, 3:].astype(np.int32).T]]
                + [pa.ListArray.from_arrays(ends, x) for x in (names, *places)],
                [*HEAD, "names", "lines", "starts", "stops"],
            )

    every = store(rows.join(wanted.rows, "doc").mapInArrow(blocks, BLOCK), "run-blocks")
    wanted.discard()
    first = F.min(F.struct("doc", "pos", "line", "lines", "names")).alias("first")
    kinds = store(every.rows.groupBy("h", "b").agg(first, F.max("doc").alias("hi")), "run-kinds")
    unlike = kinds.rows.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h")
    unlike = ngram_join.checked(spark, store(unlike, "run-unlike"))
    place = F.posexplode(F.arrays_zip("first.lines", "first.names")).alias("i", "w")
    alone = kinds.rows.join(unlike, "h", "left_semi").select("h", "b", "hi", "first.doc", "first.pos", "first.line", place)
    alone = alone.select("h", "b", "hi", "i", "doc", (F.col("pos") + F.col("i")).alias("pos"),
                         (F.col("line") + F.col("w.lines")).alias("lines"), "w.names")
    alone = store(alone, "run-windows")
    heads = alone.rows.groupBy("h", "names").agg(F.min(F.struct("doc", "pos", "lines")).alias("first"), F.max("hi").alias("hi"))
    heads = ngram_join.checked(spark, store(heads.where("first.doc < hi").drop("hi"), "run-heads"))
    held = alone.rows.join(heads, ["h", "names"]).groupBy("h", "b")
    held = held.agg(F.sort_array(F.collect_list(F.struct("i", "first"))).alias("w"))
    held = held.select(
        "h", "b", "w.i", F.col("w.first.doc").alias("docs"), F.col("w.first.pos").alias("places"), F.col("w.first.lines").alias("in_lines")
    )
    same = kinds.rows.join(unlike, "h", "left_anti").where("first.doc < hi")
    i = F.sequence(F.lit(0), F.size("first.lines") - 1)
    same = same.select(
        "h", "b", i.alias("i"), F.transform(i, lambda x: F.col("first.doc")).alias("docs"),
        F.transform(i, lambda x: F.col("first.pos") + x).alias("places"), F.transform("first.lines", lambda x: F.col("first.line") + x).alias("in_lines"),
    )
    known = store(same.unionByName(held), "run-known")
    alone.discard()
    kinds.discard()
    # the places, which are most of a block, need not travel to what is known of it: both meet at their document
    held = every.rows.select("doc", "h", "b", "pos").join(ngram_join.checked(spark, known), ["h", "b"])
    return every.rows.drop("names"), held


def spans(documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """The rows of ``repeats``, and rows of the same columns for runs of equal words that are not within them.

    A run goes over as many windows as follow one another here and in the first document that holds them; its line
    is the one it begins in. No run of ``words`` equal words that two documents share is missed.
    """
    settings = settings or Settings()
    all_rows = store(paragraphs(documents, key, text, settings, pieces=True), "passages")
    wanted = wanted_pieces(all_rows.rows)
    lines = repeats_among(all_rows, documents, key, text, settings)
    blocks, known = shared_windows(wanted, documents, key, text, settings)
    columns = ["doc", "line", "start", "stop", "first_doc", "first_line", "removed"]
    rows = lines.select(columns).unionByName(blocks, allowMissingColumns=True).unionByName(known, allowMissingColumns=True)
    rows = rows.repartition("doc").sortWithinPartitions("doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in whole_documents(batches):
            whole_lines = cells.filter(cells["pos"].is_null()).select(columns)
            yield whole_lines
            found = opened(*matched(cells.filter(cells["lines"].is_valid()), cells.filter(cells["i"].is_valid())))
            doc, pos, line, start, stop, first_doc, first_pos, first_line = found
            names = np.column_stack([doc, first_doc, pos - first_pos])
            new = np.concatenate([[True], (names[1:] != names[:-1]).any(1) | (np.diff(pos) != 1)]) if len(pos) else pos
            at = np.flatnonzero(new)
            ends = np.append(at[1:], len(pos))[: len(at)] - 1
            removed = (doc != first_doc) | (pos != first_pos)
            runs = [doc[at], line[at], start[at], stop[ends], first_doc[at], first_line[at], removed[at]]
            own = [whole_lines[c].to_numpy(zero_copy_only=False) for c in ("doc", "removed", "start", "stop")]
            outside = ~within([runs[0], runs[6], runs[2], runs[3]], own)
            runs = [pa.array(x[outside]).cast(t.type) for x, t in zip(runs, whole_lines.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(runs, columns)

    kind = "doc long, line int, start int, stop int, first_doc long, first_line int, removed boolean"
    return rows.mapInArrow(run, kind)


def whole_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by doc, cut so that no document is split."""
    held: list[pa.RecordBatch] = []  # of one document from its first row on

    def together(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_batches(some).combine_chunks().to_batches() if some else ()

    for batch in batches:
        doc = batch["doc"].to_numpy()
        if not len(doc):
            continue
        start = int(np.searchsorted(doc, doc[-1]))
        if start:
            yield from together([*held, batch.slice(0, start)])
            held = []
        elif held and held[-1]["doc"][0].as_py() != doc[0]:
            yield from together(held)
            held = []
        held.append(batch.slice(start))
    yield from together(held)


def within(runs: list[np.ndarray], lines: list[np.ndarray]) -> np.ndarray:
    """Which of the runs (doc, removed, start, stop) lie in a line of the same document that is removed or not as they are."""
    n = len(runs[0])
    doc, removed, start, stop = (np.concatenate([x, y]) for x, y in zip(runs, lines, strict=True))
    own = (np.unique(doc, return_inverse=True)[1].astype(np.int64) * 2 + removed) << 32
    start, stop = own + start, own + stop
    order = np.argsort(start[n:], kind="stable")
    begins = start[n:][order]
    farthest = np.concatenate([[-1], np.maximum.accumulate(stop[n:][order])])  # of all that begin so early
    return farthest[np.searchsorted(begins, start[:n], side="right")] >= stop[:n]


def matched(blocks: pa.RecordBatch, known: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """Blocks and what is known of them, row by row, once each."""
    names = [np.concatenate([blocks[c].to_numpy(), known[c].to_numpy()]).astype(np.int64) for c in ("doc", "pos", "h", "b")]
    order = np.lexsort(names)
    new = np.any([np.diff(x[order], prepend=x[order][:1]) != 0 for x in names], axis=0)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new)
    n = blocks.num_rows
    at = np.full((2, int(new.sum()) + 1), -1)
    at[0, which[:n]] = np.arange(n)
    at[1, which[n:]] = np.arange(known.num_rows)
    at = at[:, (at >= 0).all(0)]
    return blocks.take(pa.array(at[0])), known.take(pa.array(at[1]))


def opened(blocks: pa.RecordBatch, known: pa.RecordBatch) -> list[np.ndarray]:
    """The shared windows of blocks, in order, once each: doc, pos, line, start, stop, and doc, pos and line of the first."""
    values = {c: blocks[c].flatten().to_numpy().astype(np.int64) for c in ("lines", "starts", "stops")}
    values |= {c: known[c].flatten().to_numpy().astype(np.int64) for c in ("i", "docs", "places", "in_lines")}
    sizes, shared = (x.value_lengths().to_numpy().astype(np.int64) for x in (blocks["lines"], known["i"]))
    doc, pos, line, start, stop = (blocks[c].to_numpy().astype(np.int64) for c in ("doc", "pos", "line", "start", "stop"))
    begin = np.cumsum(sizes) - sizes

    def summed(steps: np.ndarray, first: np.ndarray) -> np.ndarray:
        sums = np.cumsum(steps)
        return sums + np.repeat(first - sums[begin], sizes)

    at = np.repeat(begin, shared) + values["i"]
    found = [
        np.repeat(doc, shared), np.repeat(pos, shared) + values["i"], np.repeat(line, shared) + values["lines"][at],
        summed(values["starts"], start)[at], summed(values["stops"], stop)[at], values["docs"], values["places"], values["in_lines"],
    ]
    order = np.lexsort((found[1], found[0]))
    again = (np.diff(found[0][order]) == 0) & (np.diff(found[1][order]) == 0)
    if again.any():  # rows of one document that come twice, or several texts of it
        order = np.lexsort(found[::-1])
        rows = np.column_stack(found)[order]
        order = order[np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])]
    return [x[order] for x in found]


def without(documents: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without what ``repeats`` or ``spans`` mark as removed; a text of nothing else becomes empty.

    With whole lines goes a line feed.
    """
    gone = found.where("removed").groupBy(F.col("doc").alias("__doc"))
    gone = gone.agg(F.sort_array(F.collect_set(F.array("start", "stop"))).alias("__gone"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, own in zip(texts, spans, strict=True):
            parts, at = [], 0
            merged: list[list[int]] = []
            for a, b in own if t is not None and own is not None else ():
                if merged and (a <= merged[-1][1] or t[merged[-1][1] : a] == "\n"):
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([int(a), int(b)])
            for a, b in merged:
                if (a == 0 or t[a - 1] == "\n") and t[b : b + 1] == "\n":
                    b += 1
                elif b == len(t) and a > 0 and t[a - 1] == "\n" and a - 1 >= at:
                    a -= 1
                parts.append(t[at:a])
                at = b
            out.append(None if t is None else "".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)

    rows = documents.join(gone, documents[key] == F.col("__doc"), "left")
    return rows.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(cut(text, "__gone"))).drop("__doc", "__gone")
