"""SentencePiece ids with seeded merge-dropout, and the text back from them.

Merges are taken from an agenda, best score first. A hash keyed with the seed, the document, the unit's position in
it and the merge's place decides whether the merge is skipped, so every occurrence of a word is cut in a way of its
own, and all ways depend on nothing but these keys. Characters without a piece become bytes; white space is kept as
it is, so every segmentation decodes to the text.

The agenda of a unit (a word with the space before it) is run once for each set of merges skipped in it: these
outcomes form a tree, from the one without skips to those with one skip more. An occurrence starts at the first and
goes down by its own hashes, which are made for all occurrences of a batch together, until no merge left is skipped.
What only one occurrence of a batch needs is not made an outcome: its agenda is run with its hashes at once.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import give_back, ready

SPACE = "▁"  # fixed value: stands for a space in pieces
NEVER = 1 << 60  # the place of what is no merge
SHORT = 24  # characters of a unit that is worked out together with others of its length
TOGETHER = 20_000
UNKNOWN = 1 << 24
REMEMBERED = 200_000  # outcomes that a task keeps before it starts anew; some 300 bytes each
CHARACTERS = 2_000_000  # of texts that are handled together


@dataclass(frozen=True)
class Settings:
    dropout: float = 0.1
    seed: int = 5


def scrambled(x: np.ndarray) -> np.ndarray:
    """Other 32 bits, each of which depends on all of ``x`` (unsigned 32 bits)."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


class Pieces:
    """A BPE model with byte fallback: ids and scores of its pieces."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        self.raw: list[bytes] = []  # what each id adds to the text
        self.ids: dict[str, int] = {}
        score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.raw.append(b"")
            else:
                self.raw.append(piece.replace(SPACE, " ").encode())
                self.ids[piece], score[piece] = i, sp.get_score(i)
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte fallback, so it cannot decode every text")
        # no piece goes on after a space or a line feed, so a text can be cut there
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("the model has pieces that go on beyond the end of a word")
        self.order = {p: n for n, p in enumerate(sorted(score, key=lambda p: (-score[p], self.ids[p])))}
        # nor do words need to stay with marks that no piece joins to a letter
        pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1) if p[i] != SPACE}
        marks = {chr(c) for c in range(33, 127) if not chr(c).isalpha()}
        while mixed := {c for pair in pairs for c in pair if c in marks and not marks.issuperset(pair)}:
            marks -= mixed
        cut = re.escape("".join(sorted(marks)))
        run = f"(?:[{cut}]+|[^{cut}{SPACE}\n]+)" if marks else f"(?:[^{SPACE}\n]+)"
        self.unit = re.compile(f"{SPACE}+{run}?|{run}|\n")
        self.codes = UNKNOWN + np.arange(0x110000, dtype=np.int64)  # by character
        for char in (p for p in self.ids if len(p) == 1):
            self.codes[ord(char)] = self.ids[char]
        # what two neighbours merge into, for every way to cut a piece in two symbols
        merges = {
            (self.code(p[:i]) << 32 | self.code(p[i:])): place
            for p, place in self.order.items()
            for i in range(1, len(p))
            if all(len(half) == 1 or half in self.ids for half in (p[:i], p[i:]))
        }
        self.pairs = np.array(sorted(merges), np.int64)
        self.places = np.array([merges[k] for k in self.pairs.tolist()] + [NEVER], np.int64)
        self.becomes = np.array([self.ids[p] for p in self.order], np.int64)  # by place

    def code(self, symbol: str) -> int:
        """A symbol's number: its id, or one of its own for a character that is no piece."""
        one = self.ids.get(symbol)
        return UNKNOWN + ord(symbol) if one is None else one

    def found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The places of the merges of pairs of symbols, ``NEVER`` if they do not merge."""
        key = left << 32 | right
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == key, self.places[at], NEVER)

    def few(self, units: list[str], skipped) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Segmentations of units of one length, short ones: row by row an agenda with an entry between neighbours.

        ``skipped`` tells from rows and merges, named as ``place_of`` does, which are skipped. Returns all ids, their
        number in each row, the merges made, in their order, and their number in each row.
        """
        n = len(units[0])
        chars = self.codes[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)].reshape(-1, n)
        # one column more than there are symbols, so that a row can always be moved up by one
        symbols = np.concatenate([chars, np.full((len(units), 1), -1)], 1)
        starts = np.tile(np.append(np.arange(n + 1), n), (len(units), 1))
        agenda = np.full((len(units), n + 1), NEVER, np.int64)
        agenda[:, : n - 1] = self.found(chars[:, :-1], chars[:, 1:])
        active, columns, wide = np.arange(len(units)), np.arange(n + 1), np.arange(n + 2)
        made: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 2]
        while len(active):
            order = agenda[active]
            at = order.argmin(1)
            go = order[np.arange(len(active)), at] != NEVER
            active, at = active[go], at[go]
            place = place_of(starts[active, at], starts[active, at + 2])
            skip = skipped(active, place)
            agenda[active[skip], at[skip]] = NEVER
            rows, at = active[~skip], at[~skip]
            if not len(rows):
                continue
            made.append((rows, place[~skip]))
            symbols[rows, at] = self.becomes[agenda[rows, at]]
            move = np.minimum(columns + (columns > at[:, None]), n)
            symbols[rows] = np.take_along_axis(symbols[rows], move, 1)
            agenda[rows] = np.take_along_axis(agenda[rows], np.minimum(columns + (columns >= at[:, None]), n), 1)
            starts[rows] = np.take_along_axis(starts[rows], np.minimum(wide + (wide > at[:, None]), n + 1), 1)
            agenda[rows, at] = self.found(symbols[rows, at], symbols[rows, at + 1])
            inner = at > 0
            rows, at = rows[inner], at[inner]
            agenda[rows, at - 1] = self.found(symbols[rows, at - 1], symbols[rows, at])
        there = symbols >= 0
        ids, counts = symbols[there], there.sum(1)
        if (ids >= UNKNOWN).any():
            split = np.split(ids, np.cumsum(counts)[:-1])
            rows_ids = [[y for x in row.tolist() for y in ((x,) if x < UNKNOWN else self.of(chr(x - UNKNOWN)))] for row in split]
            ids, counts = np.fromiter(chain.from_iterable(rows_ids), np.int64), np.array(list(map(len, rows_ids)))
        of_row, places = (np.concatenate(x) for x in zip(*made, strict=True))
        in_order = np.argsort(of_row, kind="stable")
        return ids, counts, places[in_order], np.bincount(of_row, minlength=len(units))

    def many(self, unit: str, skipped) -> list[str]:
        """The symbols of a unit of any length: the agenda is a heap, its entries are checked when they come up.

        ``skipped`` tells from a merge's first character and the one behind its last whether it is skipped.
        """
        n = len(unit)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int]] = []

        def add(left: int, middle: int, stop: int) -> None:
            place = self.order.get(unit[left:stop])
            if place is not None:
                heapq.heappush(agenda, (place, left, middle, stop))

        for i in range(n - 1):
            add(i, i + 1, i + 2)
        while agenda:
            _, left, middle, stop = heapq.heappop(agenda)
            if end[left] != middle or end[middle] != stop:  # parts of others meanwhile
                continue
            if skipped(left, stop):
                continue
            end[left], end[middle] = stop, -1
            right = after[left] = after[middle]
            if right >= 0:
                before[right] = left
                add(left, stop, end[right])
            if before[left] >= 0:
                add(before[left], left, stop)
        out, at = [], 0
        while at >= 0:
            out.append(unit[at : end[at]])
            at = after[at]
        return out

    def of(self, piece: str) -> tuple[int, ...]:
        one = self.ids.get(piece)
        return (one,) if one is not None else tuple(self.bytes[b] for b in piece.encode())

    def units(self, text: str) -> list[list[str]]:
        """A text cut into units, in parts between the characters that stand for a space and go by their bytes."""
        parts = text.split(SPACE)
        spaced = [part.replace(" ", SPACE) for part in parts]
        return [self.unit.findall(part) for part in (SPACE + spaced[0], *spaced[1:])]

    def encode(self, texts: list[str | None], keys: list[int], settings: Settings) -> list[np.ndarray | None]:
        return Drawing(self, settings).encode(texts, keys)

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text; ids of no piece of text add nothing."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


def place_of(left, stop):
    """A merge of a short unit by its first character and the one behind its last."""
    return left * (SHORT + 1) + stop


class Flat:
    """Arrays of different lengths, one behind the other."""

    def __init__(self, dtype: type):
        self.values, self.starts = np.empty(1 << 12, dtype), np.zeros(1 << 10, np.int64)
        self.n = 0

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        end = int(self.starts[self.n])
        self.values = self._room(self.values, end + len(values))
        self.starts = self._room(self.starts, self.n + len(counts) + 1)
        self.values[end : end + len(values)] = values
        self.starts[self.n + 1 : self.n + 1 + len(counts)] = end + np.cumsum(counts)
        self.n += len(counts)

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate([array, np.empty(max(size, len(array)), array.dtype)])

    def counts(self, at: np.ndarray) -> np.ndarray:
        return self.starts[at + 1] - self.starts[at]

    def take(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The arrays of some numbers, one behind the other."""
        ends = np.cumsum(counts)
        return self.values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - ends + counts, counts)]


class Drawing:
    """Segmentations of occurrences, and the outcomes remembered for them; it lives as long as its task."""

    def __init__(self, model: Pieces, settings: Settings):
        self.model, self.settings = model, settings
        self.limit = int(settings.dropout * 2**32)
        self.forget()

    def forget(self) -> None:
        """Start anew with one outcome, that of a literal character for spaces, which goes by its bytes."""
        self.first: dict[str, int] = {"": 0}
        self.next: dict[int, int] = {}  # outcome and merge skipped in it -> outcome
        self.unit: list[tuple[str, tuple[int, ...]]] = [("", ())]
        self.ids, self.merges = Flat(np.int32), Flat(np.int64)
        space = np.array([self.model.bytes[b] for b in SPACE.encode()])
        self.ids.add(space, np.array([len(space)]))
        self.merges.add(np.empty(0, np.int64), np.zeros(1, np.int64))

    def add(self, units: list[str], skipped_of, barred: list[tuple[int, ...]] | None = None) -> np.ndarray:
        """Work out units that are not long, those of one length together; the numbers of their outcomes.

        Without ``barred`` they are not to be kept, and have no unit.
        """
        numbers = np.empty(len(units), np.int64)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        order = np.argsort(lengths, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            for start in range(0, len(some), TOGETHER):
                part = some[start : start + TOGETHER]
                own = part.tolist()
                ids, counts, merges, n_merges = self.model.few([units[i] for i in own], skipped_of(own))
                numbers[part] = np.arange(self.ids.n, self.ids.n + len(part))
                if barred is not None:
                    self.unit += [(units[i], barred[i]) for i in own]
                self.ids.add(ids, counts)
                self.merges.add(merges, n_merges)
        return numbers

    def learn(self, wanted: list[tuple[str, tuple[int, ...]]]) -> list[int]:
        """Outcomes to remember: of a unit with some merges skipped."""
        barred = [places for _, places in wanted]

        def skipped_of(part: list[int]):
            table = np.full((len(part), max(1, *(len(barred[i]) for i in part))), -1)
            for row, i in enumerate(part):
                table[row, : len(barred[i])] = barred[i]
            return lambda rows, places: (table[rows] == places[:, None]).any(1)

        return self.add([unit for unit, _ in wanted], skipped_of, barred).tolist()

    def skipped(self, salts: np.ndarray, places: np.ndarray) -> np.ndarray:
        return scrambled(salts ^ scrambled(places.astype(np.uint32))) < self.limit

    def once(self, units: list[str], salts: np.ndarray) -> np.ndarray:
        """Outcomes of single occurrences, by their own hashes; the caller forgets them."""
        numbers = np.empty(len(units), np.int64)
        short = [i for i, u in enumerate(units) if len(u) <= SHORT]
        own = salts[short]
        numbers[short] = self.add(
            [units[i] for i in short],
            lambda part: lambda rows, places, salt=own[part]: self.skipped(salt[rows], places),
        )
        for i in (i for i, u in enumerate(units) if len(u) > SHORT):
            salt = salts[i : i + 1]
            symbols = self.model.many(
                units[i], lambda left, stop, salt=salt: bool(self.skipped(salt, np.array([place_of(left, stop) & 0xFFFFFFFF]))[0])
            )
            ids = np.array([x for symbol in symbols for x in self.model.of(symbol)])
            numbers[i] = self.ids.n
            self.ids.add(ids, np.array([len(ids)]))
            self.merges.add(np.empty(0, np.int64), np.zeros(1, np.int64))
        return numbers

    def outcomes(self, units: list[str], salts: np.ndarray) -> tuple[np.ndarray, int]:
        """The outcome of each occurrence, and how many outcomes are to be kept; "" is a literal character for spaces."""
        self.ids.n = self.merges.n = len(self.unit)  # without single occurrences of the call before
        at = np.fromiter(map(self.first.get, units, repeat(-1)), np.int64, len(units))
        unseen = np.flatnonzero(at < 0)
        often = [u for u, n in Counter(units[i] for i in unseen.tolist()).items() if n > 1 and len(u) <= SHORT]
        self.first.update(zip(often, self.learn([(u, ()) for u in often]), strict=True))
        at[unseen] = [self.first.get(units[i], -1) for i in unseen.tolist()]
        single = [np.flatnonzero(at < 0)]
        open_ = np.flatnonzero(at >= 0) if self.limit else np.empty(0, np.int64)
        size = (SHORT + 1) ** 2
        while len(open_):
            counts = self.merges.counts(at[open_])
            places = self.merges.take(at[open_], counts)
            hit = np.flatnonzero(self.skipped(np.repeat(salts[open_], counts), places))
            owner, earliest = np.unique(np.repeat(np.arange(len(open_)), counts)[hit], return_index=True)
            open_ = open_[owner]  # at the first of the merges that is skipped
            kinds, which, times = np.unique(at[open_] * size + places[hit[earliest]], return_inverse=True, return_counts=True)
            known = np.fromiter(map(self.next.get, kinds.tolist(), repeat(-1)), np.int64, len(kinds))
            new = np.flatnonzero((known < 0) & (times > 1))
            wanted = [(self.unit[k // size][0], (*self.unit[k // size][1], k % size)) for k in kinds[new].tolist()]
            known[new] = self.learn(wanted)
            self.next.update(zip(kinds[new].tolist(), known[new].tolist(), strict=True))
            at[open_] = known[which]
            single.append(open_[at[open_] < 0])
            open_ = open_[at[open_] >= 0]
        kept, alone = self.ids.n, np.concatenate(single)
        at[alone] = self.once([units[i] for i in alone.tolist()], salts[alone])
        return at, kept

    def encode(self, texts: list[str | None], keys: list[int]) -> list[np.ndarray | None]:
        """Ids of texts; null has none, an empty one no ids. A space stands before each, as the model expects."""
        out: list[np.ndarray | None] = []
        start, held = 0, 0
        for i, text in enumerate(texts):
            held += len(text or "")
            if held >= CHARACTERS or i + 1 == len(texts):
                out += self._encode(texts[start : i + 1], keys[start : i + 1])
                start, held = i + 1, 0
        return out

    def _encode(self, texts: list[str | None], keys: list[int]) -> list[np.ndarray | None]:
        if len(self.unit) > REMEMBERED:
            self.forget()
        units: list[str] = []
        sizes = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            before = len(units)
            for number, part in enumerate(self.model.units(text) if text else []):
                units += ["", *part] if number else part
            sizes[i] = len(units) - before
        place = np.arange(len(units)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        of_text = scrambled(np.array(keys, np.int64).astype(np.uint32) ^ np.uint32(self.settings.seed * 0x9E3779B1 & 0xFFFFFFFF))
        salts = scrambled(np.repeat(of_text, sizes) + place.astype(np.uint32) * np.uint32(0x9E3779B1))
        at, kept = self.outcomes(units, salts)
        counts = self.ids.counts(at)
        ids = self.ids.take(at, counts)
        self.ids.n = self.merges.n = kept
        ends = np.cumsum(np.append(0, counts))[np.append(0, np.cumsum(sizes))].tolist()
        return [None if t is None else ids[ends[i] : ends[i + 1]] for i, t in enumerate(texts)]


@lru_cache(1)
def pieces(model: bytes) -> Pieces:
    return Pieces(model)


def with_ids(documents: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", ids: str = "ids",
             exact: str | None = "lossless", settings: Settings | None = None) -> DataFrame:
    """The documents with ids of their whole texts, and whether these decode to exactly the text.

    Which merges are skipped follows from the seed and the hash of ``key``, a null one included. A null text has
    null ids. The model is read once, on the driver, and sent to the tasks.
    """
    settings = settings or Settings()
    with open(model_path, "rb") as file:
        sent = ready(documents).sparkContext.broadcast(file.read())

    @F.pandas_udf("struct<ids:array<int>,exact:boolean>")
    def encode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = pieces(sent.value)
        drawing = Drawing(model, settings)  # what it remembers goes with the task
        for texts, keys in batches:
            made = drawing.encode(texts.tolist(), keys.tolist())
            same = [None if i is None else model.decode(i.tolist()) == t for i, t in zip(made, texts, strict=True)]
            yield pd.DataFrame({"ids": pd.Series(made, dtype=object), "exact": pd.Series(same, dtype=object)})
            del made, same, texts, keys
        del drawing
        give_back()

    keyed = F.xxhash64(F.col(key)).bitwiseAND(F.lit(0x7FFFFFFF))
    out = documents.withColumn("__made", encode(text, keyed)).withColumn(ids, F.col("__made.ids"))
    return (out.withColumn(exact, F.col("__made.exact")) if exact else out).drop("__made")


def with_text(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The text that ids stand for; null ids have a null text."""
    with open(model_path, "rb") as file:
        sent = ready(rows).sparkContext.broadcast(file.read())

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pieces(sent.value)
        for batch in batches:
            yield pd.Series([None if x is None else model.decode(x.tolist()) for x in batch], dtype=object)

    return rows.withColumn(text, decode(ids))
