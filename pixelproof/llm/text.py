"""Words, their hashes and shingles, as arrays."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from xxhash import xxh3_64_intdigest

WORD = re.compile(r"\w+")
SHINGLE = 5

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def hashes(words: Sequence[str | bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """Other 64-bit hashes of 64-bit hashes."""
    out = (values ^ np.uint64(salt * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)) * _ODD
    return (out ^ (out >> _SHIFT)) * _ODD


def shingle_words(text: str | None) -> list[bytes]:
    """Words between the characters 9 to 13 and 32, with A to Z in lower case.

    That is what the methods of bytes do: they know no other white space and no other letters.
    """
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


STEP = 0x9E3779B97F4A7C15  # fixed value: odd, so it has an inverse among numbers of 64 bits
CHUNK = 1 << 17  # bytes looked at together, or one word if that is longer

_GAP = bytes(i in (9, 10, 11, 12, 13, 32) for i in range(256))
_BYTES = mixed(mixed(np.arange(256, dtype=np.uint64), 41), 43)
_END = re.compile(rb"[\t-\r ]")


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ``STEP`` and of its inverse, modulo 2^64."""
    out = np.full((2, n), np.uint64(STEP))
    out[1] = np.uint64(pow(STEP, -1, 1 << 64))
    out[:, :1] = 1
    return tuple(np.cumprod(out, 1, np.uint64))


_POWERS = powers(CHUNK + 1)


def some_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``powers`` gives, or a part of what is kept."""
    return (_POWERS[0][:n], _POWERS[1][:n]) if n <= len(_POWERS[0]) else powers(n)


def word_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each of the words that ``shingle_words`` gives, and the byte it begins at.

    It is a sum over the word's bytes, times powers by place, so the words of a text are hashed together.
    """
    raw, at = (text or "").encode("utf-8", "surrogatepass").lower(), 0
    names, begins = [], []
    while at < len(raw):
        end = _END.search(raw, at + CHUNK - 1) if at + CHUNK < len(raw) else None
        piece = raw[at : end.start() + 1 if end else len(raw)]
        codes = np.frombuffer(piece, np.uint8)
        up, down = some_powers(len(codes) + 1)
        gap = np.ones(len(codes) + 2, bool)
        gap[1:-1] = np.frombuffer(piece.translate(_GAP), bool)
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_BYTES.take(codes) * up[: len(codes)], out=sums[1:])
        names.append(mixed((sums[edges[1::2]] - sums[edges[::2]]) * down[edges[::2]], 45))
        begins.append(edges[::2] + at)
        at += len(codes)
    if not names:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(names), np.concatenate(begins)


def in_a_row(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of ``width`` words in a row; fewer words are one, none are none."""
    n = max(1, len(words) - width + 1) if len(words) else 0
    out = np.full(n, min(len(words), width), np.uint64)
    for i in range(min(width, len(words))):
        out = mixed(out + words[i : i + n], i + 1)
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """What ``np.unique`` gives, by sorting, which is faster for the arrays of one text."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row; fewer words are one shingle, none are no shingle."""
    return distinct(in_a_row(word_hashes(text)[0], width))
