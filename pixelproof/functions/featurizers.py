"""Featurizers: byte histogram, pixel histogram with statistics."""

from __future__ import annotations

import numpy as np

from .features import Featurizer

LEVELS = 256
CHANNELS = 3


# ---- bytes of any file -------------------------------------------------------


def _as_bytes(content: bytes) -> np.ndarray:
    return np.frombuffer(content, dtype=np.uint8)


PIECE = 1 << 20  # bytes counted at a time, so that memory does not grow with an item


def _count_levels(items: list[np.ndarray]) -> np.ndarray:
    """One 256-wide count row per item, added up over pieces of a fixed size."""
    counts = np.zeros((len(items), LEVELS), dtype=np.int64)
    for row, item in enumerate(items):
        for start in range(0, len(item), PIECE):
            counts[row] += np.bincount(item[start : start + PIECE], minlength=LEVELS)
    return counts


def _load_byte_histogram():
    return _as_bytes, _count_levels


def byte_histogram() -> Featurizer:
    """How often each byte value occurs in the file: 256 counts."""
    return Featurizer("byte_histogram", LEVELS, _load_byte_histogram)


# ---- decoded pictures --------------------------------------------------------


def _as_rgb(image: dict) -> np.ndarray:
    """Rows of the ``image`` source (B, G, R order) to (3, pixels) in R, G, B order."""
    channels = image["nChannels"]
    if channels not in (1, 3, 4):
        raise ValueError(f"undecodable image, {channels} channels")
    pixels = np.frombuffer(image["data"], dtype=np.uint8).reshape(-1, channels)
    if channels == 1:
        return np.repeat(pixels.T, CHANNELS, axis=0)
    return pixels[:, [2, 1, 0]].T


def _histogram_and_statistics(items: list[np.ndarray]) -> np.ndarray:
    """256 counts per channel, then mean, std, min and max per channel: 780 wide."""
    counts = _count_levels([channel for item in items for channel in item]).reshape(len(items), CHANNELS, LEVELS)
    level = np.arange(LEVELS, dtype=np.float64)
    pixels = counts.sum(axis=2)
    mean = counts @ level / pixels
    variance = np.maximum(counts @ level**2 / pixels - mean**2, 0.0)
    seen = counts > 0
    low = seen.argmax(axis=2)
    high = LEVELS - 1 - seen[:, :, ::-1].argmax(axis=2)
    statistics = np.concatenate([mean, np.sqrt(variance), low, high], axis=1)
    return np.concatenate([counts.reshape(len(items), -1), statistics], axis=1)


def _load_pixel_histogram():
    return _as_rgb, _histogram_and_statistics


def pixel_histogram() -> Featurizer:
    """Colour histograms and statistics of a decoded picture, for the ``image`` column."""
    return Featurizer("pixel_histogram", CHANNELS * (LEVELS + 4), _load_pixel_histogram)
