"""Small inputs written by the tests themselves."""

from __future__ import annotations

import struct
import zlib
from pathlib import Path

import numpy as np


def png(pixels: np.ndarray) -> bytes:
    """An RGB PNG of a (height, width, 3) uint8 array."""
    height, width, _ = pixels.shape

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    lines = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
        + chunk(b"IDAT", zlib.compress(lines))
        + chunk(b"IEND", b"")
    )


def png_tree(root: Path, per_folder: int = 3, size: int = 32, seed: int = 42) -> dict[str, np.ndarray]:
    """raw/{train,test}/{REAL,FAKE}/*.png: REAL pictures are dark, FAKE ones bright."""
    random = np.random.default_rng(seed)
    pictures = {}
    for split in ("train", "test"):
        for label, low in (("REAL", 0), ("FAKE", 120)):
            folder = root / "raw" / split / label
            folder.mkdir(parents=True)
            for i in range(per_folder):
                pixels = random.integers(low, low + 136, (size, size, 3), dtype=np.uint8)
                (folder / f"{i:04d}.png").write_bytes(png(pixels))
                pictures[f"{split}/{label}/{i:04d}.png"] = pixels
    return pictures


def separable(spark, rows: int = 600, width: int = 16, seed: int = 42):
    """Normal noise with the first two dimensions pushed apart by the label."""
    random = np.random.default_rng(seed)
    label = random.integers(0, 2, rows)
    values = random.normal(size=(rows, width))
    values[:, :2] += (8 * label - 4)[:, None]
    data = [(i, [float(x) for x in values[i]], int(label[i])) for i in range(rows)]
    return spark.createDataFrame(data, "id int, a array<double>, label int")


PREDICTION_COLUMNS = "model string, path string, label int, prediction double, fake_probability double"


def predictions(spark, rows):
    return spark.createDataFrame(rows, PREDICTION_COLUMNS)
