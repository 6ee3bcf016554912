"""The feature step: file contents to a float vector, in Arrow batches.

A featurizer is plugged in. Its ``load`` runs once per Python worker and returns
two functions: ``decode`` takes one item and may raise, ``compute`` turns a list
of decoded items into a (rows, width) matrix in one call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

from ..session import ship_package
from ..sources.listing import read_content

EXTRACTED = StructType(
    [StructField("features", ArrayType(FloatType())), StructField("error", StringType())]
)

Decode = Callable[[Any], Any]
Compute = Callable[[list], np.ndarray]


@dataclass(frozen=True)
class Featurizer:
    name: str
    width: int
    load: Callable[[], tuple[Decode, Compute]]
    rows_per_call: int = 256
    bytes_per_call: int = 16 << 20


class FeatureWidthError(ValueError):
    """The featurizer returned vectors of another width than it declares."""


_loaded: dict[tuple[str, int], tuple[Decode, Compute]] = {}


def _functions_of(featurizer: Featurizer) -> tuple[Decode, Compute]:
    key = (featurizer.name, featurizer.width)
    if key not in _loaded:
        _loaded[key] = featurizer.load()
    return _loaded[key]


def _each_or_error(step: Callable, items: list, rows: list[int], errors: list[str | None]) -> tuple[list, list[int]]:
    """Results of the items that pass, with their rows; the others leave an error."""
    results, good = [], []
    for row, item in zip(rows, items, strict=True):
        try:
            results.append(step(item))
            good.append(row)
        except Exception as problem:  # a broken file is data, not a failed job
            errors[row] = f"{type(problem).__name__}: {problem}"
    return results, good


def _bytes_of(items: pa.Array) -> np.ndarray:
    """The size of each item, from the offsets alone; items that are not binary count as equal shares."""
    if len(items) and pa.types.is_binary(items.type):
        return np.diff(np.frombuffer(items.buffers()[1], np.int32, len(items) + 1, items.offset * 4)).astype(np.int64)
    return np.full(len(items), items.nbytes // max(1, len(items)), np.int64)


def _calls(sizes: np.ndarray, rows: int, size: int) -> Iterator[tuple[int, int]]:
    """Slices of at most so many rows and bytes; an item that is larger is a slice of its own."""
    start, held = 0, 0
    for at, one in enumerate(sizes.tolist()):
        if at > start and (at - start == rows or held + one > size):
            yield start, at
            start, held = at, 0
        held += one
    if start < len(sizes):
        yield start, len(sizes)


def featurize_batch(items: pa.Array, featurizer: Featurizer) -> pa.StructArray:
    """One Arrow batch of items to structs of features and error, in order."""
    decode, compute = _functions_of(featurizer)
    rows = len(items)
    sizes = _bytes_of(items)
    matrix = np.zeros((rows, featurizer.width), dtype=np.float32)
    errors: list[str | None] = [None] * rows

    def decode_content(item):
        if not item:
            raise ValueError("no content")
        return decode(item)

    for start, stop in _calls(sizes, featurizer.rows_per_call, featurizer.bytes_per_call):
        chunk = items.slice(start, stop - start).to_pylist()
        decoded, good = _each_or_error(decode_content, chunk, list(range(start, start + len(chunk))), errors)
        if not good:
            continue
        try:
            part = compute(decoded)
        except Exception:  # one item spoils the call: find it, keep the others
            singles, good = _each_or_error(lambda one: compute([one])[0], decoded, good, errors)
            part = np.stack(singles) if good else np.zeros((0, featurizer.width))
        part = np.asarray(part, dtype=np.float32)
        if part.shape != (len(good), featurizer.width):
            raise FeatureWidthError(
                f"{featurizer.name} gave {part.shape}, expected {(len(good), featurizer.width)}"
            )
        matrix[good] = part
        for row in np.asarray(good)[~np.isfinite(part).all(axis=1)].tolist():
            errors[row] = "ValueError: features are not finite"
    broken = np.array([e is not None for e in errors], dtype=bool)
    ends = np.concatenate([[0], np.cumsum(np.where(broken, 0, featurizer.width))]).astype(np.int32)
    features = pa.ListArray.from_arrays(
        pa.array(ends), pa.array(matrix[~broken].ravel()), mask=pa.array(broken)
    )
    return pa.StructArray.from_arrays([features, pa.array(errors, pa.string())], names=["features", "error"])


def extracted(item: Column, featurizer: Featurizer) -> Column:
    """Struct of features and error for a binary column, or a struct with the bytes in it."""

    @F.arrow_udf(EXTRACTED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield featurize_batch(batch, featurizer)

    return run(item)


def extracted_from_files(path: Column, length: Column, featurizer: Featurizer, most: int) -> Column:
    """Struct of features and error for listed files, which the task opens itself, some at a time.

    A file that is gone, empty or larger than ``most`` has its error.
    """

    @F.arrow_udf(EXTRACTED)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for paths, lengths in batches:
            sizes = np.minimum(lengths.fill_null(0).to_numpy(zero_copy_only=False), most)
            parts = [
                _featurized_files(paths.slice(start, stop - start).to_pylist(), featurizer, most)
                for start, stop in _calls(sizes, featurizer.rows_per_call, featurizer.bytes_per_call)
            ]
            yield pa.concat_arrays(parts or [featurize_batch(pa.array([], pa.binary()), featurizer)])

    return run(path, length)


def _featurized_files(paths: list[str], featurizer: Featurizer, most: int) -> pa.StructArray:
    contents, unread = [], {}
    for row, path in enumerate(paths):
        try:
            contents.append(read_content(path, most))
        except Exception as problem:  # a file that cannot be read is data, not a failed job
            unread[row] = f"{type(problem).__name__}: {problem}"
            contents.append(None)
    found = featurize_batch(pa.array(contents, pa.binary()), featurizer)
    errors = [unread.get(row, error) for row, error in enumerate(found.field("error").to_pylist())]
    return pa.StructArray.from_arrays([found.field("features"), pa.array(errors, pa.string())], names=["features", "error"])


def with_features(df: DataFrame, featurizer: Featurizer, item: str = "content", tasks: int | None = None) -> DataFrame:
    """Replace ``item`` by features and error; every row is kept.

    The scan packs small files into tasks by ``spark.sql.files.openCostInBytes``,
    some thirty a task by default. ``tasks`` merges such splits, without a
    shuffle, so that the model is loaded less often and output files are larger.
    """
    ship_package(df.sparkSession)
    rows = df.coalesce(tasks) if tasks else df
    others = [c for c in df.columns if c != item]
    return rows.select(*others, extracted(F.col(item), featurizer).alias("_x")).select(
        *others, "_x.features", "_x.error"
    )
