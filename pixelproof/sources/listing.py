"""Listing files as a partitioned source: each folder is a partition and lists itself in a task.

The driver walks folder names only, ``levels`` deep, and a folder at that depth lists all below it in its task,
so names of files never pass through the driver or a plan. Files of zero bytes are listed like any other. The
stream form delivers a file again when it is rewritten, which Spark's own file streams do not.

Folders are opened by pyarrow, which reads local paths, HDFS (where its native library is installed), S3 and
Google storage; a scheme it does not know is an error.
"""

from __future__ import annotations

import json
import re
import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..session import ship_package

SCHEMA = "path string, length long, modificationTime timestamp"
ARROW = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", tz="UTC"))])
ROWS = 10_000

# Schemes of Hadoop that pyarrow knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


@dataclass
class Folder(InputPartition):
    """A folder to list: all below it, or only the files it holds itself; ``after`` < modification <= ``upto``, in µs."""

    uri: str
    below: bool
    after: int | None = None
    upto: int | None = None


def name_pattern(glob: str) -> re.Pattern:
    """File names that a glob of Hadoop's matches: ``*``, ``?``, ``[...]``, ``{a,b}`` and ``\\`` before a character."""
    out, depth, at = "", 0, 0
    while at < len(glob):
        char = glob[at]
        if char == "\\" and at + 1 < len(glob):
            at += 1
            out += re.escape(glob[at])
        elif char == "[" and "]" in glob[at + 2 :]:
            end = glob.index("]", at + 2)
            inside = glob[at + 1 : end]
            out += "[" + ("^" + inside[1:] if inside[0] in "!^" else inside).replace("\\", "\\\\") + "]"
            at = end
        elif char == "{":
            out, depth = out + "(?:", depth + 1
        elif char == "}" and depth:
            out, depth = out + ")", depth - 1
        elif char == "," and depth:
            out += "|"
        else:
            out += {"*": ".*", "?": "."}.get(char, re.escape(char))
        at += 1
    return re.compile(rf"(?:{out})\Z", re.DOTALL)


def hidden(name: str) -> bool:
    """Names that Spark's file sources leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def opened(uri: str) -> tuple[fs.FileSystem, str, str]:
    """The file system, the path in it, and what stands before such a path in Spark's spelling."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    system, path = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    if scheme == "hdfs":
        return system, path, f"hdfs://{rest[2:].split('/')[0]}"
    return system, path, f"{scheme}://"


def entries(uri: str) -> list[tuple[fs.FileInfo, str]]:
    """What a folder holds itself, hidden names left out, with its spelling; a file is its own entry."""
    system, path, before = opened(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path))
    return [(x, before + x.path) for x in found if info.is_file or not hidden(x.base_name)]


class FileListing(DataSource):
    """``spark.read.format("file_listing")``: path, length, modificationTime of the files below a folder.

    Options: ``roots`` (a JSON list of qualified folders or files), ``glob`` (of file names), ``levels`` (folders
    the driver walks down, 2), and for streams ``settle`` (seconds a file must have been left alone, 0) and
    ``overlap`` (seconds each step looks back for files that became visible late, 0).
    """

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return FolderReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return FolderStreamReader(self.options)


class _Folders:
    def __init__(self, options: dict[str, str]) -> None:
        self.roots = json.loads(options["roots"])
        self.names = name_pattern(options.get("glob", "*"))
        self.levels = int(options.get("levels", 2))
        self.settle = int(float(options.get("settle", 0)) * 1e6)
        self.overlap = int(float(options.get("overlap", 0)) * 1e6)

    def folders(self, after: int | None = None, upto: int | None = None) -> list[Folder]:
        out, level = [], self.roots
        for _ in range(self.levels):
            out += [Folder(uri, False, after, upto) for uri in level]
            level = [uri for folder in level for x, uri in entries(folder) if not x.is_file]
        return out + [Folder(uri, True, after, upto) for uri in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in self._listed(partition):
            rows.append(row)
            if len(rows) == ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def _listed(self, partition: Folder) -> Iterator[tuple]:
        waiting = [partition.uri]
        while waiting:
            for x, uri in entries(waiting.pop()):
                if not x.is_file:
                    waiting += [uri] * partition.below
                    continue
                changed = x.mtime_ns // 1_000_000 * 1000  # Spark's listings know milliseconds
                inside = (partition.after is None or changed > partition.after) and (partition.upto is None or changed <= partition.upto)
                if inside and self.names.match(x.base_name):
                    yield uri, x.size, changed


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


class FolderReader(_Folders, DataSourceReader):
    def partitions(self) -> list[Folder]:
        return self.folders()


class FolderStreamReader(_Folders, DataSourceStreamReader):
    """Offsets are modification times in µs: a step delivers the files changed since the one before."""

    def initialOffset(self) -> dict:
        return {"upto": 0}

    def latestOffset(self) -> dict:
        return {"upto": int(time.time() * 1000) * 1000 - self.settle}

    def partitions(self, start: dict, end: dict) -> list[Folder]:
        return self.folders(max(0, start["upto"] - self.overlap) - (start["upto"] == 0), end["upto"])

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def qualified(spark: SparkSession, root: str) -> str:
    """A path with its scheme, as the cluster's own file system names it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _options(spark: SparkSession, root: str | list[str], glob: str, levels: int) -> dict[str, str]:
    ship_package(spark)
    # the process that plans a stream's source does not look into shipped packages: it gets the code itself
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FileListing)
    roots = [root] if isinstance(root, str) else list(root)
    return {"roots": json.dumps([qualified(spark, r) for r in roots]), "glob": glob, "levels": str(levels)}


def list_files(spark: SparkSession, root: str | list[str], glob: str = "*", levels: int = 2) -> DataFrame:
    """path, length and modificationTime of every file below ``root``, those of zero bytes included."""
    return spark.read.format("file_listing").options(**_options(spark, root, glob, levels)).load()


def list_stream(
    spark: SparkSession, root: str | list[str], glob: str = "*", levels: int = 2, settle: float = 0, overlap: float = 0
) -> DataFrame:
    """The same as files arrive or are rewritten; with ``overlap`` a file may come more than once."""
    options = _options(spark, root, glob, levels) | {"settle": str(settle), "overlap": str(overlap)}
    return spark.readStream.format("file_listing").options(**options).load()


def read_content(path: str, most: int | None = None) -> bytes:
    """The bytes of a listed file, read inside a task; a file of more than ``most`` bytes is an error."""
    system, inside, _ = opened(path)
    with system.open_input_file(inside) as file:
        if most is not None and file.size() > most:
            raise ValueError(f"{file.size()} bytes are more than {most}")
        return file.read()


def read_range(path: str, start: int, size: int) -> bytes:
    """At most ``size`` bytes of a listed file from ``start`` on; a file that ends before ``start`` is an error."""
    system, inside, _ = opened(path)
    with system.open_input_file(inside) as file:
        if start >= file.size():
            raise ValueError(f"the file has become shorter than {start} bytes")
        return file.read_at(size, start)
