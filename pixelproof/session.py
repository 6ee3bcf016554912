"""Session start-up, the shared work folder, and shipping the package to executors."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app_name: str = "pixelproof", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings results depend on; sizes come from the submit command."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would each write to their own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="pixelproof-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created until a job writes there."""
    return f"{shared_folder(spark)}/pixelproof/{purpose}-{uuid.uuid4().hex}"


def make_folder(spark: SparkSession, path: str) -> str:
    """Create a folder; returns its path with the scheme, as the cluster's own file system names it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(where)
    return system.makeQualified(where).toString()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a work table that is no longer needed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Only the driver reads the archive; Spark serves it to the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="pixelproof-ship-")) / "pixelproof"),
        "zip",
        root_dir=package.parent,
        base_dir=package.name,
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
