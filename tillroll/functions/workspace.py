"""Intermediate results on storage every executor can reach."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Masters that run everything in one process.
_ONE_PROCESS = re.compile(r"local(\[[^\]]*\])?")

_own_folders: dict[str, str] = {}
_scratches: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session in one process without that setting gets a temporary folder
    of its own; on a cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not _ONE_PROCESS.fullmatch(context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="tillroll-")
    return _own_folders[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _scratches:
        _scratches[-1].append(path)
    return path


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage (a lost executor re-reads files instead of redoing the
    work) and gives later steps column pruning and true size statistics.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def files_open(spark: SparkSession, most: int) -> Iterator[None]:
    """A task that writes into directories or buckets keeps up to so many files open instead
    of sorting its rows by them; with more it sorts the rest.  0 leaves the session's choice."""
    before = spark.conf.get(_OPEN_FILES, None)
    if most:
        spark.conf.set(_OPEN_FILES, str(most))
    try:
        yield
    finally:
        if most and before is not None:
            spark.conf.set(_OPEN_FILES, before)
        elif most:
            spark.conf.unset(_OPEN_FILES)


@contextmanager
def noted() -> Iterator[list[str]]:
    """Collects the intermediate folders that are made inside; they stay."""
    made: list[str] = []
    _scratches.append(made)
    try:
        yield made
    finally:
        _scratches.pop()
        # A scratch around it removes what is left of them.
        if _scratches:
            _scratches[-1].extend(made)


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Removes folders; one that is gone already is passed over."""
    for name in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate folders that were made inside when it ends.

    Results must be written or collected before; a frame that is read later
    would miss its files.  Without it, intermediate folders stay.
    """
    made: list[str] = []
    _scratches.append(made)
    try:
        yield
    finally:
        _scratches.pop()
        remove(spark, made)


_shipped: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Send the package to the Python workers, once for an application.

    They then need neither an installed copy nor the driver's search path.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        # The driver serves the archive from this place as long as it runs.
        folder = tempfile.mkdtemp(prefix="tillroll-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(
            f"{folder}/{package.name}-{context.applicationId}", "zip", package.parent,
            package.name))
        _shipped.add(context.applicationId)
    return spark
