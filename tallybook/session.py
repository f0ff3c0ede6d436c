"""Session settings the jobs rely on, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_WRITTEN: list[str] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone: vendor timestamps are UTC and days are cut in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def release_shuffles(spark: SparkSession) -> SparkSession:
    """Remove what a job has shuffled as soon as it is through, in this session from now on.

    For jobs of many steps that each write a table: otherwise all steps' shuffle files stay until the driver happens
    to collect its garbage. A job whose result is read a second time computes its shuffles again.
    """
    spark.conf.set(_CLEANUP, "true")
    return spark


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """The same for the jobs of this block alone, which write tables."""
    held = spark.conf.get(_CLEANUP, None)
    release_shuffles(spark)
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if held is None else spark.conf.set(_CLEANUP, held)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tallybook-")
    return _LOCAL_DIRS[app]


def new_table_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def written_paths() -> list[str]:
    """Tables this process put into the shared folder, for its owner to clear once results are out."""
    return list(_WRITTEN)


def remove_table(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def owned_tables(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the tables that were written within it; read its results before."""
    begun = len(_WRITTEN)
    try:
        yield
    finally:
        for path in _WRITTEN[begun:]:
            remove_table(spark, path)
        del _WRITTEN[begun:]
