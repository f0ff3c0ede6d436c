"""Folders of tables, by the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if it is not there."""
    files, place = _place(spark, path)
    return [x.getPath().getName() for x in files.listStatus(place)] if files.exists(place) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def put(spark: SparkSession, path: str, text: str) -> None:
    """A small file with ``text``, in the place of one that is there."""
    files, place = _place(spark, path)
    out = files.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet folder with a known schema; no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
