"""Files and folders of any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where there is no such folder."""
    files, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, there in one step or not at all."""
    files, place = _at(spark, path)
    files.create(place, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds."""
    files, place = _at(spark, path)
    files.delete(place, True)
