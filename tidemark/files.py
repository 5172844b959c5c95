"""Listing and deleting in whatever file system a path lies in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern."""
    files, place = _at(spark, pattern)
    return [s.getPath().toString() for s in files.globStatus(place) or []]


def delete(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all it holds; nothing if it is gone already."""
    files, place = _at(spark, path)
    files.delete(place, True)
