"""Folders of any file system that Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def folder(spark: SparkSession, path: str):
    """The path as the file system knows it, and that file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
