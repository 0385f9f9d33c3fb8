"""Files and folders on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever Hadoop file system it names."""
    system, place = _located(spark, path)
    return system.exists(place)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    system, place = _located(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(place)) if system.exists(place) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a file, or a folder with all it holds, that the caller has made."""
    system, place = _located(spark, path)
    system.delete(place, True)
