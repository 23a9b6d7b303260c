"""Names and folders in the store that Spark reads (any Hadoop file system).

Driver-side metadata only: listing a folder's names, creating an empty mark,
removing folders.  Data is read and written by Spark alone.
"""
from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    store, path = _at(spark, location)
    return store.exists(path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder; a folder that is not there has none."""
    store, path = _at(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(path)) if store.exists(path) else []


def mark(spark: SparkSession, location: str) -> None:
    """Create an empty file; its name is the message, so no reader can see half of it."""
    store, path = _at(spark, location)
    store.create(path, False).close()


def remove(spark: SparkSession, location: str) -> None:
    store, path = _at(spark, location)
    store.delete(path, True)


def remove_at_exit(spark: SparkSession, location: str) -> None:
    """Remove a finished copy when this driver's JVM ends, for frames that read it until then."""
    store, path = _at(spark, location)
    store.deleteOnExit(path)
