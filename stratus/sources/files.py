"""File-system helpers that go through Hadoop (work for any cluster store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` (a file, folder or glob) matches anything."""
    fs, p = _fs_and_path(spark, path)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0
