"""Small questions to the file system of a path, through Spark's own Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none where there is no folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def data_files(spark: SparkSession, path: str) -> list[str]:
    """All files below a path whose name does not mark them as hidden."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found, every = [], fs.listFiles(target, True)
    while every.hasNext():
        file = every.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.append(file.toString())
    return found
