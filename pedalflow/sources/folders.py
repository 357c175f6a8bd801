"""Folders of the file system that Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, folder: str) -> bool:
    path, system = _system(spark, folder)
    return system.exists(path)


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of all files in the folder; 0 where there is none."""
    path, system = _system(spark, folder)
    return system.getContentSummary(path).getLength() if system.exists(path) else 0


def delete(spark: SparkSession, folder: str) -> None:
    path, system = _system(spark, folder)
    system.delete(path, True)


def publish(spark: SparkSession, staged: str, folder: str) -> None:
    """Put the finished folder ``staged`` in the place of ``folder``. Readers see the old one or the new one, or for the
    moment between two renames none; nothing is lost if the application ends there, the old one then has the ending ``.old``."""
    old = f"{folder}.old"
    path, system = _system(spark, folder)
    system.delete(_system(spark, old)[0], True)
    if system.exists(path) and not system.rename(path, _system(spark, old)[0]):
        raise OSError(f"cannot move {folder}")
    if not system.rename(_system(spark, staged)[0], path):
        system.rename(_system(spark, old)[0], path)
        raise OSError(f"cannot publish {folder}")
    system.delete(_system(spark, old)[0], True)
