"""Folders on whatever store the session reaches: there, moved, removed."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _at(spark, path)
    return files.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has written the folder to its end."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    files, target = _at(spark, path)
    return sorted(found.getPath().getName() for found in files.listStatus(target)) if files.exists(target) else []


def move(spark: SparkSession, path: str, to: str) -> None:
    files, source = _at(spark, path)
    _, target = _at(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def remove(spark: SparkSession, path: str) -> None:
    files, target = _at(spark, path)
    files.delete(target, True)


def make(spark: SparkSession, path: str) -> None:
    """An empty folder, if there is none yet."""
    files, target = _at(spark, path)
    files.mkdirs(target)
