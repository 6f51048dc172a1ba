"""The few file operations that are no DataFrame work, through the file system that a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _at(spark, path)
    return system.exists(at)


def delete(spark: SparkSession, path: str) -> bool:
    system, at = _at(spark, path)
    return system.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none when it does not exist."""
    system, at = _at(spark, path)
    return [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []


def create(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; an error when there is one already."""
    system, at = _at(spark, path)
    out = system.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read(spark: SparkSession, path: str) -> str:
    system, at = _at(spark, path)
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
