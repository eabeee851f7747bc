"""Small files beside a stream's data, through Spark's file systems so that any store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the finished files of a folder, none if it does not exist."""
    system, path = _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(n for s in system.listStatus(path) if not (n := s.getPath().getName()).startswith((".", "_")))


def read_text(spark: SparkSession, path: str) -> str | None:
    system, at = _path(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> str:
    """Write a file unless it is there; returns what it holds.  It is written aside and renamed, so it is never there in part."""
    system, at = _path(spark, path)
    if not system.exists(at):
        aside = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.tmp")
        stream = system.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        system.rename(aside, at)
    return read_text(spark, path)
