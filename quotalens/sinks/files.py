"""Folders on any file system that Spark reaches, through Hadoop's file system API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if it isn't there."""
    fs, p, _ = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small text file."""
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that must not exist yet; False if it does.

    The file gets its name by one rename of a complete file, so a reader sees all of it or nothing.
    """
    import uuid

    fs, p, jvm = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.exists(p) and fs.rename(draft, p):
        return True
    fs.delete(draft, False)
    return False
