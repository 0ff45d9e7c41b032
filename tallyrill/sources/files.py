"""Small file-system questions, asked through Spark's own Hadoop configuration."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return fs.exists(jpath)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a pattern, in one call; none if there are none."""
    fs, jpath = _open(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(jpath) or [])


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if it does not exist."""
    fs, jpath = _open(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that did not exist, atomically; False if it does."""
    fs, jpath = _open(spark, path)
    try:
        out = fs.create(jpath, False)
    except Exception:
        if fs.exists(jpath):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, jpath = _open(spark, path)
    if not fs.exists(jpath):
        return None
    opened = fs.open(jpath)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written."""
    fs, jpath = _open(spark, path)
    return time.time() - fs.getFileStatus(jpath).getModificationTime() / 1000


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Rename; False if there is nothing to rename."""
    fs, jpath = _open(spark, path)
    return fs.exists(jpath) and fs.rename(jpath, _open(spark, to)[1])


def move_new(spark: SparkSession, path: str, to: str) -> bool:
    """Rename to a name that nothing has, atomically where the file system can; False if something has it."""
    jvm = spark._jvm
    fs, jpath = _open(spark, path)
    target = _open(spark, to)[1]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(jpath, target, options)
    except Exception:
        if fs.exists(target):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _open(spark, path)
    fs.delete(jpath, True)
