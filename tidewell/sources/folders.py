"""Listing and creating folders on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob; empty if none does."""
    p, fs = _fs(spark, pattern)
    return [s.getPath().toString() for s in (fs.globStatus(p) or [])]


def ensure(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.getFileStatus(p).isDirectory()


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already. Of several callers one succeeds."""
    p, fs = _fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        return bool(fs.createNewFile(p))
    except Exception as e:  # some file systems raise where the file is there
        if fs.exists(p):
            return False
        raise e


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system Spark resolves it against."""
    p, fs = _fs(spark, path)
    return fs.makeQualified(p).toString()
