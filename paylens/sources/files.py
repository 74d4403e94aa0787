"""File-system helpers on Spark's own Hadoop client (any scheme it can read)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isDirectory())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder, replacing what stands at ``target``."""
    fs, src = _fs(spark, source)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst):
        fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")


def identity(spark: SparkSession, path: str) -> tuple:
    """(path, size, modification time) of every file under ``path``: what a
    cached result of reading it depends on. Empty if nothing is there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return ()
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))
