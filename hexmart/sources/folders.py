"""Folders of a table through Hadoop's file systems, which reach every store that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _open(spark, path)
    return files.exists(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``, sorted; none if it does not exist.  One listing, no file is opened."""
    folder, files = _open(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory())


def data_files(spark: SparkSession, path: str) -> set[str]:
    """Names of the data files right below ``path``."""
    folder, files = _open(spark, path)
    if not files.exists(folder):
        return set()
    names = (status.getPath().getName() for status in files.listStatus(folder) if status.isFile())
    return {name for name in names if not name.startswith(("_", "."))}


def delete(spark: SparkSession, path: str) -> None:
    folder, files = _open(spark, path)
    files.delete(folder, True)


def swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder ``fresh`` in the place of ``path``, whose old content goes last.

    Between two renames ``path`` is missing; a stop there leaves both contents, the old one beside it as ``.old``.  Where the two
    lie in different stores, the fresh content is copied beside ``path`` first.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    target, files = _open(spark, path)
    source, source_files = _open(spark, fresh)
    beside, old = hadoop.Path(f"{path}.new"), hadoop.Path(f"{path}.old")
    files.delete(beside, True)
    files.delete(old, True)
    if not hadoop.FileUtil.copy(source_files, source, files, beside, True, conf):
        raise OSError(f"could not bring {fresh} to {path}")
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"could not set {path} aside")
    if not files.rename(beside, target):
        raise OSError(f"could not put the new content at {path}")
    files.delete(old, True)
